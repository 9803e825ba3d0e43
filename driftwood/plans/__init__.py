"""Registered queries: ``QUERIES[name](spark, sf_dir) -> DataFrame`` and their DuckDB oracles.

Importing this package imports every plan module, which fills the registry.
"""

from .registry import ORACLE, QUERIES, register  # noqa: F401
from . import quotes, windows, history, text, minhash, similar, streams  # noqa: F401,E402
