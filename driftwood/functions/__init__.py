"""Column expressions shared by batch and streaming plans (all JVM-side, no Python UDFs)."""

from .hashing import md5_mod, md5_u32
from .money import price_text, shares_for_budget, signal_message, units
from .text import lines_of, single_space_tokens, whitespace_tokens, WHITESPACE_CLASS
from .timefmt import py_datetime_str

__all__ = [
    "md5_mod", "md5_u32", "price_text", "shares_for_budget", "signal_message", "units",
    "lines_of", "single_space_tokens", "whitespace_tokens", "WHITESPACE_CLASS",
    "py_datetime_str",
]
