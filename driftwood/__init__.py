"""driftwood: quote-stream and text analytics expressed as Spark DataFrame plans.

Layout
------
functions/  column expressions (hashing, tokenizers, money, formatting)
sources/    readers and landers: tables, quote lines, CSV/JSON, lexicon, history
operators/  DataFrame -> DataFrame operators (rolling windows, windows, Bloom, gates, MinHash)
streaming/  Structured Streaming twins of the batch operators
plans/      the registered queries (spark, sf_dir) -> DataFrame plus their DuckDB oracles
"""

__version__ = "0.1.0"
