"""MinHash signatures of documents (word shingles).

Shingles are the distinct whitespace tokens of a text (``str.split()`` semantics; a
missing text reads as the word ``nan``).  A word hashes to the first 32 bits of its
MD5 digest (stable across processes).  Signature entry ``i`` is
``min over shingles x of ((2i+1) * x + 100 i + 2) mod M`` for ``i < n``.

Only ``x mod M`` matters, so each document is first reduced (JVM-side) to its
distinct residues, at most ``M``: the work per document is bounded by ``n * M``
whatever its length.  The minima are then a small numeric kernel,
``min over r in R of H[i, r]`` with the fixed ``n x M`` table ``H``, run by an
Arrow-batched pandas UDF: row-local, no shuffle, documents never meet.

``signatures_relational`` is the same computation as a plan - ``(doc, residue)``
pairs joined to the broadcast ``(r, i, h)`` table (size fixed by the parameters)
and reduced with ``min`` per ``(doc, i)`` - kept as a cross-check; it moves
``n`` rows per residue through a hash aggregate, about 20x the work.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import md5_u32
from ..functions.text import whitespace_tokens
from ..session import ship_package

# Fixed values of the reference hash family: 200 functions, modulus 1119,
# h_i(x) = ((2i + 1) x + 100 i + 2) mod 1119.
NUM_HASHES = 200
MODULUS = 1119


def shingles(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, word)``: distinct whitespace tokens per document."""
    return docs.select(id_col, F.explode(F.array_distinct(whitespace_tokens(F.col(text_col)))).alias("word"))


def residues(text: Column, modulus: int = MODULUS) -> Column:
    """Distinct ``hash(word) mod M`` over the distinct words of ``text``."""
    words = F.array_distinct(whitespace_tokens(text))
    return F.array_distinct(F.transform(words, lambda w: F.pmod(md5_u32(w), F.lit(modulus))))


def hash_table(spark: SparkSession, num_hashes: int = NUM_HASHES, modulus: int = MODULUS) -> DataFrame:
    """``(r, i, h)`` with ``h = h_i(r)`` for every residue ``r < M`` and ``i < n``."""
    r = spark.range(modulus).select(F.col("id").cast("int").alias("r"))
    x = r.select("r", F.explode(F.sequence(F.lit(0), F.lit(num_hashes - 1))).alias("i"))
    return x.select("r", "i", F.pmod((F.col("i") * 2 + 1) * F.col("r") + F.col("i") * 100 + 2,
                                     F.lit(modulus)).cast("int").alias("h"))


@functools.lru_cache(maxsize=8)
def _value_table(num_hashes: int, modulus: int) -> np.ndarray:
    i = np.arange(num_hashes, dtype=np.int64)[:, None]
    r = np.arange(modulus, dtype=np.int64)[None, :]
    return ((2 * i + 1) * r + 100 * i + 2) % modulus


@functools.lru_cache(maxsize=8)
def _minima_udf(num_hashes: int, modulus: int):
    @F.pandas_udf("array<int>")
    def minima(res: pd.Series) -> pd.Series:
        table = _value_table(num_hashes, modulus)
        out = []
        for r in res:
            if r is None or len(r) == 0:
                out.append(None)
            else:
                out.append(table[:, np.asarray(r, dtype=np.int64)].min(axis=1).astype(np.int32))
        return pd.Series(out, dtype=object)
    return minima


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               num_hashes: int = NUM_HASHES, modulus: int = MODULUS) -> DataFrame:
    """``(doc_id, signature array<int>)``; null signature for a text without shingles."""
    ship_package(docs.sparkSession)
    r = docs.select(id_col, residues(F.col(text_col), modulus).alias("_r"))
    return r.select(id_col, _minima_udf(num_hashes, modulus)(F.col("_r")).alias("signature"))


def minima_long_relational(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           num_hashes: int = NUM_HASHES, modulus: int = MODULUS) -> DataFrame:
    """``(doc_id, i, minhash)`` as a join + aggregate; a text without shingles gives one null row."""
    pairs = (docs.select(id_col, F.explode_outer(residues(F.col(text_col), modulus)).alias("r"))
             .repartition(id_col))
    table = F.broadcast(hash_table(docs.sparkSession, num_hashes, modulus))
    j = pairs.join(table, "r", "left")
    return j.groupBy(id_col, "i").agg(F.min("h").alias("minhash"))


def signatures_relational(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          num_hashes: int = NUM_HASHES, modulus: int = MODULUS) -> DataFrame:
    lg = minima_long_relational(docs, id_col, text_col, num_hashes, modulus)
    g = lg.groupBy(id_col).agg(F.sort_array(F.collect_list(
        F.when(F.col("i").isNotNull(), F.struct("i", "minhash")))).alias("_s"))
    return g.select(id_col, F.when(F.size("_s") > 0, F.transform("_s", lambda s: s["minhash"]))
                    .alias("signature"))


def signatures_long(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    num_hashes: int = NUM_HASHES, modulus: int = MODULUS) -> DataFrame:
    """``(doc_id, i, minhash)``: one row per signature entry (the printed report, as rows); a text
    without shingles gives one row of nulls."""
    sig = signatures(docs, id_col, text_col, num_hashes, modulus)
    return sig.select(id_col, F.posexplode_outer("signature").alias("i", "minhash"))
