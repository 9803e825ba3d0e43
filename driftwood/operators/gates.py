"""Word gates: exact membership, and Bloom-based suppression of lines or whole batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.documents import line_tokens
from . import bloom
from .sizing import bounded_broadcast


def _listed_side(listed: DataFrame, word: str) -> DataFrame:
    side, _ = bounded_broadcast(listed.select(word).distinct())
    return side


def exact_semi(tokens: DataFrame, listed: DataFrame, word: str = "word") -> DataFrame:
    """Tokens whose word is listed (exact ground truth of the Bloom probe)."""
    return tokens.join(_listed_side(listed, word), word, "left_semi")


def exact_anti(tokens: DataFrame, listed: DataFrame, word: str = "word") -> DataFrame:
    return tokens.join(_listed_side(listed, word), word, "left_anti")


def sentence_gate(lines: DataFrame, bits: DataFrame, m: int = bloom.DEFAULT_M, k: int = bloom.DEFAULT_K,
                  keys: Sequence[str] = ("doc_id", "line_no"), line_col: str = "line") -> DataFrame:
    """Lines none of whose tokens probe positive.

    Words are probed once each; tokens meet the (size-checked, broadcast) positive
    words, the keys of hit lines are materialized and - again behind a size check -
    anti-joined to the lines.  With both sides small, neither tokens nor lines move.
    """
    toks = line_tokens(lines, keys, line_col)
    pos = bloom.positive_side(toks, bits, m, k)
    hit, _ = bounded_broadcast(toks.join(pos, "word", "left_semi").select(*keys).distinct())
    return lines.join(hit, list(keys), "left_anti")


def batch_gate(lines: DataFrame, bits: DataFrame, batch: Column | str, m: int = bloom.DEFAULT_M,
               k: int = bloom.DEFAULT_K, keys: Sequence[str] = ("doc_id", "line_no"),
               line_col: str = "line") -> DataFrame:
    """All lines of a batch pass when no token of the batch probes positive; otherwise
    the whole batch is suppressed.  ``batch`` names the micro-batch of each line."""
    b = F.col(batch) if isinstance(batch, str) else batch
    x = lines.withColumn("batch_id", b)
    toks = line_tokens(x, ("batch_id",), line_col)
    pos = bloom.positive_side(toks, bits, m, k)
    bad, _ = bounded_broadcast(toks.join(pos, "word", "left_semi").select("batch_id").distinct())
    return x.join(bad, "batch_id", "left_anti").select("batch_id", *keys, line_col)
