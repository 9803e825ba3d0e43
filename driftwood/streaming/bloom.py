"""Bloom verdicts and gates on a line stream (micro-batch scoring).

The filter is static (a saved artifact); each micro-batch probes its own distinct
words once and writes its result under ``batch_id=<id>`` (overwrite), so a retried
batch replaces its own output and nothing else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import bloom, gates
from ..sources.documents import line_tokens
from .io import append_by_batch


def verdict_writer(bits: DataFrame, out: str, m: int, k: int, keys=("doc_id", "line_no")):
    def transform(batch: DataFrame, batch_id: int) -> DataFrame:
        return bloom.verdict(line_tokens(batch, keys), bits, m, k)
    return append_by_batch(out, transform)


def batch_gate_writer(bits: DataFrame, out: str, m: int, k: int, keys=("doc_id", "line_no"), by: str | None = None):
    """Pass a micro-batch's lines only when none of its tokens probes positive.  With ``by``, a column that names smaller
    batches, each of these passes or not by itself, so that a micro-batch can hold as many of them as the cluster's cores
    are worth; the source must not spread one of them over two micro-batches."""
    def transform(batch: DataFrame, batch_id: int) -> DataFrame:
        gated = F.lit(batch_id).cast("bigint") if by is None else F.col(by)
        return gates.batch_gate(batch, bits, gated, m, k, keys).drop("batch_id")
    return append_by_batch(out, transform)


def sentence_gate_writer(bits: DataFrame, out: str, m: int, k: int, keys=("doc_id", "line_no")):
    def transform(batch: DataFrame, batch_id: int) -> DataFrame:
        return gates.sentence_gate(batch, bits, m, k, keys)
    return append_by_batch(out, transform)
