"""Text as line and token streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import lines_of, single_space_tokens


def document_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, line_no, line)``: one row per ``\\n``-separated line (0-based)."""
    return docs.select(id_col, F.posexplode(lines_of(F.col(text_col))).alias("line_no", "line"))


def line_tokens(lines: DataFrame, keys=("doc_id", "line_no"), line_col: str = "line") -> DataFrame:
    """``(keys..., pos, word)``: single-space tokens, empty tokens kept."""
    return lines.select(*keys, F.posexplode(single_space_tokens(F.col(line_col))).alias("pos", "word"))


def first_token(lines: DataFrame, keys=("doc_id", "line_no"), line_col: str = "line") -> DataFrame:
    return lines.select(*keys, F.get(single_space_tokens(F.col(line_col)), F.lit(0)).alias("words"))
