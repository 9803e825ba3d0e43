"""Review texts from a header CSV (``Review Text`` column, quoted multi-line fields)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REVIEW_COL = "Review Text"
# An empty field is null, a quoted empty one is the empty text; blanks belong to the text.  (Reading, the
# value that stands for an empty field must differ from the one that stands for a quoted empty field.)
_CSV = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true", "nullValue": "", "emptyValue": '""',
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def land_review_csv(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> str:
    docs.select(F.col(id_col).alias("review_id"), F.col(text_col).alias(REVIEW_COL)) \
        .write.mode("overwrite").options(**_CSV).csv(path)
    return path


def scan_review_csv(spark: SparkSession, path: str) -> DataFrame:
    """``(review_id, text)``; a missing review stays null (the MinHash reads it as ``nan``)."""
    raw = spark.read.schema(f"review_id string, `{REVIEW_COL}` string").options(**{**_CSV, "nullValue": "\x00", "emptyValue": ""}).csv(path)
    return raw.select(F.col("review_id").try_cast("bigint").alias("review_id"), F.col(f"`{REVIEW_COL}`").alias("text"))
