"""Timestamp rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND_FMT = "yyyy-MM-dd HH:mm:ss"


def py_datetime_str(ts: Column) -> Column:
    """Render like Python's ``str(datetime)``: microseconds only when non-zero."""
    return F.when(F.date_format(ts, "SSSSSS") == "000000", F.date_format(ts, SECOND_FMT)) \
        .otherwise(F.date_format(ts, SECOND_FMT + ".SSSSSS"))
