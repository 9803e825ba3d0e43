"""The DuckDB SQL of op8 and op9 on odd rows, against the queries."""

import duckdb
import pytest

from driftwood.llm.queries import ORACLE, QUERIES

PASSAGE = " ".join(f"word{i}" for i in range(60))
DOCS = [
    (1, PASSAGE), (2, "Before. " + PASSAGE.upper() + " After"), (2, "Before. " + PASSAGE.upper() + " After"), (None, "x " + PASSAGE + PASSAGE), (3, None), (4, ""),
    (5, "-" * 700), (6, "ab" * 150), (7, "é" * 150), (8, "ñandú 北京 one two three four five six seven eight nine ten eleven"), (9, "Seven, EIGHT nine; ten?"),
    (10, "solo"), (11, "word3 word4 word5 word6 word7 word8 word9 word10 word11 other"), (12, "y" * 199), (13, "  … a_b-c")]
ITEMS = {
    "long": [("a", "zero " + PASSAGE), ("b", "北京 one two three four five six seven eight nine ten, eleven"), (None, "word30 word31 " * 6), ("a", PASSAGE[:200]), ("c", None), ("d", "  ")],
    "short": [("a", PASSAGE), ("s", "seven EIGHT nine"), ("s", "ten eleven")],
    "single": [("one", "Solo"), ("two", PASSAGE)],
    "none": [],
}


@pytest.mark.parametrize("name, items", [("op8_repeats", "long")] + [("op9_decontam", i) for i in ITEMS])
def test_sql_gives_the_same_rows(spark, tmp_path, name, items):
    extra = [(i, t, 7, "q") for i, t in DOCS]  # columns that clash with the operators' own
    spark.createDataFrame(extra, "doc_id bigint, text string, ref int, items string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(ITEMS[items], "item_id string, text string").coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    df = QUERIES[name](spark, str(tmp_path))
    rel = con.sql(ORACLE[name])
    assert sorted(rel.columns) == sorted(df.columns)
    want = [tuple(dict(zip(rel.columns, r))[c] for c in df.columns) for r in rel.fetchall()]
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in df.collect())
