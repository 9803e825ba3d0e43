"""Plan shapes the scale design depends on, read from the final (adaptive) physical plan."""

import contextlib
import io
import re

from driftwood.plans import QUERIES
from conftest import SF_SMALL


def final_plan(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    df.collect()  # run it, so the adaptive plan is final
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    text = buf.getvalue()
    assert "isFinalPlan=true" in text
    # the final plan comes first; the initial plan follows it
    return text.split("+- == Initial Plan ==")[0]


def test_rolling_windows_shuffle_rows_once(spark):
    p = final_plan(spark, "crossover_signals")
    row_exchanges = re.findall(r"\+- Exchange hashpartitioning\(symbol#\d+L, _b#\d+L", p)
    # one exchange of the rows by (symbol, bucket) plus one of the small carry table;
    # the tail branch reuses the row exchange instead of shuffling the rows again
    assert "ReusedExchange" in p
    assert len(row_exchanges) == 2
    assert "SortMergeJoin" in p and p.count("FileScan parquet") == 1


def test_scans_read_only_used_columns(spark):
    p = final_plan(spark, "crossover_signals")
    scan = re.search(r"FileScan parquet \[([^\]]*)\]", p).group(1)
    assert sorted(re.sub(r"#\d+L?", "", c) for c in scan.split(",")) == ["event_id", "ts", "user_id", "value"]
    assert "isnotnull(user_id" in p


def test_bloom_verdict_does_not_shuffle_tokens(spark):
    p = final_plan(spark, "bloom_verdict")
    assert "BroadcastHashJoin" in p
    assert "SortMergeJoin" not in p and "ShuffledHashJoin" not in p


def test_minhash_signature_is_row_local(spark):
    p = final_plan(spark, "minhash_signature")
    assert "ArrowEvalPython" in p
    assert not re.search(r"Join|Aggregate", p)


def test_latest_quote_aggregates_before_the_shuffle(spark):
    p = final_plan(spark, "latest_per_symbol")
    assert "partial_max_by" in p


def test_window_means_scan_once_without_a_join(spark):
    p = final_plan(spark, "window_ma_join")
    assert p.count("FileScan parquet") == 1
    assert "Join" not in p
    assert "partial_sum(cast(units" in p
