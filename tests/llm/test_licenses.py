"""Licence digests: equal texts in other spelling are found, others aren't; expressions only; same as SQL."""

import os
import sys

from driftwood.llm import licenses
from driftwood.llm.license_texts import LICENSES
from driftwood.llm.queries import ORACLE, op4_licenses
from llm_helpers import SF_SMALL, by_id

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))
SCHEMA = "doc_id bigint, text string, digest string"


def test_whole_texts_and_lines(spark):
    texts = dict(LICENSES)
    mit = texts["MIT"].replace("2020 Holder", "1999-2003, Some Body <a@b.c>").upper().replace("SUBLICENSE", "SUB-LICENCE").replace(" ", " \t ")
    rows = [(1, mit), (2, texts["BSD-3-Clause"] + "\n© 2011 Other\nAll rights reserved."), (3, texts["MIT"] + " one more word"),
            (4, "intro\n  // Licenced? no\n * Released under the MIT Licence!\n\nSPDX-License-Identifier: Apache-2.0\nLicensed under CC BY-NC 4.0."),
            (5, None), (6, ""), (7, "..."), (8, "This is not released under the MIT License."), (9, "MIT")]
    got = by_id(licenses.find_licenses(spark.createDataFrame([(i, t, "clash") for i, t in rows], SCHEMA)))
    assert {i: (r.text_licenses, r.n_notices, r.notice_licenses) for i, r in got.items()} == {
        1: ("MIT", 1, "MIT"), 2: ("BSD-3-Clause", 1, "BSD-3-Clause"), 3: ("", 1, "MIT"), 4: ("", 3, "Apache-2.0,CC-BY-NC-4.0,MIT"),
        5: ("", 0, ""), 6: ("", 0, ""), 7: ("", 0, ""), 8: ("", 0, ""), 9: ("", 1, "MIT")}


def test_repeated_ids_nulls_and_no_rows(spark):
    rows = [(1, "MIT License", ""), (1, "ISC License", ""), (None, "MIT License", ""), (None, "none", ""), (2, "x" * 1_000_000, "")]
    got = by_id(licenses.find_licenses(spark.createDataFrame(rows, SCHEMA)))
    assert {i: (r.n_notices, r.notice_licenses) for i, r in got.items()} == {1: (2, "ISC,MIT"), None: (1, "MIT"), 2: (0, "")}
    assert licenses.find_licenses(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_equals_sql(spark):
    import oracle_check
    line = oracle_check.compare(spark, oracle_check.duck(SF_SMALL), "op4", op4_licenses, ORACLE["op4_licenses"], SF_SMALL)
    assert line.startswith("OK"), line


def test_expressions_only(spark):
    plan = op4_licenses(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas", "ExistingRDD"))


def test_a_table_of_known_texts(spark):
    from driftwood.llm import licenses
    docs = spark.createDataFrame([(1, "Copyright (c) 2020 Me\nYou MAY use this, freely!"), (2, "other"), (3, "x\nSee THE house-rules\ny")], "doc_id long, text string")
    known = spark.createDataFrame([("text", "House-1", "you may use this freely"), ("line", "House-2", "see the house rules")], "kind string, license string, text string")
    got = {r.doc_id: (r.text_licenses, r.n_notices, r.notice_licenses) for r in licenses.find_licenses(docs, known_texts=known).collect()}
    assert got == {1: ("House-1", 0, ""), 2: ("", 0, ""), 3: ("", 1, "House-2")}
