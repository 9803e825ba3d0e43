"""Licence scan by canonical digests, in DataFrame expressions only.

A text is brought to a canonical form: lower case; every run of characters that are neither
letters nor digits is one blank; copyright lines are left out of the whole text; words with
several spellings get one.  Its SHA-256 digest is joined to the digests of known licences.
Entire texts are compared: the whole document with whole licence texts, and each line of
it, itself an entire text, with the known notices of one line.

Known texts are a fixed list (a few hundred short rows) and are broadcast.  Only units whose
canonical length is that of a known text are hashed at all: others can't have its digest.
The documents are scanned without a shuffle; what matched is grouped by document id.

Defined results: a null text is empty and matches nothing, like a text without letters and
digits; rows that share an id (a null id too) are reported together as one row; other columns
are ignored; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import null_as_empty, pick
from .license_texts import LICENSES, NOTICES

# Fixed equivalences of spelling, on canonical text.
SPELLINGS = [("licence", "license"), ("sub license", "sublicense"), ("non commercial", "noncommercial"), ("non infringement", "noninfringement"),
             ("copyright owner", "copyright holder"), ("acknowledgement", "acknowledgment"), ("favour", "favor"), ("organisation", "organization"),
             ("recognise", "recognize"), ("wilful", "willful"), ("per cent", "percent"), ("https", "http")]
OTHER = r"[^\p{L}\p{N}\n]+"
COPYRIGHT_LINE = r"^(copyright c( |$)|copyright [0-9]{4}|c [0-9]{4}|all rights reserved$)"


def canonical_lines(text) -> F.Column:
    """The non-empty canonical lines of a text."""
    plain = F.regexp_replace(F.replace(F.lower(null_as_empty(text)), F.lit("©"), F.lit("(c)")), OTHER, " ")
    for old, new in SPELLINGS:
        plain = F.replace(plain, F.lit(old), F.lit(new))
    return F.filter(F.transform(F.split(plain, "\n"), lambda line: F.trim(line)), lambda line: line != "")


def canonical_text(lines) -> F.Column:
    return F.array_join(F.filter(lines, lambda line: ~line.rlike(COPYRIGHT_LINE)), " ")


def known_digests(spark: SparkSession, known: DataFrame | None = None) -> DataFrame:
    """(kind, license, digest, size) of the known texts, by the same expressions as the documents': the fixed list, or the rows (kind
    'text' or 'line', license, text) of ``known``."""
    rows = [F.struct(F.lit(kind).alias("kind"), F.lit(spdx).alias("license"), F.lit(text).alias("text"))
            for kind, known in (("text", LICENSES), ("line", NOTICES)) for spdx, text in known]
    listed = spark.range(1).select(F.explode(F.array(*rows)).alias("k")).select("k.*") if known is None else known.select("kind", "license", "text")
    texts = listed.withColumn("lines", canonical_lines(F.col("text")))
    unit = F.when(F.col("kind") == "text", canonical_text(F.col("lines"))).otherwise(F.array_join("lines", " "))
    return texts.select("kind", "license", F.sha2(unit, 256).alias("digest"), F.length(unit).alias("size")).distinct()


def find_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known_texts: DataFrame | None = None) -> DataFrame:
    """One row per id: ``doc_id``, ``text_licenses`` (whole texts that match), ``n_notices`` (lines that
    match) and ``notice_licenses``; licences as SPDX ids, sorted and comma-joined, '' if none.  ``known_texts`` (kind 'text' or
    'line', license, text) stands in for the fixed list."""
    known = known_digests(docs.sparkSession, known_texts)
    # Units of other lengths than the listed ones are dropped early; a list of the caller's, of any size, is joined as a table.
    sizes = {} if known_texts is not None else {
        k: [r["size"] for r in known.where(F.col("kind") == k).select("size").distinct().collect()] for k in ("text", "line")}
    src = pick(docs, doc_id=id_col, text=text_col)
    lines = src.select("doc_id", canonical_lines(F.col("text")).alias("lines"))
    of_size = lambda kind: lambda u: F.length(u).isin(*sizes[kind]) if sizes else F.lit(True)
    units = lines.select("doc_id", F.concat(
        F.transform(F.filter(F.array(canonical_text(F.col("lines"))), of_size("text")), lambda u: F.struct(F.lit("text").alias("kind"), u.alias("unit"))),
        F.transform(F.filter("lines", of_size("line")), lambda u: F.struct(F.lit("line").alias("kind"), u.alias("unit")))).alias("units"))
    found = (units.select("doc_id", F.explode("units").alias("u")).select("doc_id", "u.kind", F.sha2("u.unit", 256).alias("digest"))
             .join(known.drop("size") if known_texts is not None else F.broadcast(known.drop("size")), ["kind", "digest"])  # a fixed list, or a table
             .groupBy("doc_id").agg(
                 F.array_join(F.sort_array(F.collect_set(F.when(F.col("kind") == "text", F.col("license")))), ",").alias("text_licenses"),
                 F.count(F.when(F.col("kind") == "line", 1)).alias("n_notices"),
                 F.array_join(F.sort_array(F.collect_set(F.when(F.col("kind") == "line", F.col("license")))), ",").alias("notice_licenses"))
             .withColumnRenamed("doc_id", "found_id"))
    ids = src.select("doc_id").distinct()
    return ids.join(found, ids["doc_id"].eqNullSafe(found["found_id"]), "left").select(
        "doc_id", F.coalesce("text_licenses", F.lit("")).alias("text_licenses"), F.coalesce("n_notices", F.lit(0)).cast("bigint").alias("n_notices"),
        F.coalesce("notice_licenses", F.lit("")).alias("notice_licenses"))


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def duckdb_sql(table: str = "documents") -> str:
    """The same report as DuckDB SQL over whole texts."""
    plain = rf"regexp_replace(replace(lower(coalesce(text, '')), '©', '(c)'), '{OTHER}', ' ', 'g')"
    for old, new in SPELLINGS:
        plain = f"replace({plain}, '{old}', '{new}')"
    lines = f"list_filter(list_transform(string_split({plain}, chr(10)), lambda x: trim(x)), lambda x: x <> '')"
    whole = f"array_to_string(list_filter(lines, lambda x: NOT regexp_matches(x, '{COPYRIGHT_LINE}')), ' ')"
    values = ",\n".join(f"('{kind}', '{spdx}', {_sql_text(text)})" for kind, known in (("text", LICENSES), ("line", NOTICES)) for spdx, text in known)
    return rf"""
WITH listed(kind, license, text) AS (VALUES
{values}),
known AS (SELECT DISTINCT kind, license, sha256(CASE WHEN kind = 'text' THEN {whole} ELSE array_to_string(lines, ' ') END) AS digest
          FROM (SELECT *, {lines} AS lines FROM listed)),
docs AS (SELECT doc_id, {lines} AS lines FROM {table}),
units AS (SELECT doc_id, 'text' AS kind, sha256({whole}) AS digest FROM docs
          UNION ALL SELECT doc_id, 'line', sha256(unnest(lines)) FROM docs),
found AS (SELECT doc_id, kind, license FROM units JOIN known USING (kind, digest))
SELECT i.doc_id,
       coalesce((SELECT string_agg(DISTINCT license, ',' ORDER BY license) FROM found f WHERE f.doc_id IS NOT DISTINCT FROM i.doc_id AND kind = 'text'), '') AS text_licenses,
       (SELECT count(*) FROM found f WHERE f.doc_id IS NOT DISTINCT FROM i.doc_id AND kind = 'line') AS n_notices,
       coalesce((SELECT string_agg(DISTINCT license, ',' ORDER BY license) FROM found f WHERE f.doc_id IS NOT DISTINCT FROM i.doc_id AND kind = 'line'), '') AS notice_licenses
FROM (SELECT DISTINCT doc_id FROM {table}) i"""
