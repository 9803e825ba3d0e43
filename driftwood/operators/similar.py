"""Similar documents from MinHash signatures: wide signatures, band candidates, agreement, exact Jaccard.

The 1119 values of the short family (``minhash``) are all taken by a long text, whose minima are then 0 whatever
its words.  ``wide_signatures`` takes the same shingles modulo the prime 2^31 - 1, with
``h_i(x) = (a_i x + 100 i + 2) mod P`` and ``a_i = G^(i+1) mod P``: powers, as multiples of one another would make a
word that is small under one function small under all.

*Candidates* (``band_links``).  ``bands`` keys of ``rows`` signature entries each; documents that share a key meet in a
bucket, and every member is linked to the bucket's smallest id.  The smallest id is a partial aggregate joined back, so
a bucket's members are never listed and links number at most members x bands, however large a bucket is.  Documents
without shingles have no signature and no links.  With ``every``, all pairs of a bucket's members are linked, by *cells*:
the members are dealt to blocks, and a cell holds one block or two, so that no task has to hold a large bucket.

*Agreement* (``agreement``) estimates the Jaccard index of a link from two signatures; *verification* (``exact_jaccard``) intersects
the word sets of linked documents alone.  Links with cells are verified cell by cell: a text travels once to each of its
cells, not once for each of its links.  ``copies`` and ``of_documents`` leave one text of equal ones to be compared.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructType

from ..functions.hashing import md5_u32
from ..functions.text import whitespace_tokens
from ..session import ship_package
from .sizing import bounded_broadcast, materialize

PRIME = (1 << 31) - 1
GENERATOR = 48271
BANDS, ROWS = 32, 4
CHUNK = 4096  # words of a document that meet all functions at once
CELL = ("bucket", "lo", "hi")
BLOCK = 512  # members of a bucket that are dealt to one block, on average
UNIT_BYTES, BATCH_BYTES = 8 << 20, 4 << 20  # rows that a task handles at once (a cell at least), and gets at once
PAIRS = 1 << 16  # pairs whose buckets are compared at once
DENSE, WIDTH = 64, 1 << 13  # links of a cell that are worth a matrix product, and the words it takes at once


def multipliers(n: int) -> list[int]:
    out, a = [], 1
    for _ in range(n):
        a = a * GENERATOR % PRIME
        out.append(a)
    return out


def word_values(text: Column) -> Column:
    """The distinct words' hashes modulo P."""
    return F.array_distinct(F.transform(F.array_distinct(whitespace_tokens(text)), lambda w: F.pmod(md5_u32(w), F.lit(PRIME))))


@functools.lru_cache(maxsize=8)
def _minima_udf(num_hashes: int):
    @F.pandas_udf("array<bigint>")
    def minima(values: pd.Series) -> pd.Series:
        a = np.array(multipliers(num_hashes), dtype=np.int64)[:, None]
        b = 100 * np.arange(num_hashes, dtype=np.int64)[:, None] + 2
        out = []
        for v in values:
            if v is None or not len(v):
                out.append(None)
                continue
            v = np.asarray(v, dtype=np.int64)
            out.append(np.min([((a * v[i:i + CHUNK] + b) % PRIME).min(axis=1) for i in range(0, len(v), CHUNK)], axis=0))
        return pd.Series(out, dtype=object)
    return minima


def wide_signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", num_hashes: int = BANDS * ROWS) -> DataFrame:
    """``(doc_id, signature array<bigint>)``; a text without shingles has none (null)."""
    ship_package(docs.sparkSession)
    v = docs.select(F.col(id_col).alias("doc_id"), word_values(F.col(text_col)).alias("_v"))
    return v.select("doc_id", _minima_udf(num_hashes)(F.col("_v")).alias("signature"))


def band_rows(signatures: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``(doc_id, band, key)``: a row for each band of a document that has a signature.  A key holds the band's entries, two to
    a number (they are below 2^31), as a row for every band is what is shuffled most."""
    def key(b: Column) -> Column:
        entry = [F.element_at("signature", (b * rows + i + 1).cast("int")) for i in range(rows)]
        return F.struct(*[sum((e * (1 << 31 * k) for k, e in enumerate(entry[i:i + 2])), F.lit(0).cast("bigint")).alias(f"k{i // 2}") for i in range(0, rows, 2)])
    keys = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), key)
    return signatures.filter("signature IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", F.posexplode(keys).alias("band", "key"))


def band_links(signatures: DataFrame, bands: int = BANDS, rows: int = ROWS, every: bool = False) -> DataFrame:
    """``(doc_a, doc_b)``, each once: documents with the smallest id of a bucket they are in, ``doc_a < doc_b``.  With ``every``
    (an id has one row then) ``(doc_a, doc_b, bucket, lo, hi)``: all pairs that share a bucket, each once, with the cell it is from."""
    members = band_rows(signatures, bands, rows)
    if every:
        return _all_pairs(members, bands)
    heads = members.groupBy("band", "key").agg(F.min("doc_id").alias("doc_a"), F.max("doc_id").alias("most")).filter("doc_a <> most").drop("most")
    return members.join(heads, ["band", "key"]).filter("doc_id <> doc_a").select("doc_a", F.col("doc_id").alias("doc_b")).distinct()


def _all_pairs(members: DataFrame, bands: int) -> DataFrame:
    """A pair that shares several buckets is left to the largest, so that texts travel to few: each member brings the list of its buckets,
    which are numbered from the largest on."""
    spark = members.sparkSession
    several = members.groupBy("band", "key").agg(F.count("*").alias("n")).filter("n > 1").orderBy(F.desc("n"))
    buckets = materialize(several.withColumn("bucket", F.monotonically_increasing_id() * bands + F.col("band")), "buckets")  # written, so that a number stays
    inside = members.join(buckets, ["band", "key"]).select("doc_id", "bucket", F.ceil(F.col("n") / F.lit(BLOCK)).cast("int").alias("_blocks"))
    inside = inside.withColumn("shared", F.collect_list("bucket").over(Window.partitionBy("doc_id")))
    own = F.pmod(F.xxhash64("doc_id"), F.col("_blocks")).cast("int")
    dealt = inside.withColumn("own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    cells = dealt.select("bucket", F.least("own", "_other").alias("lo"), F.greatest("own", "_other").alias("hi"), "own", "doc_id", "shared")
    kind = members.schema["doc_id"].dataType
    schema = StructType().add("a", kind).add("b", kind).add("bucket", LongType()).add("lo", IntegerType()).add("hi", IntegerType())
    pairs = _by_cell(spark, cells, "own").mapInArrow(functools.partial(_pairs_of_cells, bands=bands), schema)
    return pairs.select(F.least("a", "b").alias("doc_a"), F.greatest("a", "b").alias("doc_b"), *CELL)


def _by_cell(spark: SparkSession, rows: DataFrame, then: str) -> DataFrame:
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return rows.repartition(n, *CELL).sortWithinPartitions(*CELL, then)


def _starts(table: pa.Table) -> np.ndarray:
    """Where a cell begins, of rows in the order of cells."""
    new = np.zeros(table.num_rows, dtype=bool)
    new[:1] = True
    for c in CELL:
        v = table.column(c).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole cells, of some ``UNIT_BYTES``."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.nbytes
        if size < UNIT_BYTES:
            continue
        table = pa.Table.from_batches(held)
        cut = int(_starts(table)[-1])
        if cut:
            yield table.slice(0, cut).combine_chunks()
        held = table.slice(cut).to_batches()
        size = sum(b.nbytes for b in held)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _column(table: pa.Table, name: str) -> pa.Array:
    c = table.column(name).combine_chunks()
    return pa.concat_arrays(c.chunks) if isinstance(c, pa.ChunkedArray) else c


def _places(starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of rows of every cell: of one block, or of the ``first`` rows with the others where these are of two blocks."""
    sizes = ends - starts
    one = first == sizes
    for size in np.unique(sizes[one]):
        a, b = np.triu_indices(int(size), 1)
        at = starts[one & (sizes == size)][:, None]
        step = max(1, PAIRS // max(len(a), 1))
        for i in range(0, len(at) if len(a) else 0, step):
            yield (at[i:i + step] + a).ravel(), (at[i:i + step] + b).ravel()
    for s, m, e in zip(starts[~one], first[~one], ends[~one]):
        right = np.arange(s + m, e)
        step = max(1, PAIRS // len(right))
        for i in range(s, s + m, step):
            left = np.arange(i, min(i + step, s + m))
            yield np.repeat(left, len(right)), np.tile(right, len(left))


def _pairs_of_cells(batches: Iterator[pa.RecordBatch], bands: int) -> Iterator[pa.RecordBatch]:
    for table in _units(batches):
        n, starts = table.num_rows, _starts(table)
        ends = np.append(starts[1:], n)
        bucket, lo, hi, own = (table.column(c).to_numpy() for c in (*CELL, "own"))
        ids, shared = _column(table, "doc_id"), _column(table, "shared")
        flat = shared.flatten().to_numpy()
        of_band = np.full((n, bands), -1, dtype=np.int64)
        of_band[np.repeat(np.arange(n), shared.value_lengths().to_numpy()), flat % bands] = flat
        first = np.where(lo[starts] == hi[starts], ends - starts, np.add.reduceat((own == lo).astype(np.int64), starts))
        two = (lo[starts] != hi[starts]) & ((first == 0) | (first == ends - starts))  # a block of nobody
        for x, y in _places(starts[~two], ends[~two], first[~two]):
            mine = of_band[x]
            common = np.where((mine == of_band[y]) & (mine >= 0), mine, np.iinfo(np.int64).max)
            here = common.min(axis=1) == bucket[x]
            x, y = x[here], y[here]
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(x)), ids.take(pa.array(y)), *(pa.array(v[x]) for v in (bucket, lo, hi))], ["a", "b", *CELL])


def agreement(links: DataFrame, signatures: DataFrame) -> DataFrame:
    """``(doc_a, doc_b, n_equal, estimate, standard_error)``: the share of equal signature entries estimates the Jaccard index of
    the shingle sets, with the binomial standard error."""
    a = signatures.select(F.col("doc_id").alias("doc_a"), F.col("signature").alias("_a"))
    b = signatures.select(F.col("doc_id").alias("doc_b"), F.col("signature").alias("_b"))
    same = F.zip_with("_a", "_b", lambda x, y: (x == y).cast("bigint"))
    j = links.join(a, "doc_a").join(b, "doc_b").select("doc_a", "doc_b", F.size("_a").alias("_n"), F.aggregate(same, F.lit(0).cast("bigint"), lambda s, x: s + x).alias("n_equal"))
    e = F.col("n_equal").cast("double") / F.col("_n").cast("double")
    return j.select("doc_a", "doc_b", "n_equal", e.alias("estimate"), F.sqrt(e * (1 - e) / F.col("_n").cast("double")).alias("standard_error"))


def word_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, words, n)``: the distinct words of every text that has any, as one string, and their number."""
    words = F.array_distinct(whitespace_tokens(F.col(text_col)))  # without blanks, so that joining them by one can be undone
    return (docs.select(F.col(id_col).alias("doc_id"), words.alias("words")).filter(F.size("words") > 0)
            .select("doc_id", F.array_join("words", " ").alias("words"), F.size("words").cast("bigint").alias("n")))


def _share(n_common: Column, n_union: Column) -> Column:
    """Rows that share an id count together, so that a union can come out as 0."""
    return F.when(n_union == 0, F.lit(float("inf"))).otherwise(n_common.cast("double") / n_union.cast("double"))


def exact_jaccard(links: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_a, doc_b, n_common, n_union, jaccard)`` of the distinct shingles of every link.  Only linked documents' words
    take part, and a link meets its own two documents' words only: a document's distinct words travel as one string, not as
    a row each.  Rows that share an id count together.  Links with cells are verified by cell; an id has one row then, and
    ``docs`` can be ``word_sets`` already."""
    if set(CELL) <= set(links.columns):
        return _cell_jaccard(links, docs if docs.columns == ["doc_id", "words", "n"] else word_sets(docs, id_col, text_col))
    asked = links.select(F.col("doc_a").alias("doc_id")).unionAll(links.select("doc_b")).distinct()
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(asked, "doc_id", "left_semi")
    sets = word_sets(src)
    sizes = sets.groupBy("doc_id").agg(F.sum("n").alias("n"))
    a = sets.select(F.col("doc_id").alias("doc_a"), F.col("words").alias("_a"))
    b = sets.select(F.col("doc_id").alias("doc_b"), F.col("words").alias("_b"))
    n_common = F.size(F.array_intersect(F.split("_a", " "), F.split("_b", " "))).cast("bigint")
    common = (links.join(a, "doc_a").join(b, "doc_b").select("doc_a", "doc_b", n_common.alias("n_common"))
              .groupBy("doc_a", "doc_b").agg(F.sum("n_common").alias("n")))
    j = (common.join(sizes.select(F.col("doc_id").alias("doc_a"), F.col("n").alias("_na")), "doc_a")
         .join(sizes.select(F.col("doc_id").alias("doc_b"), F.col("n").alias("_nb")), "doc_b"))
    j = j.select("doc_a", "doc_b", F.col("n").alias("n_common"), (F.col("_na") + F.col("_nb") - F.col("n")).alias("n_union"))
    return j.withColumn("jaccard", _share(F.col("n_common"), F.col("n_union")))


def _cell_jaccard(links: DataFrame, sets: DataFrame) -> DataFrame:
    spark, kind = links.sparkSession, links.schema["doc_a"].dataType
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    packed = sets.select("doc_id", F.col("words").cast("binary").alias("words")).mapInArrow(_packed, StructType().add("doc_id", kind).add("words", BinaryType()))
    ends = links.select(*CELL, F.col("doc_a").alias("doc_id")).unionAll(links.select(*CELL, "doc_b")).distinct()
    texts = ends.join(packed, "doc_id").select(*CELL, F.col("doc_id").alias("doc_a"), F.lit(None).cast(kind).alias("doc_b"), "words")
    rows = texts.unionAll(links.select(*CELL, "doc_a", "doc_b", F.lit(None).cast("binary")))
    schema = StructType().add("doc_a", kind).add("doc_b", kind).add("n_common", LongType()).add("n_union", LongType())
    found = _by_cell(spark, rows, "doc_b").mapInArrow(_verified_cells, schema)
    return found.withColumn("jaccard", _share(F.col("n_common"), F.col("n_union")))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words in order, compressed behind the number of their bytes: a text travels to several cells."""
    codec = pa.Codec("zstd", compression_level=3)
    for batch in batches:
        out = []
        for words in batch.column("words").to_pylist():
            words = b" ".join(sorted(words.split(b" ")))
            out.append(len(words).to_bytes(4, "little") + codec.compress(words, asbytes=True))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", "words"])


def _unpacked(words: pa.Array) -> pa.Array:
    codec = pa.Codec("zstd")
    return pa.array([codec.decompress(w[4:], int.from_bytes(w[:4], "little"), asbytes=True) for w in words.to_pylist()], pa.binary())


def _verified_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in _units(batches):
        begins = np.zeros(table.num_rows, dtype=np.int64)
        begins[_starts(table)] = 1
        cell = np.cumsum(begins) - 1
        link = _column(table, "doc_b").is_valid()
        is_link = link.to_numpy(zero_copy_only=False)
        texts, links = table.filter(pc.invert(link)), table.filter(link)
        if not links.num_rows or not texts.num_rows:
            continue
        a, b = _column(links, "doc_a"), _column(links, "doc_b")
        ids = pa.concat_arrays([_column(texts, "doc_a"), a, b]).dictionary_encode().indices.to_numpy().astype(np.int64)
        ids += (ids.max() + 1) * np.concatenate([cell[~is_link], cell[is_link], cell[is_link]])
        mine, wanted = ids[:texts.num_rows], ids[texts.num_rows:]
        order = np.argsort(mine)
        place = order[np.minimum(np.searchsorted(mine, wanted, sorter=order), len(order) - 1)]
        known = (mine[place] == wanted).reshape(2, -1).all(axis=0)
        x, y = place.reshape(2, -1)[:, known]
        words = pc.split_pattern(_unpacked(_column(texts, "words")), b" ")
        sizes = words.value_lengths().to_numpy().astype(np.int64)
        codes = words.flatten().dictionary_encode()
        common = _common(x, y, cell[is_link][known], codes.indices.to_numpy(), np.concatenate([[0], np.cumsum(sizes)]), len(codes.dictionary))
        keep = pa.array(known)
        yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep), pa.array(common), pa.array(sizes[x] + sizes[y] - common)], ["doc_a", "doc_b", "n_common", "n_union"])


def _common(x: np.ndarray, y: np.ndarray, cell: np.ndarray, codes: np.ndarray, at: np.ndarray, n_codes: int) -> np.ndarray:
    """How many words the texts ``x`` and ``y`` have in common; the distinct words of text ``t`` are ``codes[at[t]:at[t + 1]]``."""
    out = np.zeros(len(x), dtype=np.int64)
    cuts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1], [True]])) if len(x) else np.zeros(1, dtype=np.int64)
    mark = np.zeros(n_codes, dtype=bool)
    for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if e - s >= DENSE:
            out[s:e] = _products(x[s:e], y[s:e], codes, at, n_codes)
            continue
        for i in range(s, e):
            words = codes[at[x[i]]:at[x[i] + 1]]
            mark[words] = True
            out[i] = np.count_nonzero(mark[codes[at[y[i]]:at[y[i] + 1]]])
            mark[words] = False
    return out


def _products(x: np.ndarray, y: np.ndarray, codes: np.ndarray, at: np.ndarray, n_codes: int) -> np.ndarray:
    """The same of many links between few texts, from the product of the table of texts by words with itself."""
    texts, which = np.unique(np.concatenate([x, y]), return_inverse=True)
    words = np.concatenate([codes[at[t]:at[t + 1]] for t in texts])
    row = np.repeat(np.arange(len(texts)), at[texts + 1] - at[texts])
    several = np.bincount(words, minlength=n_codes) > 1
    column = (np.cumsum(several) - 1)[words]
    row, column = row[several[words]], column[several[words]]
    width = int(several.sum())
    out = np.zeros((len(texts), len(texts)), dtype=np.int64)
    if width > WIDTH:
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
    for w in range(0, width, WIDTH):
        s, e = (np.searchsorted(column, [w, w + WIDTH]) if width > WIDTH else (0, len(column)))
        table = np.zeros((len(texts), min(WIDTH, width - w)), dtype=np.float32)
        table[row[s:e], column[s:e] - w] = 1
        out += (table @ table.T).astype(np.int64)  # whole numbers up to WIDTH: exact
    return out[which[:len(x)], which[len(x):]]


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(row, doc_id, words, n, digest)``, to be written before use: ``row`` numbers the texts with words of documents with an id."""
    sets = word_sets(docs.filter(F.col(id_col).isNotNull()), id_col, text_col)
    return sets.select(F.monotonically_increasing_id().alias("row"), "doc_id", "words", "n", F.unhex(F.sha2("words", 256)).alias("digest"))


def copies(texts: DataFrame) -> DataFrame:
    """``(row, doc_id, n, node)`` of ``text_rows``: the first row with the same words."""
    heads = texts.groupBy("digest").agg(F.min("row").alias("node"))
    return texts.select("row", "doc_id", "n", "digest").join(heads, "digest").select("row", "doc_id", "n", "node")


def first_texts(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """``word_sets`` of the nodes, under their numbers."""
    others, _ = bounded_broadcast(rows.filter("row <> node").select("row"), name="others")
    return texts.select("row", "words", "n").join(others, "row", "left_anti").withColumnRenamed("row", "doc_id")


def of_documents(pairs: DataFrame, links: DataFrame, texts: DataFrame, rows: DataFrame) -> DataFrame:
    """``(doc_a, doc_b, n_common, n_union, jaccard)`` of the documents of ``pairs`` (of nodes, from ``exact_jaccard`` of ``links``), and of
    documents of one node.  A document that has one text several times counts it as often; one with several texts is verified
    against its partners by itself."""
    per = materialize(rows.groupBy("doc_id").agg(F.min("node").alias("node"), F.max("node").alias("most"), F.count("*").alias("times"), F.max("n").alias("n")), "documents")
    plain = per.filter("node = most").select("node", "doc_id", "times", "n")
    side, _ = bounded_broadcast(plain, name="side")
    a, b = (side.select(F.col("node").alias(f"doc_{x}"), F.col("doc_id").alias(f"_{x}"), F.col("times").alias(f"_t{x}"), (F.col("times") * F.col("n")).alias(f"_n{x}")) for x in "ab")
    far = pairs.join(a, "doc_a").join(b, "doc_b").select("_a", "_b", (F.col("_ta") * F.col("_tb") * F.col("n_common")).alias("n_common"), (F.col("_na") + F.col("_nb")).alias("_n"))
    # Documents of one node: each meets the block of those that may be its partners.
    many = plain.join(plain.groupBy("node").agg(F.count("*").alias("_k")).filter("_k > 1"), "node").withColumn("_blocks", F.ceil(F.col("_k") / F.lit(BLOCK)).cast("int"))
    a = many.select("node", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_block"), F.col("doc_id").alias("_a"), F.col("times").alias("_ta"))
    b = many.select("node", F.pmod(F.xxhash64("doc_id"), F.col("_blocks")).cast("int").alias("_block"), F.col("doc_id").alias("_b"), F.col("times").alias("_tb"), "n")
    near = a.join(b, ["node", "_block"]).filter("_a < _b").select("_a", "_b", (F.col("_ta") * F.col("_tb") * F.col("n")).alias("n_common"), ((F.col("_ta") + F.col("_tb")) * F.col("n")).alias("_n"))
    out = far.unionAll(near).select(F.least("_a", "_b").alias("doc_a"), F.greatest("_a", "_b").alias("doc_b"), "n_common", (F.col("_n") - F.col("n_common")).alias("n_union"))
    out = out.withColumn("jaccard", _share(F.col("n_common"), F.col("n_union")))
    mixed = per.filter("node <> most").select("doc_id")
    if mixed.isEmpty():
        return out
    nodes = rows.select("doc_id", "node").distinct()
    ends = links.select("doc_a", "doc_b").unionAll(links.select("doc_b", "doc_a")).unionAll(nodes.select("node", "node").distinct()).toDF("node", "_other")
    met = nodes.join(mixed, "doc_id").join(ends, "node").select(F.col("doc_id").alias("_a"), F.col("_other").alias("node")).join(nodes, "node").filter("_a <> doc_id")
    asked = materialize(met.select(F.least("_a", "doc_id").alias("doc_a"), F.greatest("_a", "doc_id").alias("doc_b")).distinct(), "mixed")
    return out.unionAll(exact_jaccard(asked, texts, text_col="words"))
