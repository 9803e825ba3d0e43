"""Repeated passages: every byte covered by a 200-byte string that starts somewhere else, too.

Prefix doubling sorts a (position, rank) pair for each byte of the corpus: 16 bytes a byte of text in the first round
alone.  This is another method, which takes from it that a rank names the string that starts at a position (equal
ranks for equal strings) and that unique ranks drop out; there are two lengths and no doubling:

1. *Short strings.*  Each position is represented by an anchor: of the 96 strings of 40 bytes
   that start from it on, the one with the smallest hash.  The choice depends on the position's
   next 135 bytes alone, so equal 200-byte strings have equal anchors.  All positions of one
   anchor are one row: the anchor's rank and the rank of the stretch (the positions' 200-byte
   strings joined).  Sorted by (rank, rank of the stretch), rows fall apart: an anchor that occurs
   once drops out with all its positions; a stretch that occurs twice settles all of its.
2. *200 bytes.*  What is left are the positions at the ends of copied passages.  If all the anchors
   within their 200 bytes are repeated they are ranked one by one at the full length; of equal
   stretches one stands for all.  Ranks are sorted, and repeated ones settle their positions.
3. The settled strings are laid over the texts; what they cover is removed.

Ranks are 64-bit hashes.  Sorting happens in buckets of the rank's leading bits, as many as
the corpus needs to keep a bucket to some megabytes; ranks travel as packed arrays.  Texts are
shuffled by blocks, once; afterwards only those with a repeated anchor are carried on.

A frequent rank is thinned where its texts are, before the shuffle (``sift``): of equal rows in some megabytes of text two
travel, the others are known to be settled; of an anchor with more than ``HOT`` kinds of stretch there, three kinds travel, and the other
rows count as open, which is always right and only costs their ranking at the full length.  So a bucket gets
at most ``2 * (HOT + 1)`` rows of one rank, 24 bytes each, for every ``CHUNK_BYTES`` of text (432 bytes in 8 MB), however often it stands there;
at the full length each block sends a rank once, 8 bytes in 4 MB.

Defined results: a null text is empty; texts under 200 bytes keep all; bytes are those of the
UTF-8 form; rows that share an id are judged by their own texts, rows equal in id and text
repeat each other; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import null_as_empty, pick, release, small_batches, staged, tuning
from .probminhash import _powers, mix

LENGTH, GRAM, SPAN = 200, 40, 96
INSIDE = LENGTH - GRAM - SPAN + 1  # positions after a window's first whose anchors lie within the window, too
SEGMENT = 1 << 19
_ODD = np.uint64(0x9E3779B97F4A7C15)
BUCKET_BYTES, BLOCK_BYTES, CHUNK_BYTES = 8 << 20, 4 << 20, 8 << 20
HOT = 8  # kinds of stretch of one anchor in a chunk of texts, from which on the chunk decides on the rows itself
DECIDED = 1 << 20  # rows decided before the shuffle that travel together

U64, U32, U8 = np.dtype("<u8"), np.dtype("<u4"), np.dtype("u1")


def segments(raw: np.ndarray):
    """(first position, hash function of (local starts, length)) for stretches of ``SEGMENT`` positions."""
    for start in range(0, max(1, len(raw) - GRAM - SPAN + 2), SEGMENT):
        part = raw[start:start + SEGMENT + SPAN + LENGTH]
        up, down = _powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[:len(part)], out=sums[1:])

        def named(at, length, sums=sums, down=down):
            return mix((sums[at + length] - sums[at]) * down[at] + np.asarray(length).astype(np.uint64) * _ODD)
        yield start, len(part), named


def anchors(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rank, rank of the stretch, number of positions) of every anchor in order; a stretch without a whole
    200-byte string has rank 0.  The positions of all anchors are 0, 1, 2 ... without a gap."""
    ranks, stretches, sizes = [], [], []
    if len(raw) < LENGTH:
        return tuple(np.zeros(0, dtype=t) for t in (np.uint64, np.uint64, np.int64))
    for start, n, named in segments(raw):
        grams = named(np.arange(n - GRAM + 1), GRAM)
        low = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
        for step in (1, 2, 4, 8, 16, 32, 32):  # the smallest of 96, the leftmost of equals
            low = np.minimum(low[:-step], low[step:])
        at = (low[:SEGMENT] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        size = np.diff(np.r_[first, len(at)])
        last = np.minimum(first + size - 1, len(raw) - LENGTH - start)  # the last position with a whole string
        whole = first <= last
        a, b, f = first[whole], last[whole], at[first[whole]]
        stretch = np.zeros(len(first), dtype=np.uint64)
        stretch[whole] = mix(named(a, b - a + LENGTH) + mix((f - a).astype(np.uint64) * _ODD + (b - a).astype(np.uint64))) | np.uint64(1)
        ranks.append(mix(grams[at[first]] + _ODD))  # anchors have small hashes: scrambled again, they fill all buckets alike
        stretches.append(stretch)
        sizes.append(size)
    return np.concatenate(ranks), np.concatenate(stretches), np.concatenate(sizes)


UNIQUE, SETTLED, WITNESS, OPEN = 0, 1, 2, 3


def judge(ref: np.ndarray, index: np.ndarray, rank: np.ndarray, stretch: np.ndarray) -> np.ndarray:
    """Sort (rank, stretch) pairs and give each row its state: rank unique; settled, as its stretch is repeated;
    settled, but its positions stand for their kind against other stretches; open."""
    order = np.lexsort((index, ref, stretch, rank))
    r, s = rank[order], stretch[order]
    new_rank = np.r_[True, r[1:] != r[:-1]]
    new_pair = new_rank | np.r_[True, s[1:] != s[:-1]]
    group, pair = np.cumsum(new_rank) - 1, np.cumsum(new_pair) - 1
    kinds = np.bincount(group[new_pair & (s != 0)], minlength=group[-1] + 1 if len(group) else 0)
    often, same = np.bincount(group)[group] > 1, np.bincount(pair)[pair] > 1
    mixed = kinds[group] > 1
    state = np.where(same, np.where(mixed & new_pair, WITNESS, SETTLED), np.where(mixed, OPEN, UNIQUE))
    state = np.where(s == 0, SETTLED, state)  # no string of its own: only its anchor counts
    state[~often] = UNIQUE
    lone = often & ~same & ~mixed & (s != 0)  # the rank's only stretch: its strings occur nowhere else
    state[lone] = SETTLED + 3
    out = np.empty(len(order), dtype=np.uint8)
    out[order] = state
    return out


LONE = SETTLED + 3  # a repeated anchor (not a dead one), but no other stretch has its strings


def sift(rank: np.ndarray, stretch: np.ndarray, hot: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows to be judged together with those of other texts, rows decided here, their states).

    Of equal (rank, stretch) pairs two rows go on: they show that the pair is repeated, the others are settled.  A rank of more than
    ``hot`` kinds of stretch is known to be repeated and mixed: three kinds go on and tell the same to its rows elsewhere, the rows of the other kinds
    are witnesses or open, so they are compared at the full length."""
    order = np.argsort(rank, kind="stable")
    equal = rank[order][1:] == rank[order][:-1]
    often = np.r_[False, equal][:len(order)] | np.r_[equal, False][:len(order)]
    rows = order[often]
    rows = rows[np.lexsort((stretch[rows], rank[rows]))]
    r, s = rank[rows], stretch[rows]
    new_rank = np.r_[True, r[1:] != r[:-1]][:len(r)]
    new_pair = new_rank | np.r_[True, s[1:] != s[:-1]][:len(r)]
    group, pair = np.cumsum(new_rank) - 1, np.cumsum(new_pair) - 1
    place = np.arange(len(r)) - np.flatnonzero(new_pair)[pair]
    kind = pair - pair[new_rank][group]
    many = np.bincount(group[new_pair & (s != 0)], minlength=int(new_rank.sum()))[group] > hot
    on = (place < 2) & (~many | (kind < 3))
    state = np.where(place > 0, SETTLED, np.where(np.bincount(pair)[pair] > 1, WITNESS, OPEN))
    return np.sort(np.r_[order[~often], rows[on]]), rows[~on], state[~on].astype(np.uint8)


def windows(raw: np.ndarray, states: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(settled: whether each position's 200-byte string is known to be repeated; positions still to be ranked)."""
    n = len(raw) - LENGTH + 1
    state = np.repeat(states, sizes)
    dead = np.r_[0, np.cumsum(state == UNIQUE)]
    here = state[:n]
    alive = dead[INSIDE + 1:INSIDE + 1 + n] == dead[:n]
    return (here == SETTLED) | (here == WITNESS), np.flatnonzero(((here == WITNESS) | (here == OPEN)) & alive)


def window_ranks(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = [named(at[(at >= start) & (at < start + SEGMENT)] - start, LENGTH) for start, _, named in segments(raw)] if len(at) else []
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def buckets_of(rank: np.ndarray, bits: int) -> np.ndarray:
    return (rank >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(rank), dtype=np.int64)


def slices(rank: np.ndarray, bits: int):
    """(bucket, row numbers in their old order) for each bucket with rows."""
    bucket = buckets_of(rank, bits)
    order = np.argsort(bucket, kind="stable")
    found, first = np.unique(bucket[order], return_index=True)
    for b, rows in zip(found.tolist(), np.split(order, first[1:])):
        yield b, rows


def raw_texts(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(v.as_buffer(), dtype=np.uint8) if v.is_valid else np.zeros(0, dtype=np.uint8) for v in column]


def covered(repeated: np.ndarray, n: int) -> np.ndarray:
    """Bytes under the 200-byte strings that start at the marked positions."""
    edge = np.zeros(n + 1, dtype=np.int32)
    at = np.flatnonzero(repeated)
    edge[at] += 1
    np.add.at(edge, at + LENGTH, -1)
    return np.cumsum(edge[:n]) > 0


def _pack(*arrays) -> list[bytes]:
    return [np.ascontiguousarray(a).tobytes() for a in arrays]


def short_ranks(docs: DataFrame, bits: int, hot: int, chunk: int) -> DataFrame:
    """Anchor rows of (ref, text), packed by bucket.  Rows decided here travel along, in buckets of their own below zero, with
    their states in place of the stretches."""
    def packed(bucket, ref, index, *columns):
        return bucket, *columns, *_pack(np.diff(ref, prepend=0), np.diff(index, prepend=np.uint32(0)).astype(U32))

    def rows_of(refs, texts):
        found = [anchors(raw) for raw in texts]
        rank, stretch = (np.concatenate([f[i] for f in found]) for i in (0, 1))
        ref = np.repeat(refs, [len(f[0]) for f in found])
        index = np.concatenate([np.arange(len(f[0]), dtype=np.uint32) for f in found])
        del found
        on, decided, state = sift(rank, stretch, hot)
        for b, at in slices(rank[on], bits):
            at = on[at]
            yield packed(b, ref[at], index[at], *_pack(rank[at].astype(U64), stretch[at].astype(U64)))
        for n in range(0, len(decided), DECIDED):
            at = decided[n:n + DECIDED]
            yield packed(-1 - int(mix(ref[at[:1]].astype(np.uint64) + np.uint64(n))[0] >> np.uint64(2)), ref[at], index[at], b"", *_pack(state[n:n + DECIDED]))

    def chunks(batches):
        held, size = [], 0
        for batch in batches:
            for ref, raw in zip(batch.column("ref").to_pylist(), raw_texts(batch.column("text"))):
                if held and size + len(raw) > chunk:
                    yield zip(*held)
                    held, size = [], 0
                held.append((ref, raw))
                size += len(raw) + 16
        if held:
            yield zip(*held)

    def run(batches):
        for refs, texts in chunks(batches):
            rows = list(rows_of(np.array(refs, dtype=np.int64), texts))
            release()
            for i in range(0, len(rows), 256):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i:i + 256]), (pa.int64(), *[pa.binary()] * 4))],
                                                 ["bucket", "rank", "stretch", "ref", "index"])
    return docs.mapInArrow(run, "bucket bigint, rank binary, stretch binary, ref binary, index binary")


def _judge_bucket(table: pa.Table) -> pa.Table:
    def joined(name, dtype, summed=False):
        parts = [np.frombuffer(v.as_buffer(), dtype=dtype) for v in table.column(name)]
        return np.concatenate([np.cumsum(p, dtype=dtype) if summed else p for p in parts])
    ref, index = joined("ref", np.dtype("<i8"), True), joined("index", U32, True)
    state = joined("stretch", U8) if table.column("bucket")[0].as_py() < 0 else judge(ref, index, joined("rank", U64), joined("stretch", U64))
    keep = state != UNIQUE
    release()
    return pa.table([pa.array(ref[keep]), pa.array(index[keep].astype(np.int32)), pa.array(state[keep].astype(np.int8))], ["ref", "index", "state"])


def _gather_block(docs: pa.Table, states: pa.Table) -> pa.Table:
    """The texts of a block that hold a repeated anchor, with their anchors' states, as one row."""
    ref = states.column("ref").to_numpy()
    order = np.argsort(ref, kind="stable")
    ref, index, state = ref[order], states.column("index").to_numpy()[order], states.column("state").to_numpy()[order]
    keep, texts, packed = [], [], []
    refs = docs.column("ref").to_numpy()
    text = docs.column("text").combine_chunks()
    for i in np.argsort(refs, kind="stable").tolist():
        a, b = np.searchsorted(ref, refs[i]), np.searchsorted(ref, refs[i], side="right")
        if a == b:
            continue
        at = index[a:b]
        full = np.zeros(int(at.max()) + 1, dtype=np.uint8)
        np.maximum.at(full, at, np.where(state[a:b] == LONE, 0, state[a:b]).astype(np.uint8))
        lone = np.zeros(len(full), dtype=bool)
        lone[at[state[a:b] == LONE]] = True
        full[lone & (full == 0)] = LONE
        keep.append(int(refs[i]))
        texts.append(text[i].as_py())
        packed.append(full.tobytes())
    block = docs.column("block")[0].as_py() if docs.num_rows and keep else None
    release()
    rows = [[block], [keep], [texts], [packed]] if keep else [[], [], [], []]
    return pa.table([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.list_(pa.int64())), pa.array(rows[2], pa.list_(pa.string())),
                     pa.array(rows[3], pa.list_(pa.binary()))], ["block", "refs", "texts", "states"])


def _open_windows(texts, states):
    """Per text of a block: (bytes, settled positions, positions to be ranked, their ranks)."""
    for text, packed in zip(texts, states):
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
        sizes = anchors(raw)[2]
        state = np.zeros(len(sizes), dtype=np.uint8)
        known = np.frombuffer(packed, dtype=np.uint8)
        state[:len(known)] = known
        settled, at = windows(raw, state, sizes)
        yield raw, settled, at, window_ranks(raw, at)


def long_ranks(blocks: DataFrame, bits: int) -> DataFrame:
    """Ranks at the full length of the positions still open, each once a block, packed by block and bucket."""
    def run(batches):
        for batch in batches:
            for block, texts, states in zip(*(batch.column(c) for c in ("block", "texts", "states"))):
                rank = np.unique(np.concatenate([w[3] for w in _open_windows(texts.as_py(), states.as_py())]))
                rows = [(b, block.as_py(), rank[at].astype(U64).tobytes()) for b, at in slices(rank, bits)]
                release()
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary()))],
                                                     ["bucket", "block", "rank"])
    return blocks.mapInArrow(run, "bucket bigint, block bigint, rank binary")


def _repeated_in_bucket(table: pa.Table) -> pa.Table:
    parts = [np.frombuffer(v.as_buffer(), dtype=U64) for v in table.column("rank")]
    rank = np.concatenate(parts)
    order = np.sort(rank)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    flags = [np.packbits(twice[np.searchsorted(twice[:-1], p)] == p if len(twice) else np.zeros(len(p), dtype=bool)).tobytes() for p in parts]
    release()
    return pa.table([table.column("block"), table.column("bucket"), pa.array(flags, pa.binary())], ["block", "bucket", "flags"])


def _cut_block(bits: int):
    def cut(blocks: pa.Table, flags: pa.Table) -> pa.Table:
        out = ([], [], [], [])
        known = {b: f for b, f in zip(flags.column("bucket").to_pylist(), flags.column("flags").to_pylist())}
        for refs, texts, states in zip(*(blocks.column(c).to_pylist() for c in ("refs", "texts", "states"))):
            found = list(_open_windows(texts, states))
            rank, which, times = np.unique(np.concatenate([f[3] for f in found]), return_inverse=True, return_counts=True)
            again = np.zeros(len(rank), dtype=bool)
            for b, rows in slices(rank, bits):
                again[rows] = np.unpackbits(np.frombuffer(known[b], dtype=np.uint8), count=len(rows)).astype(bool)
            again = (again | (times > 1))[which]
            start = 0
            for ref, (raw, settled, at, mine) in zip(refs, found):
                settled[at[again[start:start + len(mine)]]] = True
                start += len(mine)
                gone = covered(settled, len(raw))
                for col, v in zip(out, (ref, int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(raw[~gone].tobytes()).hexdigest())):
                    col.append(v)
        release()
        return pa.table([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.string()))], ["ref", "n_removed", "n_spans", "kept_sha256"])
    return cut


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, chunk: int = CHUNK_BYTES) -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``.  ``hot`` and ``chunk`` (bytes) say from when on and over how much
    text frequent ranks are thinned before the shuffle; they change the work, never the result."""
    spark = docs.sparkSession
    small_batches(spark)
    src = pick(docs, doc_id=id_col, text=text_col).select("doc_id", null_as_empty(F.col("text")).alias("text")).withColumn("ref", F.xxhash64("doc_id", "text"))
    total = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = tuning(spark)
    bits = max(0, math.ceil(math.log2(max(least, total / 2 / BUCKET_BYTES, 1))))
    n_blocks = max(least, math.ceil(total / BLOCK_BYTES))
    block = F.pmod(F.col("ref"), F.lit(n_blocks)).alias("block")

    states = short_ranks(src.select("ref", "text"), bits, hot, chunk).groupBy("bucket").applyInArrow(_judge_bucket, "ref bigint, index int, state tinyint")
    long_texts = src.where(F.octet_length("text") >= LENGTH).select(block, "ref", "text")
    blocks = staged(long_texts.groupBy("block").cogroup(states.select(block, "ref", "index", "state").groupBy("block")).applyInArrow(
        _gather_block, "block bigint, refs array<bigint>, texts array<string>, states array<binary>"), "repeat-blocks")
    flags = long_ranks(blocks, bits).groupBy("bucket").applyInArrow(_repeated_in_bucket, "block bigint, bucket bigint, flags binary")
    cut = (blocks.groupBy("block").cogroup(flags.groupBy("block")).applyInArrow(
        _cut_block(bits), "ref bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
        .groupBy("ref").agg(*[F.first(c).alias(c) for c in ("n_removed", "n_spans", "kept_sha256")]))  # equal rows have equal results
    rows = src.select("doc_id", "ref", F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2(F.encode("text", "utf-8"), 256).alias("whole"))
    return rows.join(cut, "ref", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("bigint").alias("n_spans"), F.coalesce("kept_sha256", "whole").alias("kept_sha256"))
