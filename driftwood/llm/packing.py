"""Packing by patterns fitted with non-negative least squares.

1. Texts are tokenized once, row-locally; documents longer than a sequence are cut into full
   pieces and a rest.  The pieces (without their ids) are staged as a table; a piece carries the
   task that made it and its number among that task's pieces of the same length.
2. Only the histogram of piece lengths, at most ``size`` numbers whatever the corpus, comes to
   the driver.  There patterns of two or three lengths that fill a sequence are enumerated,
   their repeat counts are fitted to the histogram by non-negative least squares, rounded and
   used as far as the histogram allows; what is left is packed best-fit by decreasing length,
   counts at a time.  The plan's size depends on ``size`` alone.
3. Pieces are numbered per length (prefix sums over the tasks' counts, no sort of the pieces,
   no key held in one place) and look up their sequence and offset in the plan.

Defined results: null text is empty and is packed as its end token alone; repeated rows and
null ids are packed like any other row; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, pick, staged

SIZE = 2048
END_ID = 0

# A chunk that is split into one word and one run of punctuation (contractions have an apostrophe).
SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)\Z")
CACHED = 500_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 bytes stand
    for themselves, the others for the code points from 256 on, in order."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, spare = [], 0
    for b in range(256):
        out.append(chr(b if b in own else 256 + spare))
        spare += b not in own
    return out


LETTERS = byte_letters()


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class TokenCache(dict):
    """Blank-free chunk -> its ids as little-endian unsigned 32-bit bytes.

    No token spans white space, so a text's ids are those of its chunks in order and each distinct
    chunk is tokenized once per task.  The cache is emptied when it is full."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # strings of special tokens in a text are text
        self.words = self.tokenizer.model  # for a single word in lower case; holds its own reference
        self[""] = b""
        self.parts: dict[str, bytes] = {}

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _word(self, word: str) -> bytes:
        """One word of Latin letters: normalising and splitting would leave it as it is."""
        got = self.parts.get(word)
        if got is None:
            if len(self.parts) >= CACHED:
                self.parts.clear()
            tokens = self.words.tokenize("".join([LETTERS[b] for b in word.encode()]))
            got = self.parts[word] = struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])
        return got

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= CACHED:
            self.clear()
            self[""] = b""
        m = SIMPLE.match(chunk)
        ids = self._word(m[1].lower()) + (self[m[2]] if m[2] else b"") if m else self._ids(chunk)
        if len(chunk) <= 64:
            self[chunk] = ids
        return ids

    def ids(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def cut_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, size: int = SIZE) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32``, and ``part, nth`` that number
    the pieces of a length within the task that made them.  Must be staged before it is used twice."""
    src = pick(docs, doc_id=id_col, text=text_col)
    kind = src.schema["doc_id"].dataType.simpleString()
    path = path or tokenizer_path()
    end = np.array([END_ID], dtype="<u4").tobytes()

    def make():
        cache, seen = TokenCache(path), defaultdict(int)
        part = TaskContext.get().partitionId()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows, cols = [], [[] for _ in range(5)]
            piece, start, length, crc, nth = cols
            for i, text in enumerate(batch.column("text")):
                ids = cache.ids(text.as_py() or "") + end
                for k in range(0, len(ids), 4 * size):
                    cut = ids[k:k + 4 * size]
                    n = len(cut) // 4
                    rows.append(i)
                    for col, v in zip(cols, (k // (4 * size), k // 4, n, zlib.crc32(cut), seen[n])):
                        col.append(v)
                    seen[n] += 1
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
                 *(pa.array(c, pa.int64()) for c in (start, length, crc, nth)), pa.array([part] * len(rows), pa.int32())],
                ["doc_id", "piece", "start", "length", "ids_crc32", "nth", "part"])
        return step
    return map_batches(src, make, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, nth bigint, part int")


def patterns(present: np.ndarray, size: int) -> np.ndarray:
    """Rows of three lengths (0: none), longest first: a full sequence or, for every one or two
    present lengths, the longest present length that still fits beside them."""
    fit = np.zeros(size + 1, dtype=np.int64)  # the longest present length up to n
    fit[present] = present
    fit = np.maximum.accumulate(fit)
    a, b = (x.ravel() for x in np.meshgrid(present, np.append(present, 0), indexing="ij"))
    keep = (b <= a) & (a + b <= size)
    a, b = a[keep], b[keep]
    c = np.minimum(fit[size - a - b], size)
    keep = (c <= b) | (b == 0)
    triple = np.sort(np.stack([a, b, c], axis=1)[keep], axis=1)[:, ::-1]
    return np.unique(triple, axis=0)


def fit_counts(pats: np.ndarray, counts: np.ndarray, size: int, steps: int = 150) -> np.ndarray:
    """Repeat counts >= 0 that minimise the weighted squared difference between the lengths used and
    the histogram plus the squared unused room, by accelerated projected gradient steps."""
    weight = np.sqrt(np.arange(size + 1) / size)  # a long document left over costs more than a short one
    weight[0] = 0.0
    room = (size - pats.sum(axis=1)) / size
    w = weight[pats]
    # Largest curvature, from a few power iterations.
    def apply(x):
        return np.bincount(pats.ravel(), (w * x[:, None]).ravel(), size + 1)

    def back(r):
        return (w * r[pats]).sum(axis=1)
    v = np.ones(len(pats))
    for _ in range(8):
        v = back(apply(v)) + room * (room @ v)
        top = np.linalg.norm(v)
        v /= top
    target, x = weight * counts, np.zeros(len(pats))
    y, t = x.copy(), 1.0
    for _ in range(steps):
        grad = back(apply(y) - target) + room * (room @ y)
        new = np.maximum(0.0, y - grad / (1.05 * top))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def plan_packing(histogram: dict[int, int], size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, longest first; how many such sequences) for all pieces of the histogram."""
    left = np.zeros(size + 1, dtype=np.int64)
    for n, c in histogram.items():
        left[n] += c
    plan: list[tuple[tuple[int, ...], int]] = []
    if left[size]:
        plan.append(((size,), int(left[size])))
        left[size] = 0
    present = np.flatnonzero(left)
    if len(present):
        pats = patterns(present, size)
        x = fit_counts(pats, left.astype(float), size)
        order = np.lexsort((-x, pats.sum(axis=1) != size))
        total = np.cumsum(x[order])
        repeats = np.diff(np.floor(total + 0.5), prepend=0).astype(np.int64)  # rounding that keeps the running total
        for i in np.flatnonzero(repeats):
            lengths = [int(n) for n in pats[order[i]] if n]
            need = {n: lengths.count(n) for n in lengths}
            times = min(int(repeats[i]), *(int(left[n]) // k for n, k in need.items()))
            if times > 0:
                plan.append((tuple(lengths), times))
                for n, k in need.items():
                    left[n] -= k * times
    return plan + best_fit(plan_open(plan, size), left, size)


def plan_open(plan: list, size: int) -> dict[int, list]:
    """Takes the patterns with room out of ``plan``, by room: the rest may still go there."""
    room: dict[int, list] = defaultdict(list)
    for lengths, times in [p for p in plan if sum(p[0]) < size]:
        room[size - sum(lengths)].append([lengths, times])
    plan[:] = [p for p in plan if sum(p[0]) == size]
    return room


def best_fit(room: dict[int, list], left: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit by decreasing length over counts: as many equal bins at a time as the length has pieces."""
    for n in np.flatnonzero(left)[::-1].tolist():
        count = int(left[n])
        while count:
            space = min((r for r, bins in room.items() if r >= n and bins), default=None)
            if space is None:
                room[size].append([(), -(-count // (size // n))])
                space = size
            lengths, times = room[space].pop()
            each = min(space // n, count)
            full = min(times, count // each)
            if full < times:
                room[space].append([lengths, times - full])
            room[space - each * n].append([lengths + (n,) * each, full])
            count -= each * full
    return [(lengths, times) for bins in room.values() for lengths, times in bins if lengths and times]


def slot_table(plan: list) -> dict[str, np.ndarray]:
    """For each length, runs of slots: the pieces numbered ``first`` on go, ``times`` to a sequence, into
    sequences ``sequence`` on at ``offset``."""
    runs, taken, sequence = [], defaultdict(int), 0
    for lengths, repeats in plan:
        offset = 0
        for n in sorted(set(lengths), reverse=True):
            times = lengths.count(n)
            runs.append((n, taken[n], times, sequence, offset))
            taken[n] += times * repeats
            offset += times * n
        sequence += repeats
    runs.sort()
    cols = np.array(runs, dtype=np.int64).reshape(-1, 5).T
    return dict(zip(("length", "first", "times", "sequence", "offset"), cols))


def pack(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """``pieces`` (staged, of ``cut_pieces``) with ``sequence_id`` and ``offset``."""
    counts = staged(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``size`` rows
    slots = slot_table(plan_packing(histogram, size))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("bigint").alias("base"))
    rows = pieces.join(bases, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("number"))
    kind = pieces.schema["doc_id"].dataType.simpleString()

    def make():
        keys = (slots["length"] << 48) + slots["first"]  # one ascending key: a length has fewer than 2^48 pieces

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            run = np.searchsorted(keys, (length << 48) + number, side="right") - 1
            k = number - slots["first"][run]
            times = slots["times"][run]
            sequence, offset = slots["sequence"][run] + k // times, slots["offset"][run] + k % times * length
            cols = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            return pa.RecordBatch.from_arrays([*cols, pa.array(sequence), pa.array(offset)],
                                              ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
        return step
    return map_batches(rows, make, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, size: int = SIZE) -> DataFrame:
    """Tokenize, cut and pack: one row per piece with its sequence and its place there."""
    return pack(staged(cut_pieces(docs, id_col, text_col, path, size), "pieces"), size)
