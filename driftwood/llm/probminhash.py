"""Near duplicates by ProbMinHash.

A text is the multiset of its 5-word shingles (all words, if it has fewer); a shingle's weight is
its count.  Similarity is the probability Jaccard index of two weighted sets, which ignores
their sizes and equals the Jaccard index where all weights are alike.

*Signature.*  Every shingle is a Poisson process of arrivals with its weight as rate, driven by
its hash alone; each arrival falls into one of 128 registers, which keep the shingle that came
first.  Two texts' registers agree with a probability equal to their similarity.  A process
ends as soon as its next arrival comes later than every register's first one.

*Candidates.*  32 bands of 4 registers; texts that share a band meet in a bucket.  At
similarity 0.8 two texts share a band but for a chance of 5e-8, and 13 on average.

1. Star: in each bucket the text with the most companions in all its buckets is paired with
   the others; a copied original links its variants at once.
2. Buckets whose members still are of several components are compared inside tasks, by sketches of
   1,024 registers of their own (a byte each): every two members of a bucket of up to ``WINDOW`` + 1;
   in a larger bucket the members stand in the order of their sketches, another one for each
   bucket, and meet the next ``WINDOW``.  Only pairs of different components whose estimate is at most ``ERRORS`` standard errors under the
   threshold leave the task (2.4, so that a pair at exactly 0.8 is missed with a
   chance of 0.8 %, one at 0.82 with 1e-4).
3. Of those pairs, the best of every two components are verified first, in up to ``ROUNDS`` rounds as long as the pairs outnumber
   the texts, then all that still join different components.
4. Large buckets that still are of several components then have all their pairs looked at, not those within ``WINDOW`` only.
   A pair's similarity is at most the weight it has in common, so of two near duplicates each has, from their rarest common
   shingle on, common shingles of that weight.  Members without such a shingle in common with another component's
   member need no comparison (texts with enough words of their own); the others of a bucket are dealt to blocks, and every two
   blocks meet in a cell, by sketches of ``CROWD_SKETCH`` registers of two bits, as a member's sketch goes to every cell of its
   buckets (let go ``CROWD_ERRORS`` standard errors under the threshold: at exactly 0.8 with a chance below 1e-4).  Step 3 follows.

So the rows that leave a step are at most members x bands in step 1 and members x bands x ``WINDOW`` in step 2, and what
leaves step 2 in a crowd of texts that are alike but not near duplicates is the share of pairs near the threshold.  Step 4's
comparisons are quadratic in the members that may still have a partner, in cells of bounded size.

*Verification.*  Each pair's similarity is computed exactly from both texts, no pair twice.

*Classes.*  Exact copies are one node from the start, by digest; verified pairs are joined to
connected components.  Nothing but counts comes to the driver; copies and components of any size are
partial aggregates, joined back; large buckets are dealt to tasks by ranges of their order.

Words are maximal runs of letters, digits and non-ASCII characters, ASCII letters in lower case.
Defined results: null texts are empty; texts without words equal only their exact copies; rows
that share an id are judged by their own texts; null ids take part and never are a class id
unless a class has no other; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import dropped, map_batches, null_as_empty, pick, release, row_chunks, settled, small_batches, staged, tuning
from .decontam import FOLD
from .graph import components

SHINGLE = 5
REGISTERS, BANDS = 128, 32
SIMILARITY = 0.8
CHUNK = 1 << 20  # bytes of text that are hashed at once
SKETCH_CHUNK = 4 << 20  # bytes of text and of arrival times that are sketched at once
DRAWS = 1 << 15  # arrivals that are drawn at once, if a turn has fewer
SKETCH = 1024  # registers of the sketch that decides whether a pair is verified
ERRORS = 2.4  # standard errors under the threshold at which an estimate is let go
WINDOW = 127  # members that a member is compared with in a bucket
CROWD_SKETCH, CROWD_ERRORS = 4096, 4.0  # the same for the pairs of large buckets that WINDOW leaves out
CROWD_VALUES = 4  # that a register of these has: two bits each
BLOCK = 1024  # members of a large bucket that are one side of a cell, on average
ROUNDS = 3
CACHED = 1 << 20  # shingles that a task keeps for its next pairs

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D  # odd: invertible modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the finalizer of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get("n", 0)
    if have < n:
        n = max(n, CHUNK + 1)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(n, base, dtype=np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
        _POWERS["n"] = n
    return _POWERS["up"], _POWERS["down"]


def word_hashes(folded: bytes) -> np.ndarray:
    """64-bit hashes of the blank-separated words, in order."""
    out, start = [], 0
    while start < len(folded):
        end = len(folded) if len(folded) - start <= CHUNK else folded.find(b" ", start + CHUNK)
        end = len(folded) if end < 0 else end
        raw = np.frombuffer(folded, dtype=np.uint8, count=end - start, offset=start)
        edge = np.diff(np.concatenate(([0], (raw != 32).view(np.int8), [0])))
        a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        up, down = _powers(len(raw) + 1)
        sums = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], out=sums[1:])
        out.append(mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64) * _ODD))
        start = end
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def weighted_shingles(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ascending, and their counts."""
    words = word_hashes(text.encode("utf-8", "surrogatepass").translate(FOLD))
    n = min(SHINGLE, len(words))
    if not n:
        return words, np.zeros(0, dtype=np.int64)
    last = len(words) - n + 1
    h = np.full(last, n, dtype=np.uint64)
    for i in range(n):
        h = mix(h * _ODD + words[i:i + last])
    return np.unique(h, return_counts=True)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], registers: int = REGISTERS) -> np.ndarray:
    """(texts, registers) shingle hashes; texts without shingles have zeros."""
    n, k = len(sets), np.uint64(registers)
    first = np.full(n * registers, np.inf)
    sign = np.zeros(n * registers, dtype=np.uint64)
    doc = np.repeat(np.arange(n), [len(s) for s, _ in sets])
    item = np.concatenate([s for s, _ in sets]) if n else np.zeros(0, dtype=np.uint64)
    rate = np.concatenate([c for _, c in sets]).astype(float) if n else np.zeros(0)
    for i in [i for i, (s, _) in enumerate(sets) if len(s) == 1]:
        sign[i * registers:(i + 1) * registers] = sets[i][0][0]
    alive = np.array([len(s) > 1 for s, _ in sets], dtype=bool)[doc] if len(doc) else np.zeros(0, dtype=bool)
    doc, item, rate = doc[alive], item[alive], rate[alive]
    time, turn, look = np.zeros(len(doc)), 0, 1
    while len(doc):
        # Several turns at once where few processes are left: a text of few shingles has many turns.
        turns = np.arange(turn + 1, turn + 1 + max(1, min(turn // 8, DRAWS // len(doc))), dtype=np.uint64)[:, None]
        turn += len(turns)
        draw = mix(item + 2 * turns * _ODD)
        wait = -np.log(((draw >> np.uint64(11)).astype(float) + 1) / 9007199254740992.0) / rate
        times = np.cumsum(np.concatenate([time[None], wait]), axis=0)[1:]
        place = mix(item + (2 * turns + 1) * _ODD)
        place = place & (k - np.uint64(1)) if registers & (registers - 1) == 0 else place % k
        slot, came, time = (doc * registers + place.astype(np.int64)).ravel(), times.ravel(), times[-1]
        np.minimum.at(first, slot, came)
        won = first[slot] == came
        sign[slot[won]] = np.tile(item, len(turns))[won]
        if turn < look:  # arrivals after all registers' first ones change nothing
            continue
        look = turn + max(1, turn // 8)
        latest = first.reshape(n, registers).max(axis=1)  # infinite while a register is empty
        on = time < latest[doc]
        doc, item, rate, time = doc[on], item[on], rate[on], time[on]
    return sign.reshape(n, registers)


def sketches(sets: list[tuple[np.ndarray, np.ndarray]], registers: int = SKETCH) -> np.ndarray:
    """(texts, registers) bytes of registers, for estimates only."""
    return (mix(signatures(sets, registers)) >> np.uint64(56)).astype(np.uint8)


def estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The similarity of each two sketches; bytes agree by chance too."""
    return ((a == b).mean(axis=1) - 1 / 256) / (1 - 1 / 256)


def packed(sketch: np.ndarray) -> np.ndarray:
    """Two bits of each register, four registers a byte."""
    two = (sketch & np.uint8(CROWD_VALUES - 1)).reshape(len(sketch), -1, 4)
    return two[:, :, 0] | two[:, :, 1] << 2 | two[:, :, 2] << 4 | two[:, :, 3] << 6


def packed_estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The similarity of each two packed sketches, given as 64-bit numbers of 32 registers."""
    differ = a ^ b
    differ = (differ | differ >> np.uint64(1)) & np.uint64(0x5555555555555555)
    same = 1 - np.bitwise_count(differ).sum(axis=1, dtype=np.int64) / (32 * a.shape[1])
    return (same - 1 / CROWD_VALUES) / (1 - 1 / CROWD_VALUES)


def least_estimate(similarity: float, registers: int, errors: float, values: int = 256) -> float:
    """The estimate that many standard errors under ``similarity``, for registers that have so many values and agree by chance too."""
    same = similarity + (1 - similarity) / values
    return similarity - errors * (same * (1 - same) / registers) ** 0.5 / (1 - 1 / values)


def band_keys(sign: np.ndarray) -> np.ndarray:
    """(texts, bands) 64-bit bucket keys; the band's number is part of its key."""
    rows = sign.reshape(len(sign), BANDS, REGISTERS // BANDS)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2])
    for i in range(rows.shape[2]):
        h = mix(h * _ODD + rows[:, :, i])
    return h.astype(np.int64)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum over common x of 1 / sum over all y of max(p_y / p_x, q_y / q_x), exactly."""
    (xs, p), (ys, q) = a, b
    if not len(xs) or not len(ys):
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    _, i, j = np.intersect1d(xs, ys, assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    pc, qc = p[i], q[j]
    order = np.argsort(qc / pc, kind="stable")
    pc, qc = pc[order], qc[order]
    ratio = qc / pc
    start = np.searchsorted(ratio, ratio, side="left")  # y before here are larger in p, the others in q
    p_before, q_before = np.r_[0.0, np.cumsum(pc)], np.r_[0.0, np.cumsum(qc)]
    from_p = p_before[start] + (1.0 - p_before[-1])
    from_q = q_before[-1] - q_before[start] + (1.0 - q_before[-1])
    return float((1.0 / (from_p / pc + from_q / qc)).sum())


def sign_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, digest`` (of the text) and ``bands`` (empty for a text without words)."""
    src = pick(docs, doc_id=id_col, text=text_col)
    kind = src.schema["doc_id"].dataType.simpleString()

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            bands: list = []
            for a, b in row_chunks([len(t) for t in texts], CHUNK):
                sets = [weighted_shingles(t) for t in texts[a:b]]
                keys = band_keys(signatures(sets))
                bands += [keys[i].tolist() if len(sets[i][0]) else [] for i in range(b - a)]
            digests = [hashlib.md5(t.encode("utf-8", "surrogatepass")).digest() for t in texts]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                                              ["doc_id", "digest", "bands"])
        return step
    return map_batches(src, make, f"doc_id {kind}, digest binary, bands array<bigint>")


def bucket_members(nodes: DataFrame) -> DataFrame:
    """``band, at, node, n, weight`` for ``node, bands`` rows: the members of buckets with more than one; ``at`` is the band's
    place, ``n`` the bucket's members, ``weight`` their sum over a node's buckets."""
    buckets = nodes.select("node", F.posexplode("bands").alias("at", "band"))
    sizes = buckets.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    shared = staged(buckets.join(sizes, "band"), "buckets")
    return shared.join(shared.groupBy("node").agg(F.sum("n").alias("weight")), "node").select("band", "at", "node", "n", "weight")


def star_pairs(members: DataFrame) -> DataFrame:
    """``member, leader``: the heaviest member of each bucket with the others."""
    best = members.groupBy("band").agg(F.max(F.struct("weight", "node")).alias("best"))
    pairs = members.join(best, "band").select("node", F.col("best.node").alias("other")).where("node <> other")
    return pairs.select(F.greatest("node", "other").alias("member"), F.least("node", "other").alias("leader")).distinct()


def with_components(rows: DataFrame, linked: DataFrame, node: str = "node", component: str = "component") -> DataFrame:
    """``rows`` with the component of their ``node``: itself, if nothing is linked to it."""
    known = linked.select(F.col("node").alias(node), F.col("component").alias(component))
    return rows.join(known, node, "left").withColumn(component, F.coalesce(component, node))


def open_buckets(members: DataFrame, linked: DataFrame) -> DataFrame:
    """The members, with ``component``, of buckets that have several components."""
    now = staged(with_components(members, linked), "now")
    several = now.groupBy("band").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b").select("band")
    return staged(now.join(several, "band").select("band", "at", "node", "n", "component"), "open")


def sketch_texts(texts: DataFrame, registers: int = SKETCH, pack: bool = False) -> DataFrame:
    """``node, sketch`` (packed, if asked for) for ``node, text`` rows."""
    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts, out = batch.column("text").to_pylist(), []
            for a, b in row_chunks([len(t) + 8 * registers for t in texts], SKETCH_CHUNK):
                found = sketches([weighted_shingles(t) for t in texts[a:b]], registers)
                out += [row.tobytes() for row in (packed(found) if pack else found)]
            return pa.RecordBatch.from_arrays([batch.column("node"), pa.array(out, pa.binary())], ["node", "sketch"])
        return step
    return map_batches(texts, make, "node bigint, sketch binary")


def near_in_order(rows: DataFrame, least: float) -> DataFrame:
    """``u, v, estimate`` of the pairs of different components within WINDOW places in a bucket whose estimate is at least ``least``, for
    rows in order.  A pair that shares several small buckets leaves the first of them only."""
    def run(batches):
        tail: dict = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            now = {c: batch.column(c).to_numpy() for c in ("band", "at", "node", "n", "component")}
            now["sketch"] = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), dtype=np.uint8).reshape(-1, SKETCH)
            small = np.zeros((batch.num_rows, BANDS), dtype=np.int64)  # the keys of a row's small buckets by place
            for i, shared in enumerate(batch.column("small").to_pylist()):
                for x in shared:
                    small[i, x["at"]] = x["band"]
            now["small"] = small
            old = len(tail["band"]) if tail else 0
            if tail:
                now = {c: np.concatenate([tail[c], v]) for c, v in now.items()}
            found = []
            for k in range(1, min(WINDOW, len(now["band"]) - 1) + 1):
                second = np.arange(max(k, old), len(now["band"]))
                second = second[now["band"][second] == now["band"][second - k]]
                if not len(second):
                    break  # no bucket is that long
                second = second[now["component"][second] != now["component"][second - k]]
                for a, b in row_chunks([SKETCH] * len(second), CHUNK):
                    j = second[a:b]
                    estimate = estimates(now["sketch"][j], now["sketch"][j - k])
                    j, estimate = j[estimate >= least], estimate[estimate >= least]
                    common = (now["small"][j] == now["small"][j - k]) & (now["small"][j] != 0)
                    here = np.where(common.any(axis=1), (common.argmax(axis=1) == now["at"][j]) & (now["n"][j] <= WINDOW + 1), True)
                    found += zip(now["node"][j[here]].tolist(), now["node"][j[here] - k].tolist(), estimate[here].tolist())
            tail = {c: v[-WINDOW:] for c, v in now.items()}
            u, v, e = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(e, pa.float64())], ["u", "v", "estimate"])
        tail = now = found = second = None
        release()
    small_batches(rows.sparkSession)
    return rows.mapInArrow(run, "u bigint, v bigint, estimate double")


def near_pairs(members: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``u, v, estimate`` (u < v) of the pairs of ``open_buckets`` that may be near duplicates."""
    least = least_estimate(similarity, SKETCH, ERRORS)
    parts = tuning(members.sparkSession)
    small = members.groupBy("node").agg(F.collect_list(F.when(F.col("n") <= WINDOW + 1, F.struct("at", "band"))).alias("small"))  # BANDS at the most
    known = staged(sketch_texts(texts.join(members.select("node").distinct(), "node")).join(small, "node"), "sketches")
    # Another order in each bucket: by the sketch's bytes from another place on.
    order = F.concat(F.expr(f"substring(sketch, at * {SKETCH // BANDS} + 1, {SKETCH // BANDS})"), F.col("sketch"))
    rows = members.join(known, "node").withColumn("order", F.substring(order, 1, 64))
    whole = rows.where(F.col("n") <= WINDOW + 1).repartition(parts, "band").sortWithinPartitions("band")
    large = rows.where(F.col("n") > WINDOW + 1).repartitionByRange(parts, "band", "order").sortWithinPartitions("band", "order")
    columns = ["band", "at", "node", "n", "component", "sketch", "small"]
    found = near_in_order(whole.select(columns), least).unionAll(near_in_order(large.select(columns), least))
    return found.groupBy(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).agg(F.max("estimate").alias("estimate"))


def shingle_shares(texts: DataFrame) -> DataFrame:
    """``node, shingle, share``: each distinct shingle's share of its text's weight, for ``node, text`` rows."""
    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [weighted_shingles(t) for t in batch.column("text").to_pylist()]
            node = np.repeat(batch.column("node").to_numpy(), [len(x) for x, _ in sets])
            shingle, share = np.concatenate([x for x, _ in sets]).view(np.int64), np.concatenate([c / max(c.sum(), 1) for _, c in sets])
            return pa.RecordBatch.from_arrays([pa.array(node), pa.array(shingle), pa.array(share)], ["node", "shingle", "share"])
        return step
    return map_batches(texts, make, "node bigint, shingle bigint, share double")


def may_be_near(crowd: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """``node`` of the members that can have a near duplicate in another component.  Shingles stand in one order, the rarest first;
    the rarest that two near duplicates have in common is, in each of them, followed by common ones of at least ``similarity``."""
    nodes = crowd.select("node", "component").distinct()
    shares = staged(shingle_shares(texts.join(nodes, "node").select("node", "text")), "shares")
    common = shares.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    onwards = Window.partitionBy("node").orderBy(F.desc("n"), F.desc("shingle")).rowsBetween(Window.unboundedPreceding, 0)
    rare = staged(shares.join(common, "shingle").withColumn("mass", F.sum("share").over(onwards)).where(F.col("mass") >= similarity - 1e-8)
                  .join(nodes, "node").select("node", "component", "shingle"), "rare")
    meet = rare.groupBy("shingle").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b").select("shingle")
    near = staged(rare.join(meet, "shingle").select("node").distinct(), "may-be-near")
    dropped(shares)
    dropped(rare)
    return near


def near_in_cells(rows: DataFrame, similarity: float) -> DataFrame:
    """``u, v, estimate`` of the pairs of different components in a cell (of different blocks, if the cell has two) that may be near
    duplicates, for rows in the order of their cells.  A pair that shares several buckets leaves the first of them only."""
    least, rough = (least_estimate(similarity, n, CROWD_ERRORS, CROWD_VALUES) for n in (CROWD_SKETCH, SKETCH))
    step, first_words = CHUNK // (8 * BANDS), SKETCH // 32

    def run(batches):
        tail: dict = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            now = {c: batch.column(c).to_numpy() for c in ("band", "lo", "hi", "block", "at", "node", "component")}
            now["sketch"] = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), dtype=np.uint64).reshape(-1, CROWD_SKETCH // 32)
            now["shared"] = batch.column("shared").flatten().to_numpy().reshape(-1, BANDS)
            old = len(tail["band"]) if tail else 0
            if tail:
                now = {c: np.concatenate([tail[c], v]) for c, v in now.items()}
            starts = np.r_[True, np.any([now[c][1:] != now[c][:-1] for c in ("band", "lo", "hi")], axis=0)]
            first = np.maximum.accumulate(np.where(starts, np.arange(len(starts)), 0))  # where a row's cell begins
            found, second, k = [], np.arange(old, len(starts)), 0
            while True:
                k += 1
                second = second[second - k >= first[second]]
                if not len(second):
                    break  # no cell is that long
                pair = second[(now["component"][second] != now["component"][second - k])
                              & ((now["lo"][second] == now["hi"][second]) | (now["block"][second] != now["block"][second - k]))]
                for a in range(0, len(pair), step):
                    j = pair[a:a + step]
                    both = (now["shared"][j] == now["shared"][j - k]) & (now["shared"][j] != 0)
                    j = j[both.argmax(axis=1) == now["at"][j]]
                    j = j[packed_estimates(now["sketch"][j, :first_words], now["sketch"][j - k, :first_words]) >= rough]
                    estimate = packed_estimates(now["sketch"][j], now["sketch"][j - k])
                    j, estimate = j[estimate >= least], estimate[estimate >= least]
                    found += zip(now["node"][j].tolist(), now["node"][j - k].tolist(), estimate.tolist())
            tail = {c: v[first[-1]:] for c, v in now.items()}
            u, v, e = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(e, pa.float64())], ["u", "v", "estimate"])
        tail = now = found = second = None
        release()
    small_batches(rows.sparkSession)
    return rows.mapInArrow(run, "u bigint, v bigint, estimate double")


def crowd_pairs(crowd: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``u, v, estimate`` (u < v) of all pairs in the large buckets of ``open_buckets`` that may be near duplicates."""
    near = may_be_near(crowd, texts, similarity)
    rows = staged(crowd.join(near, "node").select("band", "at", "node", "component"), "crowd")
    sizes = rows.groupBy("band").agg(F.count("*").alias("n"), F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b")
    sizes = sizes.select("band", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    # The keys of a node's large buckets by place, 0 for none.
    by_place = [F.coalesce(F.max(F.when(F.col("at") == at, F.col("band"))), F.lit(0)).alias(f"at{at}") for at in range(BANDS)]
    shared = rows.groupBy("node").agg(*by_place).select("node", F.array(*[f"at{at}" for at in range(BANDS)]).alias("shared"))
    known = staged(sketch_texts(texts.join(near, "node").select("node", "text"), CROWD_SKETCH, pack=True).join(shared, "node"), "sketches")
    dealt = rows.join(sizes, "band").withColumn("block", F.pmod(F.xxhash64("node", "band"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    cells = dealt.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other")).join(known, "node")
    cells = cells.repartition(tuning(crowd.sparkSession), "band", "lo", "hi").sortWithinPartitions("band", "lo", "hi")
    found = near_in_cells(cells.select("band", "lo", "hi", "block", "at", "node", "component", "sketch", "shared"), similarity)
    return found.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"), "estimate")


def verify(pairs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (member, leader, member_text, leader_text) of at least this similarity, as edges (u, v)."""
    def make():
        kept: dict = {}  # leaders come in runs, members again and again
        size = 0

        def known(node, text):
            nonlocal size
            if node not in kept:
                found = weighted_shingles(text.as_py())
                if size + len(found[0]) > CACHED:
                    kept.clear()
                    size = 0
                kept[node] = found
                size += len(found[0])
            return kept[node]

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            u, v = [], []
            for member, leader, a, b in zip(*(batch.column(c) for c in ("member", "leader", "member_text", "leader_text"))):
                member, leader = member.as_py(), leader.as_py()
                if probability_jaccard(known(member, a), known(leader, b)) >= similarity - 1e-9:
                    u.append(member)
                    v.append(leader)
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])
        return step
    return map_batches(pairs, make, "u bigint, v bigint")


def join_links(linked: DataFrame | None, pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """``node, component`` after the verification of ``member, leader`` pairs."""
    both = (pairs.join(texts.select(F.col("node").alias("member"), F.col("text").alias("member_text")), "member")
            .join(texts.select(F.col("node").alias("leader"), F.col("text").alias("leader_text")), "leader"))
    edges = verify(both, similarity)
    if linked is None:
        return components(edges)
    edges = staged(edges, "verified")
    if edges.isEmpty():
        return linked
    ends = with_components(with_components(edges, linked, "u", "a"), linked, "v", "b")
    merged = components(ends.select(F.col("a").alias("u"), F.col("b").alias("v")))  # of components, by their smallest nodes
    moved = merged.select(F.col("node").alias("component"), F.col("component").alias("to"))
    now = linked.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    return staged(now.unionAll(merged), "linked")


def join_best(linked: DataFrame, left: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """``linked`` after the verification of the ``u, v, estimate`` pairs, the best of every two components first while there are more
    pairs than texts: fewer are verified at once, as each round is a pass over the links."""
    most = texts.count()
    for turn in range(ROUNDS + 1):
        left = staged(with_components(with_components(left.select("u", "v", "estimate"), linked, "u", "a"), linked, "v", "b").where("a <> b"), "candidates")
        open_pairs = left.count()
        if not open_pairs:
            break
        pairs, last = left, turn == ROUNDS or open_pairs <= most
        if not last:  # the best of every two components
            best = left.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max(F.struct("estimate", "u", "v")).alias("best"))
            pairs = staged(best.select("best.u", "best.v"), "pairs")
            left = left.join(pairs, ["u", "v"], "left_anti")
        linked = join_links(linked, pairs.select(F.col("v").alias("member"), F.col("u").alias("leader")), texts, similarity)
        if last:
            break
    return linked


def link(members: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``node, component`` (as ``components``) of the texts that verified pairs join."""
    star = staged(star_pairs(members), "pairs")
    linked = join_links(None, star, texts, similarity)
    opened = open_buckets(members, linked)
    tried = star.select(F.col("leader").alias("u"), F.col("member").alias("v"))
    left = staged(near_pairs(opened, texts, similarity).join(tried, ["u", "v"], "left_anti"), "candidates")
    linked = join_best(linked, left, texts, similarity)
    crowd = open_buckets(opened.where(F.col("n") > WINDOW + 1).drop("component"), linked)
    if not crowd.isEmpty():
        tried = tried.unionAll(left.select("u", "v"))
        left = staged(crowd_pairs(crowd, texts, similarity).join(tried, ["u", "v"], "left_anti"), "candidates")
        linked = join_best(linked, left, texts, similarity)
    return linked


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, digest, component``; rows of one component are near duplicates."""
    src = pick(docs, doc_id=id_col, text=text_col)
    signed = staged(sign_documents(src), "signatures")
    # One node per distinct text; its number is fixed by being written.
    nodes = staged(signed.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.first("bands").alias("bands"))
                   .withColumn("node", F.monotonically_increasing_id()), "nodes")
    members = staged(bucket_members(nodes.select("node", "bands")), "members")
    asked = members.select("node").distinct()
    wanted = nodes.select("node", "digest", "first_id").join(asked, "node").withColumnRenamed("digest", "wanted")
    digest = F.unhex(F.md5(F.encode(null_as_empty(F.col("text")), "utf-8")))
    rows = src.withColumn("digest", digest)
    # One row of a text's copies: its first id is part of the key, so copies don't meet in one task.
    copies = rows.join(wanted, (rows["digest"] == wanted["wanted"]) & rows["doc_id"].eqNullSafe(wanted["first_id"]))
    texts = staged(copies.groupBy("node").agg(F.first(null_as_empty(F.col("text"))).alias("text")), "texts")
    linked = link(members, texts, similarity)
    labels = nodes.select("digest", "node").join(linked, "node", "left").select("digest", F.coalesce("component", "node").alias("component"))
    return signed.select("doc_id", "digest").join(labels, "digest").select("doc_id", "digest", "component")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, class_id`` (the smallest id of the class) for every row."""
    rows = settled(docs.sparkSession, lambda: classify(docs, id_col, text_col, similarity), "classes")
    first = rows.groupBy("component").agg(F.min("doc_id").alias("class_id"))
    return rows.join(first, "component").select("doc_id", "class_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each class, the one with the smallest id (of several texts under that id, the
    one with the smallest digest; of equal rows, one); all columns as they were."""
    def keepers() -> DataFrame:
        rows = staged(classify(docs, id_col, text_col, similarity), "classes")
        best = rows.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "digest")).alias("best"))
        return best.select(row_key(F.col("best.doc_id"), F.col("best.digest")).alias(key))
    key = "key"
    while key in {c.lower() for c in docs.columns}:  # no column of the table has that name
        key += "_"
    kept = settled(docs.sparkSession, keepers, "keepers")
    digest = F.unhex(F.md5(F.encode(null_as_empty(docs[text_col]), "utf-8")))
    keyed = docs.withColumn(key, row_key(docs[id_col], digest))
    return keyed.join(kept, key, "left_semi").dropDuplicates([key]).drop(key)


def row_key(doc_id, digest) -> F.Column:
    return F.concat(F.hex(digest), F.lit(":"), F.coalesce(doc_id.cast("string"), F.lit("")))
