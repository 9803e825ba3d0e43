"""Toxicity by compression distance.

Two zstandard dictionaries are trained on labelled texts: the *ordinary* one from the words
that are the most widespread in ordinary texts, the *toxic* one from the stretches of words
that occur in many toxic and in hardly any ordinary texts, followed by the ordinary one (so
that ordinary text compresses alike under both).  A text is cut into windows of whole words
(words longer than a window, as in texts without blanks, into overlapping pieces); each window is compressed with either dictionary, and the difference of the two lengths is
its evidence.  A logistic model turns the windows' evidence into a score between 0 and 1;
it is calibrated on texts that were left out when their dictionaries were trained
(cross-fitting), with class weights that restore the classes' shares among all labels.

Training runs on the driver over a bounded sample: at most ``max_toxic`` and ``max_ordinary``
labelled documents (the smallest hashes of their ids) of at most ``max_bytes`` each.  Scoring
is row-local over all documents and whole texts: no shuffle.

Defined results: a null or empty text has no windows and gets the score of no evidence;
labels that are null or name no document are ignored, of several labels of a document the
largest counts; without labels of both classes every score is the share of toxic labels (0
without labels); repeated rows and null ids are scored one by one; other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, pick

GRAM = 5            # bytes of a stretch that is counted
WINDOW_BYTES = 128  # a window is closed by the word that reaches this size
OVERLAP = 32        # bytes of a long word that two of its pieces share
THRESHOLD = 0.3


def pieces(unit: bytes) -> list[bytes]:
    """A word of more than a window's size cut at character boundaries; neighbours share about OVERLAP bytes."""
    out, start = [], 0
    while len(unit) - start > WINDOW_BYTES:
        end = start + WINDOW_BYTES
        while unit[end] & 0xC0 == 0x80:
            end -= 1
        out.append(unit[start:end])
        start = end - OVERLAP
        while unit[start] & 0xC0 == 0x80:
            start -= 1
    out.append(unit[start:])
    return out


def units(text: str) -> list[bytes]:
    """Lower-case words, each with a blank before it; of longer ones than a window, their pieces."""
    words = [b" " + w for w in text.lower().encode("utf-8", "replace").split()]
    if all(len(w) <= WINDOW_BYTES for w in words):
        return words
    return [p for w in words for p in pieces(w)]


def windows(text: str) -> list[bytes]:
    out, cur, size = [], [], 0
    for u in units(text):
        cur.append(u)
        size += len(u)
        if size >= WINDOW_BYTES:
            out.append(b"".join(cur))
            cur, size = [], 0
    if cur:
        out.append(b"".join(cur))
    return out


def grams(unit: bytes) -> set[bytes]:
    return {unit[i:i + GRAM] for i in range(len(unit) - GRAM + 1)}


@dataclass
class ClassCounts:
    """Document frequencies of words and of their grams."""

    docs: int = 0
    words: Counter = field(default_factory=Counter)
    grams: Counter = field(default_factory=Counter)

    def add(self, text: str) -> None:
        found = set(units(text))
        self.docs += 1
        self.words.update(found)
        self.grams.update(set().union(*map(grams, found)))

    @staticmethod
    def total(parts: list[ClassCounts]) -> ClassCounts:
        out = ClassCounts()
        for p in parts:
            out.docs += p.docs
            out.words.update(p.words)
            out.grams.update(p.grams)
        return out


def toxic_content(toxic: ClassCounts, ordinary: ClassCounts, size: int = 2048, least: int = 4, share: float = 0.01, odds: float = 25.0) -> bytes:
    """Stretches of toxic words all of whose grams are typical of toxic texts, the most covering ones last
    (nearest to the data), none that adds no new gram, up to ``size`` bytes."""
    floor = max(least, toxic.docs * share)
    good = {g: n for g, n in toxic.grams.items()
            if n >= floor and n / toxic.docs > odds * (ordinary.grams[g] + 1) / max(ordinary.docs, 1)}
    stretches = set()
    for w in toxic.words:
        i, last = 0, len(w) - GRAM
        while i <= last:
            j = i
            while j <= last and w[j:j + GRAM] in good:
                j += 1
            if j > i:
                stretches.add(w[i:j + GRAM - 1])
            i = j + 1
    heap = [(-sum(good[g] for g in grams(s)), s) for s in stretches]
    heapq.heapify(heap)
    covered, out, used = set(), [], 0
    while heap and used < size:
        _, s = heapq.heappop(heap)
        now = sum(good[g] for g in grams(s) - covered)
        if now and heap and now < -heap[0][0]:
            heapq.heappush(heap, (-now, s))
        elif now:
            covered |= grams(s)
            out.append(s)
            used += len(s)
    return b"".join(reversed(out))


def ordinary_content(ordinary: ClassCounts, size: int = 16_000) -> bytes:
    """The most widespread ordinary words, the most frequent ones last."""
    out, used = [], 0
    for w, _ in sorted(ordinary.words.items(), key=lambda kv: (-kv[1], kv[0])):
        if used + len(w) > size:
            break
        out.append(w)
        used += len(w)
    return b"".join(reversed(out))


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters(
        strategy=zstandard.STRATEGY_LAZY2, min_match=5, window_log=15, hash_log=14, chain_log=14, search_log=5, target_length=24,
        write_content_size=False, write_checksum=False, write_dict_id=False)
    if len(content) < 8:  # too short for a dictionary
        return zstandard.ZstdCompressor(compression_params=params)
    primed = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    primed.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=primed, compression_params=params)


class Distance:
    """Evidence of a text: features of its windows' differences in compressed length."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.tail = ordinary[100:164]  # known to both, so that a window never falls back to stored bytes
        self.toxic, self.ordinary = compressor(toxic + ordinary), compressor(ordinary)

    def features(self, text: str) -> list[float]:
        a, b = self.ordinary.compress, self.toxic.compress
        gain = np.array([len(a(w)) - len(b(w)) for w in (x + self.tail for x in windows(text))] or [0], dtype=float)
        top, strong = np.sort(gain)[::-1], gain[gain >= 2]
        return [top[0], top[1] if len(top) > 1 else 0.0, top[0] ** 2 / 10, np.log1p(strong.sum()), np.log1p(len(strong)),
                len(strong) / len(gain), (gain >= 1).mean(), gain.clip(0).mean(), np.log1p(len(gain))]


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, steps: int = 40):
    """Weighted logistic regression by Newton steps: (mean, scale, coefficients with the constant last)."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    a = np.c_[(x - mean) / scale, np.ones(len(x))]
    w = np.zeros(a.shape[1])
    pull = ridge * np.r_[np.ones(len(w) - 1), 0] + 1e-9
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (weight * (p - y)) + pull * w
        hess = (a * (weight * p * (1 - p) + 1e-9)[:, None]).T @ a + np.diag(pull)
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
    return mean, scale, w


@dataclass
class ToxicityModel:
    """Two dictionaries and the calibration; small (tens of KB), sent to the tasks as it is."""

    toxic: bytes = b""
    ordinary: bytes = b""
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None
    prior: float = 0.0

    def scorer(self):
        if self.weights is None:
            return lambda text: self.prior
        distance, mean, scale, w = Distance(self.toxic, self.ordinary), self.mean, self.scale, self.weights

        def score(text: str) -> float:
            z = (np.array(distance.features(text)) - mean) / scale @ w[:-1] + w[-1]
            return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))
        return score


def fit_texts(texts: list[str], toxic: list[int], shares: tuple[float, float] | None = None, folds: int = 3) -> ToxicityModel:
    """Train on labelled texts; ``shares``: the true shares of ordinary and toxic texts."""
    y = np.array(toxic, dtype=float)
    shares = shares or ((1 - y.mean(), y.mean()) if len(y) else (1.0, 0.0))
    if not 0 < y.sum() < len(y):
        return ToxicityModel(prior=float(shares[1]))
    fold = np.array([zlib.crc32(t.encode("utf-8", "replace")) % folds for t in texts])
    counts = {(k, c): ClassCounts() for k in range(folds) for c in (0, 1)}
    for t, k, c in zip(texts, fold.tolist(), y.astype(int).tolist()):
        counts[k, c].add(t)

    def contents(ks) -> tuple[bytes, bytes]:
        tox, ordi = (ClassCounts.total([counts[k, c] for k in ks]) for c in (1, 0))
        return (toxic_content(tox, ordi) if tox.docs else b""), ordinary_content(ordi)
    x = np.zeros((len(texts), len(Distance(b"", b"").features(""))))
    for k in range(folds):
        distance = Distance(*contents([j for j in range(folds) if j != k]))
        for i in np.flatnonzero(fold == k):
            x[i] = distance.features(texts[i])
    weight = np.where(y == 1, shares[1] / y.sum(), shares[0] / (len(y) - y.sum())) * len(y)
    mean, scale, w = fit_logistic(x, y, weight)
    return ToxicityModel(*contents(range(folds)), mean, scale, w, float(shares[1]))


def held_out(id_col) -> F.Column:
    """Rows that no label is learnt from."""
    return F.crc32(id_col.cast("string")) % 4 == 2


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                 max_toxic: int = 3000, max_ordinary: int = 4000, max_bytes: int = 200_000) -> ToxicityModel:
    """Train on a bounded sample of the labelled documents that aren't held out."""
    known = (pick(labels, doc_id=id_col, toxic=label_col).where("doc_id IS NOT NULL AND toxic IS NOT NULL")
             .where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic")))
    found = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    total = sum(found.values())
    if not total:
        return ToxicityModel()
    order = F.xxhash64("doc_id")
    sample = known.where("toxic = 1").orderBy(order, "doc_id").limit(max_toxic).unionAll(
        known.where("toxic = 0").orderBy(order, "doc_id").limit(max_ordinary))
    rows = (pick(docs, doc_id=id_col, text=text_col).where(F.octet_length("text") <= max_bytes)
            .join(F.broadcast(sample), "doc_id")  # at most max_toxic + max_ordinary rows
            .orderBy(order, "doc_id", "text").limit(max_toxic + max_ordinary).collect())
    return fit_texts([r["text"] for r in rows], [r["toxic"] for r in rows], (found.get(0, 0) / total, found.get(1, 0) / total))


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id`` and ``score``."""
    src = pick(docs, doc_id=id_col, text=text_col)
    kind = src.schema["doc_id"].dataType.simpleString()

    def make():
        score = model.scorer()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            scores = pa.array([score(t.as_py() or "") for t in batch.column("text")], pa.float64())
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], ["doc_id", "score"])
        return step
    return map_batches(src, make, f"doc_id {kind}, score double")


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; all columns as they were."""
    at = docs.columns.index(text_col)

    def make():
        score = model.scorer()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            return batch.filter(pa.array([score(t.as_py() or "") < threshold for t in batch.column(at)], pa.bool_()))
        return step
    return map_batches(docs, make, docs.schema)
