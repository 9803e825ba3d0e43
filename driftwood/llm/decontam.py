"""Benchmark decontamination with a generalised suffix automaton.

Words are the maximal runs of letters, digits and non-ASCII characters, ASCII letters in lower
case.  A *window* is 10 consecutive words of a test item, or the whole item if it has fewer.
The automaton accepts every run of words of every item; the words of a document are streamed
through it, and after each word its state and match length name the longest run of item
words that ends there.  A state lists the windows that end in it, so every window that occurs
in the document is found, with the items it belongs to, and its words are *hit*.

Words are mapped to the items' vocabulary in bulk, and only stretches whose neighbouring
words follow each other somewhere in an item are streamed one by one: elsewhere the automaton
falls back to a match of at most one word (or none), which is too short unless an item is a
single word; the stretch length that is required adapts to the shortest window.

Items travel to the tasks in shards of at most ``SHARD_WORDS`` words (one shard for any usual
benchmark; a longer item is a shard of its own).  With more shards the documents pass each of
them in turn: one shard at a time is on the driver and in the tasks, and the documents' texts are staged between two
shards.  Row-local otherwise: no shuffle of documents.

Defined results: a null text or item has no words; an item without words has no window;
repeated documents are kept one to one, repeated item ids count once and items with a null id hit but aren't listed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, pick, staged

WINDOW = 10
SHARD_WORDS = 100_000
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")  # after lower-casing A-Z

# Byte table: A-Z to a-z; everything that isn't part of a word to a blank.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split()


def word_spans(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in WORD.finditer(text.translate(LOWER))]


class _Vocabulary(dict):
    def __missing__(self, word):
        return 0


class WindowAutomaton:
    """Generalised suffix automaton over the words of (item id, text) pairs."""

    def __init__(self, items: list[tuple], window: int = WINDOW):
        self.window = window
        self.vocabulary = _Vocabulary()
        coded = []
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text or "")]
            if ids:
                coded.append((item, ids))
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, ids in coded:
            last = 0
            for c in ids:
                last = self._extend(last, c)
        self.shortest = min((min(len(ids), window) for _, ids in coded), default=0)
        self._note_windows(coded)
        base = len(self.vocabulary) + 1
        pairs = {a * base + b for _, ids in coded for a, b in zip(ids, ids[1:])}
        self.base, self.pairs = base, np.array(sorted(pairs), dtype=np.int64)

    def _state(self, length: int, moves: dict, link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """A copy of ``q`` for the shorter strings that reach it over ``p`` and ``c``."""
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:  # the run is there already, from another item
            q = self.next[last][c]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        new, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return new

    def _note_windows(self, coded) -> None:
        """``ends[v]``: (window length, items) of each window among the strings of v and of its suffixes."""
        own: list[dict[int, set]] = [{} for _ in self.next]
        for item, ids in coded:
            n, v = min(len(ids), self.window), 0
            for i, c in enumerate(ids):
                v = self.next[v][c]
                if i + 1 >= n:
                    u = v
                    while self.length[self.link[u]] >= n:
                        u = self.link[u]
                    own[u].setdefault(n, set()).add(item)
        self.ends: list[tuple] = [()] * len(self.next)
        for v in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.ends[v] = tuple((n, frozenset(s)) for n, s in own[v].items()) + self.ends[self.link[v]]

    def stretches(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Word ranges in which every word follows its neighbour somewhere in an item, long enough for a window."""
        if not self.shortest or not len(ids):
            return []
        codes = ids[:-1] * self.base + ids[1:]
        joined = np.zeros(len(ids) + 1, dtype=bool)
        if len(self.pairs) and len(codes):
            at = np.minimum(np.searchsorted(self.pairs, codes), len(self.pairs) - 1)
            joined[1:-1] = self.pairs[at] == codes
        cuts = np.flatnonzero(~joined)  # a stretch lies between two cuts
        long = np.flatnonzero(np.diff(cuts) >= self.shortest)
        return [(a, b) for a, b in zip(cuts[long].tolist(), cuts[long + 1].tolist()) if ids[a]]

    def matches(self, doc: list[bytes]) -> tuple[list[tuple[int, int]], set, int]:
        """(first word, end) of every window that occurs, the items that they belong to, the longest match streamed."""
        ids = np.fromiter(map(self.vocabulary.__getitem__, doc), dtype=np.int64, count=len(doc))
        found, items, longest = [], set(), 0
        for a, b in self.stretches(ids):
            v = size = 0
            for i, c in enumerate(ids[a:b].tolist(), a + 1):
                while v and c not in self.next[v]:
                    v = self.link[v]
                    size = self.length[v]
                v = self.next[v].get(c, 0)
                size = size + 1 if v else 0
                longest = max(longest, size)
                for n, of in self.ends[v]:
                    if n <= size:
                        found.append((i - n, i))
                        items |= of
        return found, items, longest


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal ranges covered; touching ranges become one."""
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def shards(items: DataFrame, id_col: str, text_col: str, most: int = SHARD_WORDS) -> Iterator[list[tuple]]:
    """The items in groups of at most ``most`` words.  Rows come to the driver as a group is filled, so it holds one group, which
    is sent to the tasks, and a partition of the items."""
    group: list[tuple] = []
    size = 0
    for r in pick(items, item=id_col, text=text_col).where("text IS NOT NULL").toLocalIterator():
        n = len(words(r.text))
        if not n:
            continue
        if group and size + n > most:
            yield group
            group, size = [], 0
        group.append((None if r.item is None else str(r.item), r.text))
        size += n
    yield group


_AUTOMATA: dict = {}


def automaton(items: list[tuple], window: int) -> WindowAutomaton:
    """One automaton per worker process and shard."""
    key = hash((window, tuple(items)))
    if key not in _AUTOMATA:
        _AUTOMATA.clear()
        _AUTOMATA[key] = WindowAutomaton(items, window)
    return _AUTOMATA[key]


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text", window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per document: ``doc_id``, ``text``, ``n_words``, ``hits`` (maximal ranges of hit words),
    ``items`` (ids as strings, sorted) and ``longest`` (words of the longest match)."""
    src = pick(docs, doc_id=id_col, text=text_col)
    kind = src.schema["doc_id"].dataType.simpleString()
    rows = src.select("doc_id", "text", F.lit(0).cast("bigint").alias("n_words"),
                      F.expr("CAST(array() AS array<struct<first:bigint,end:bigint>>)").alias("hits"),
                      F.expr("CAST(array() AS array<string>)").alias("items"), F.lit(0).cast("bigint").alias("longest"))
    range_type = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))

    def step_of(group):
        def make():
            found = automaton(group, window)

            def step(batch: pa.RecordBatch) -> pa.RecordBatch:
                n_words, hits, names, longest = [], [], [], []
                old = zip(batch.column("hits").to_pylist(), batch.column("items").to_pylist(), batch.column("longest").to_pylist())
                for text, (had, known, most) in zip(batch.column("text"), old):
                    doc = words(text.as_py() or "")
                    ranges, of, size = found.matches(doc)
                    n_words.append(len(doc))
                    hits.append([{"first": a, "end": b} for a, b in merged(ranges + [(h["first"], h["end"]) for h in had])])
                    names.append(sorted({*known, *(i for i in of if i is not None)}))
                    longest.append(max(most, size))
                return pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("text"), pa.array(n_words, pa.int64()), pa.array(hits, range_type),
                     pa.array(names, pa.list_(pa.string())), pa.array(longest, pa.int64())], ["doc_id", "text", "n_words", "hits", "items", "longest"])
            return step
        return make

    schema = f"doc_id {kind}, text string, n_words bigint, hits array<struct<first:bigint,end:bigint>>, items array<string>, longest bigint"
    for i, group in enumerate(shards(items, item_col, item_text_col, shard_words)):
        if i and not group:
            break
        rows = map_batches(rows if i == 0 else staged(rows, "leaks"), step_of(group), schema)
    return rows


def leak_digests(found: DataFrame) -> DataFrame:
    """Counts and digests of ``find_leaks``."""
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, h: n + h["end"] - h["first"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), "longest")


MARK = "\u2026"  # stands for a removed span; it counts as a word, so no window can run across the cut


def without_ranges(text: str, ranges: list[tuple[int, int]]) -> str:
    """``text`` with each range of words, and what stands between them, replaced by the mark."""
    spans, out, end = word_spans(text), [], 0
    for a, b in ranges:
        out += [text[end:spans[a][0]], MARK]
        end = spans[b - 1][1]
    return "".join([*out, text[end:]])


def remove_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", length_col: str | None = None, item_col: str = "item_id",
                 item_text_col: str = "text", window: int = WINDOW, most_covered: float = 0.5, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``docs`` without leaked passages: each maximal run of hit words is replaced by a mark, and
    documents of which more than ``most_covered`` of the words are hit are dropped.  Clean documents,
    null texts and all other columns come back as they were; ``length_col``, if given, is set to the
    length of each text that changed."""
    names = docs.columns
    rest = [docs[c] for c in names if c != text_col]
    row = F.struct(*rest) if rest else F.lit(True)
    found = find_leaks(docs.select(row.alias("doc_id"), docs[text_col].alias("text")), items, item_col=item_col, item_text_col=item_text_col,
                       window=window, shard_words=shard_words)

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            hits, n_words = batch.column("hits"), batch.column("n_words").to_pylist()
            texts, cut, keep = batch.column("text"), {}, []
            for i, n in enumerate(n_words):
                ranges = [(h["first"], h["end"]) for h in hits[i].as_py()]
                keep.append(sum(b - a for a, b in ranges) <= most_covered * n)
                if ranges and keep[-1]:
                    cut[i] = without_ranges(texts[i].as_py(), ranges)
            if cut:
                texts = pa.array([cut.get(i, t) for i, t in enumerate(texts.to_pylist())], texts.type)
            out = pa.RecordBatch.from_arrays([batch.column("doc_id"), texts, pa.array([i in cut for i in range(len(keep))])], ["doc_id", "text", "cut"])
            return out if all(keep) else out.filter(pa.array(keep))
        return step
    kind = found.schema["doc_id"].dataType.simpleString()
    out = map_batches(found.select("doc_id", "text", "n_words", "hits"), make, f"doc_id {kind}, text string, cut boolean")

    def column(c):
        if c == text_col:
            return F.col("text").alias(c)
        old = F.col("doc_id")[c]
        return (F.when(F.col("cut"), F.length("text").cast(docs.schema[c].dataType)).otherwise(old) if c == length_col else old).alias(c)
    return out.select(*[column(c) for c in names])
