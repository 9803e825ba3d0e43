"""SentencePiece BPE: encoding by vectorised merge rounds, and decoding.

The vocabulary file is read as it is (pieces, scores, kinds, the flags of its normaliser); nothing
is trained and nothing is encoded by the library.

*Words.*  Blanks become the vocabulary's blank sign, a leading one is added, and a text is cut
where no piece can reach across: characters that stand side by side in some piece are of one class
(derived from the vocabulary), and a word is a run of blanks and of characters of one class.  The merges of
different words don't influence each other, so every distinct word is encoded once per task and kept.

*Merge rounds.*  The characters of all new words lie in one flat array of symbols.  In each round
every word finds its smallest pair rank (a segmented minimum over rank and place, so the
leftmost of equal ones), all words merge at their places at once, the array is compacted, and words
without a pair leave it.  That is the order in which the library merges, word by word.  A word
of more than ``LONG`` characters takes its pairs from a heap instead, in the same order, as rounds over
it would be quadratic.  A character that no piece covers is spelt in bytes.

*Decoding.*  Pieces are looked up and concatenated; runs of byte pieces that aren't UTF-8 become one
replacement character a byte.

Defined results: null and empty texts have no pieces but the begin and end ids; repeated rows and
null ids are rows like any other; other columns are ignored; no rows give no rows.  A text is worked
on in stretches of about ``STRETCH`` characters that end between words, so a long text costs memory
for its ids only; nothing is shuffled.
"""

from __future__ import annotations

import codecs
import heapq
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, pick, row_chunks

BLANK = "▁"
LONG = 1024  # characters of a word that is merged from a heap
STRETCH = 1 << 18  # characters of a text that are cut into words at once
CACHED = 400_000  # words that a task keeps
NONE = np.int64(1) << np.int64(30)  # rank of a pair that isn't a piece

#: Kinds of pieces in the vocabulary's format (fixed values).
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6

BREAK = re.compile(f"[^{BLANK}](?={BLANK})")

codecs.register_error("one-a-byte", lambda e: ("�" * (e.end - e.start), e.end))


def piece_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol buffer message; nested messages and texts stay bytes."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = raw[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out
    while at < len(raw):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or number()
        yield key >> 3, raw[at:at + size]
        at += size


def word_pattern(bigrams: set[str]) -> re.Pattern:
    """Matches the words of a text one after the other: blanks, then characters that neighbours in
    pieces (``bigrams``) connect; a character that is in no longer piece stands alone."""
    group = {c: c for b in bigrams for c in b if c != BLANK}

    def find(c: str) -> str:
        while group[c] != c:
            group[c] = c = group[group[c]]
        return c
    for a, b in bigrams:
        if BLANK not in (a, b):
            group[find(a)] = find(b)
    classes: dict[str, list[str]] = {}
    for c in sorted(group):
        classes.setdefault(find(c), []).append(re.escape(c))
    some = "|".join(f"[{''.join(chars)}]+" for chars in sorted(classes.values(), key=len, reverse=True))
    return re.compile(f"{BLANK}*(?:{some})|{BLANK}+|." if some else f"{BLANK}+|.", re.DOTALL)


class Vocabulary:
    """Pieces, merge table and spelling of a SentencePiece BPE file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            model = list(_fields(f.read()))
        norm = {k: v for field, raw in model if field == 3 for k, v in _fields(raw)}
        train = {k: v for field, raw in model if field == 2 for k, v in _fields(raw)}
        if train.get(3) != 2 or norm.get(2) or norm.get(4, 1) or not norm.get(5, 1):
            raise ValueError(f"{path}: only BPE vocabularies without a rewriting normaliser are supported")
        self.dummy_prefix = bool(norm.get(3, 1))
        self.unknown_text = train.get(44, " ⁇ ".encode()).decode()
        rows = [dict(_fields(raw)) for field, raw in model if field == 1]
        self.names = [r[1].decode() for r in rows]
        kinds = [r.get(3, NORMAL) for r in rows]
        if USER in kinds or UNUSED in kinds:
            raise ValueError(f"{path}: user-defined and unused pieces aren't supported")
        scores = [struct.unpack("<f", r[2])[0] if 2 in r else 0.0 for r in rows]
        self.size = len(rows)
        self.unknown, self.begin, self.end = kinds.index(UNKNOWN), train.get(41, 1), train.get(42, 2)
        self.byte_ids = [0] * 256
        for i, kind in enumerate(kinds):
            if kind == BYTE:
                self.byte_ids[int(self.names[i][3:5], 16)] = i
        self.has_bytes = BYTE in kinds
        normal = {self.names[i]: i for i, kind in enumerate(kinds) if kind == NORMAL}
        self._merges(normal, scores)
        self.plain = [i for i, kind in enumerate(kinds) if kind == NORMAL]
        self.bytes_of = [b"" if kind == CONTROL else bytes([int(name[3:5], 16)]) if kind == BYTE else
                         self.unknown_text.encode() if kind == UNKNOWN else name.replace(BLANK, " ").encode()
                         for name, kind in zip(self.names, kinds)]
        self.kinds, self.controls = kinds, frozenset(i for i, kind in enumerate(kinds) if kind == CONTROL)

    def _merges(self, normal: dict[str, int], scores: list[float]) -> None:
        """Sorted pair keys with rank and result.  A symbol is a piece's id, or ``size`` + code point for a
        character that is no piece of its own."""
        self.singles = {ord(p): i for p, i in normal.items() if len(p) == 1}
        points = np.array(sorted(self.singles), dtype=np.int64)
        self.points, self.point_ids = points, np.array([self.singles[p] for p in points.tolist()], dtype=np.int64)
        order = {s: k for k, s in enumerate(sorted({scores[i] for i in normal.values()}, reverse=True))}

        def symbol(part: str) -> int | None:
            return normal.get(part) if part in normal else self.size + ord(part) if len(part) == 1 else None
        pairs, bigrams = {}, set()
        for piece, i in normal.items():
            for k in range(1, len(piece)):
                bigrams.add(piece[k - 1:k + 1])
                left, right = symbol(piece[:k]), symbol(piece[k:])
                if left is not None and right is not None:
                    pairs[left << 21 | right] = order[scores[i]], i
        self.pairs = pairs
        keys = np.array(sorted(pairs), dtype=np.int64)
        self.keys = np.append(keys, np.int64(1) << np.int64(62))
        self.ranks = np.append(np.array([pairs[k][0] for k in keys.tolist()], dtype=np.int64), NONE)
        self.results = np.append(np.array([pairs[k][1] for k in keys.tolist()], dtype=np.int64), 0)
        if any(BLANK == b[1] != b[0] for b in bigrams):
            raise ValueError("pieces with a blank sign after another character aren't supported")
        self.words = word_pattern(bigrams)

    def symbols(self, points: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.points, points), len(self.points) - 1)
        return np.where(self.points[at] == points, self.point_ids[at], points + self.size)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NONE: no piece) and resulting symbol of each pair."""
        key = left << np.int64(21) | right
        at = np.searchsorted(self.keys, key)
        known = self.keys[at] == key
        return np.where(known, self.ranks[at], NONE), self.results[at]

    def spell(self, symbols: list[int]) -> list[int]:
        """Piece ids; characters that no piece covers become their bytes."""
        if not symbols or max(symbols) < self.size:
            return symbols
        out: list[int] = []
        for s in symbols:
            if s < self.size:
                out.append(s)
            elif self.has_bytes:
                out += [self.byte_ids[b] for b in chr(s - self.size).encode()]
            elif not out or out[-1] != self.unknown:  # neighbouring unknown characters are one
                out.append(self.unknown)
        return out


def merge_rounds(vocabulary: Vocabulary, words: list[str]) -> list[list[int]]:
    """The symbols that are left of each word."""
    out: list[list[int]] = [[] for _ in words]
    flat = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.int64)
    sym = vocabulary.symbols(flat)
    word = np.repeat(np.arange(len(words)), [len(w) for w in words])
    # Pair i is (symbol i, symbol i + 1); the last symbol of a word has none.
    rank, result = np.full(len(sym), NONE), np.zeros(len(sym), dtype=np.int64)
    inner = np.flatnonzero(word[:-1] == word[1:])
    rank[inner], result[inner] = vocabulary.look_up(sym[inner], sym[inner + 1])
    while len(sym):
        start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        place = np.arange(len(sym))
        least = np.minimum.reduceat(rank << np.int64(32) | place, start)
        going = least >> np.int64(32) < NONE
        if not going.all():
            # Words without a pair are done and leave.
            length = np.diff(np.append(start, len(sym)))
            done = np.repeat(~going, length)
            ends = np.cumsum(length[~going])
            left = sym[done].tolist()
            for w, a, b in zip(word[start[~going]].tolist(), [0, *ends.tolist()], ends.tolist()):
                out[w] = left[a:b]
            keep = ~done
            least = least[going]
            moved = np.cumsum(keep) - 1
            at = moved[least & np.int64(0xFFFFFFFF)]
            sym, word, rank, result = sym[keep], word[keep], rank[keep], result[keep]
        else:
            at = least & np.int64(0xFFFFFFFF)
        if not len(sym):
            break
        # All words merge their pair; the right symbol's place is taken out.
        sym[at] = result[at]
        gone = np.zeros(len(sym), dtype=bool)
        gone[at + 1] = True
        new = at - np.arange(len(at))  # one earlier symbol is gone for each earlier word
        keep = ~gone
        sym, word, rank, result = sym[keep], word[keep], rank[keep], result[keep]
        # The merged symbol's pairs to both sides are new.
        near = np.concatenate([new, new[new > 0] - 1])
        near = near[near + 1 < len(sym)]
        same = word[near] == word[near + 1]
        rank[new] = NONE
        near = near[same]
        rank[near], result[near] = vocabulary.look_up(sym[near], sym[near + 1])
    return out


def merge_heap(vocabulary: Vocabulary, word: str) -> list[int]:
    """As ``merge_rounds`` for one long word, its pairs taken from a heap by rank, then place."""
    sym: list[int] = vocabulary.symbols(np.frombuffer(word.encode("utf-32-le"), dtype="<u4").astype(np.int64)).tolist()
    after, before = list(range(1, len(sym) + 1)), list(range(-1, len(sym) - 1))
    after[-1] = -1
    heap: list[tuple[int, int, int]] = []

    def push(i: int) -> None:
        key = sym[i] << 21 | sym[after[i]]
        if key in vocabulary.pairs:
            heapq.heappush(heap, (vocabulary.pairs[key][0], i, key))
    for i in range(len(sym) - 1):
        push(i)
    while heap:
        _, i, key = heapq.heappop(heap)
        j = after[i]
        if sym[i] < 0 or j < 0 or sym[i] << 21 | sym[j] != key:
            continue  # one of the two has been merged since
        sym[i], sym[j] = vocabulary.pairs[key][1], -1
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
            push(i)
        if before[i] >= 0:
            push(before[i])
    return [s for s in sym if s >= 0]


class Encoder:
    """Texts to ids (little-endian unsigned 32-bit bytes), with the words of a task kept."""

    def __init__(self, path: str, ends: bool = True):
        self.vocabulary = Vocabulary(path)
        self.head, self.tail = ((np.array([i], dtype="<u4").tobytes() for i in (self.vocabulary.begin, self.vocabulary.end)) if ends else (b"", b""))
        self.kept: dict[str, bytes] = {}
        self.chars = 0

    def learn(self, words: set[str]) -> None:
        """Keep the ids of all these words; others are forgotten when there are too many."""
        new = [w for w in words if w not in self.kept]
        self.chars += sum(map(len, new))
        if len(self.kept) + len(new) > CACHED or self.chars > 16 * CACHED:
            self.kept, new = {}, list(words)
            self.chars = sum(map(len, new))
        v = self.vocabulary
        short = [w for w in new if len(w) <= LONG]
        left = [merge_heap(v, w) for w in new if len(w) > LONG]
        if short:
            left = merge_rounds(v, short) + left
        for w, symbols in zip(short + [w for w in new if len(w) > LONG], left):
            self.kept[w] = np.array(v.spell(symbols), dtype="<u4").tobytes()

    def stretches(self, text: str) -> Iterator[str]:
        """A text's parts of about STRETCH characters, cut before blanks that follow something else."""
        start = 0
        while len(text) - start > STRETCH:
            found = BREAK.search(text, start + STRETCH)
            if not found:
                break
            yield text[start:found.end()]
            start = found.end()
        yield text[start:]

    def words_of(self, parts: list[str]) -> list[bytes]:
        """The ids of each part; new words of all parts go through the rounds together."""
        words = [self.vocabulary.words.findall(part) for part in parts]
        self.learn(set().union(*words))
        return [b"".join([self.kept[w] for w in some]) for some in words]

    def encode(self, texts: list[str]) -> list[bytes]:
        front = BLANK if self.vocabulary.dummy_prefix else ""
        texts = [front + t.replace(" ", BLANK) if t else "" for t in texts]
        out: list[bytes] = []
        for a, b in row_chunks([len(t) for t in texts], STRETCH):
            if b - a > 1 or len(texts[a]) <= STRETCH:
                out += self.words_of(texts[a:b])
            else:
                out.append(b"".join([self.words_of([part])[0] for part in self.stretches(texts[a])]))
        return [self.head + ids + self.tail for ids in out]


class Decoder:
    """Ids to text; ids that the vocabulary lacks are an error, as in the library."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)

    def decode(self, ids: list[int]) -> str:
        v = self.vocabulary
        if ids and not 0 <= min(ids) <= max(ids) < v.size:
            raise ValueError("an id that the vocabulary lacks")
        # Bytes on both sides of a control piece aren't one character.
        parts, start = [], 0
        for i in [*(i for i, x in enumerate(ids) if x in v.controls), len(ids)]:
            parts.append(b"".join([v.bytes_of[x] for x in ids[start:i]]).decode("utf-8", "one-a-byte"))
            start = i + 1
        text = "".join(parts)
        if v.dummy_prefix:
            # The blank that encoding put in front: of the first piece that isn't a control piece.
            first = next((x for x in ids if x not in v.controls), None)
            if first is not None and v.kinds[first] == NORMAL and v.names[first].startswith(BLANK):
                text = text[1:]
        return text


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, ends: bool = True) -> DataFrame:
    """``doc_id, ids`` (array of int) for every row; with ``ends``, the begin and end ids are put around."""
    src = pick(docs, doc_id=id_col, text=text_col)
    path = path or piece_path()

    def make():
        encoder = Encoder(path, ends)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = [np.frombuffer(raw, dtype="<i4") for raw in encoder.encode([t or "" for t in batch.column("text").to_pylist()])]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])
        return step
    return map_batches(src, make, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(rows: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """``doc_id, text`` for every row of ids; null ids are none, null entries are left out."""
    src = pick(rows, doc_id=id_col, ids=ids_col)
    path = path or piece_path()

    def make():
        decoder = Decoder(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [decoder.decode([i for i in ids.as_py() or [] if i is not None]) for ids in batch.column("ids")]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])
        return step
    return map_batches(src, make, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """``doc_id, packed`` (the ids as little-endian unsigned 32-bit integers, as token files hold them) and
    ``decoded`` (the text that those ids decode to), in one pass over the texts."""
    src = pick(docs, doc_id=id_col, text=text_col)
    path = path or piece_path()

    def make():
        encoder, decoder = Encoder(path), Decoder(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            packed = encoder.encode([t or "" for t in batch.column("text").to_pylist()])
            texts = [decoder.decode(np.frombuffer(p, dtype="<u4").tolist()) for p in packed]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(packed, pa.binary()), pa.array(texts, pa.string())],
                                              ["doc_id", "packed", "decoded"])
        return step
    return map_batches(src, make, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, packed binary, decoded string")


def piece_digests(rows: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of ``round_trip`` rows."""
    return rows.select("doc_id", (F.octet_length("packed") / 4).cast("bigint").alias("n_tokens"), F.sha2("packed", 256).alias("ids_sha256"),
                       F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"))
