"""Secret scan: fixed patterns plus dictionary-primed zstandard novelty.

Base kinds are three fixed patterns (``assign``, ``access``, ``hex``), leftmost and
non-overlapping per kind, judged on the whole text.  On top of them every *candidate* - a
long unbroken string that isn't a number and stands in a sensitive context (a cue
word such as ``key`` or ``credential`` shortly before it, or a quoted assignment) - is
measured: the bytes that it adds when it is compressed between its surrounding text by a
zstandard compressor primed with a dictionary of common identifiers.  Names, paths and
repeated values are found in the dictionary or in the surroundings and add little; a
random key can't be.  Candidates that add at least ``min_rate`` bytes per character (without a
digit, ``LETTERS_RATE``) are reported as ``novel``; of one that base spans overlap, the parts that they leave are measured.

Row-local: no shuffle, one pass, memory of one Arrow batch.

Defined results: a null text is empty and has no spans; rows, ids (null ids too) and
repeated rows are kept one to one; other input columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kind_count, map_batches, pick, span_text

# Fixed patterns of the base kinds, in their listed order (ASCII letters in either case for the cues of assign).
ASSIGN = re.compile(r"""(?a:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # [0-9a-f]+ of 24+ characters: the same matches, without the short ones
KINDS = ("assign", "access", "hex", "novel")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
CUES = re.compile(r"(?a:(?i:key|secret|token|passw|pwd|auth|credential|bearer|private|signature|cert|session|cookie|salt))")
QUOTED = re.compile(r"""[:=]\x20*["']$""")

# Fixed dictionary: words that identifiers and configuration are made of.
IDENTIFIERS = (
    "abstract account action address admin allow application archive argument array async attribute author await backup "
    "base batch begin binary block boolean branch bucket buffer build bundle bytes cache callback cancel catalog category "
    "channel character charset checksum class client cluster code collection color column command comment commit common "
    "compile component compress config configuration connection console const constant constructor container content "
    "context continue control controller convert cookie count create current customer database dataset date debug "
    "declare default define delete dependency deploy describe description destination device dictionary directory "
    "disable display document domain double download driver dynamic editor element email enable encode encoding endpoint "
    "engine entity environment error event example except exception execute export extension extends factory false "
    "feature field file filter final finally float folder format frame framework function gateway generate getValue "
    "global group handler hash header height hidden history host html http https identifier image implements import "
    "include index information initialize inline input insert instance integer interface internal invalid item iterator "
    "javascript json keyword label language layout length level library license limit listener loader local location "
    "logger login manager mapping master maximum member memory message metadata method middleware minimum model module "
    "monitor namespace native network node normalize notification null number object offset operation operator option "
    "order origin output override package parameter parent parse password path pattern payload permission pipeline "
    "platform plugin pointer policy position prefix previous primary print private process processor production profile "
    "project promise property protected protocol provider proxy public python query queue random range reader receive "
    "record reference refresh regex region register registry release remote remove render replace repository request "
    "require reset resource response result return router runtime sample scale schedule schema scope script search "
    "secret section secure security select sender separator sequence server service session setValue setting shared "
    "signature simple single size socket source stage standard start state static status storage store stream string "
    "struct style subject submit suffix summary support switch symbol synchronized syntax system table target task "
    "template temporary test text thread throw timeout timestamp title token tool topic total trace transaction "
    "transform trigger true type undefined union unique update upload user username utility validate value variable "
    "vector version video view virtual void volume warning width window worker wrapper write yaml yield zone"
)
BEFORE, AFTER, CUE_REACH = 256, 128, 48
MIN_RATE = 0.55
LETTERS_RATE = 0.95  # of candidates without a digit: words add fewer bytes a letter, random letters more
LEAST_PART = 16  # characters of a candidate that no base span covers

SPAN = "struct<kind:string,start:bigint,end:bigint,added_bytes:int>"


class NoveltyScanner:
    """All spans of one text, with the compressed bytes that each adds to its surroundings."""

    def __init__(self, min_rate: float = MIN_RATE):
        self.min_rate = min_rate
        words = IDENTIFIERS.split()
        text = " ".join(words) + " " + "_".join(words) + " " + "".join(w.capitalize() for w in words)
        primed = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        primed.precompute_compress(level=3)
        self.zstd = zstandard.ZstdCompressor(dict_data=primed, write_content_size=False, write_checksum=False, write_dict_id=False)

    def added(self, text: str, start: int, end: int) -> int:
        pre = text[max(0, start - BEFORE):start].encode("utf-8", "replace")
        post = text[end:end + AFTER].encode("utf-8", "replace")
        return len(self.zstd.compress(pre + text[start:end].encode() + post)) - len(self.zstd.compress(pre + post))

    def scan(self, text: str) -> list[tuple[str, int, int, int]]:
        """Spans by start, then kind as listed."""
        found = [("assign", m.start(), m.end(), m.start(1)) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
        found += [("access", m.start(), m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
        found += [("hex", m.start(), m.end(), m.start()) for m in HEX.finditer(text)]
        spans = [(kind, a, b, self.added(text, value, b)) for kind, a, b, value in found]
        covered = sorted((a, b) for _, a, b, _ in spans)
        begins, reach = [a for a, _ in covered], 0
        ends = [reach := max(reach, b) for _, b in covered]
        for m in CANDIDATE.finditer(text):
            if m.group().isdigit():
                continue
            for a, b in uncovered(*m.span(), covered, begins, ends):
                before = text[max(0, a - CUE_REACH):a]
                if CUES.search(before) or QUOTED.search(before):
                    size = self.added(text, a, b)
                    rate = self.min_rate if any(c.isdigit() for c in text[a:b]) else max(self.min_rate, LETTERS_RATE)
                    if size >= rate * (b - a):
                        spans.append(("novel", a, b, size))
        return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def uncovered(a: int, b: int, covered: list[tuple[int, int]], begins: list[int], ends: list[int]) -> list[tuple[int, int]]:
    """The parts of a candidate that no base span covers: all of it, or what is left, if it is long enough.  ``begins`` are the
    starts of the ``covered`` ranges, ``ends`` the greatest end so far."""
    first, last = bisect_right(ends, a), bisect_right(begins, b - 1)
    if first >= last:
        return [(a, b)]
    out, at = [], a
    for x, y in covered[first:last]:
        if x - at >= LEAST_PART:
            out.append((at, x))
        at = max(at, y)
    return out + [(at, b)] if b - at >= LEAST_PART else out


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_rate: float = MIN_RATE) -> DataFrame:
    """One row per input row: ``doc_id`` and ``spans``, an array of (kind, start, end, added_bytes)."""
    src = pick(docs, doc_id=id_col, text=text_col)
    kind = src.schema["doc_id"].dataType.simpleString()

    def make():
        scanner = NoveltyScanner(min_rate)
        names = ("kind", "start", "end", "added_bytes")

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            spans = [[dict(zip(names, s)) for s in scanner.scan(t.as_py() or "")] for t in batch.column("text")]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, SPAN_ARROW)], ["doc_id", "spans"])
        return step
    return map_batches(src, make, f"doc_id {kind}, spans array<{SPAN}>")


SPAN_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("added_bytes", pa.int32())]))


def secret_digests(found: DataFrame) -> DataFrame:
    """Digest columns of ``find_secrets``: counts per base kind, hash of the base spans, all spans as text."""
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"] != "novel")
    return found.select("doc_id", *[kind_count(spans, k).alias(f"n_{k}") for k in KINDS[:3]],
                        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(spans).alias("spans"), kind_count(spans, "novel").alias("n_novel"))
