"""Personal data by anchor expansion.

One Aho-Corasick automaton walks the text once and reports anchors: ``@``, ``+``, digits,
URL schemes and identifier cues.  From each anchor a deterministic local parser expands to
both sides and validates what it finds:

* ``email``: from ``@`` left over local-part characters, right over a dotted domain;
* ``ip``: from a digit over four dotted numbers, each at most 255;
* ``card``: from a digit over 13 to 19 digits with single blanks or hyphens, Luhn checked;
* ``phone``: from ``+`` over 9 to 15 digits with blanks, dots, brackets and hyphens;
* ``url``: from a scheme over ``user:password@host``;
* ``account``: from a cue (``IBAN``, ``SSN``, ``account no`` ...) to the identifier that follows:
  an IBAN with a right mod-97 check, a social security number, or 6 to 20 digits.

The first four are the base kinds: leftmost, non-overlapping per kind, a failing match is
dropped and not retried.  ``url`` and ``account`` are added spans.

Row-local: no shuffle, one pass.  A null text is empty; rows, null ids and repeated rows are
kept one to one; other input columns are ignored by ``find_pii`` and kept by ``mask_pii``.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kind_count, map_batches, pick, span_text

KINDS = ("email", "ip", "card", "phone", "url", "account")
BASE = KINDS[:4]

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DIGITS = re.compile(r"[0-9]++")
IP = re.compile(r"([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
USERINFO = re.compile(r"[A-Za-z0-9._~%!$&'()*+,;=-]+:[^\s@/]+@[A-Za-z0-9.-]+(?::[0-9]+)?")
CUE_GAP = re.compile(r"(?a:\x20?(?:number|num|nr|no|id)?\.?\x20*[:#=]?\x20*)", re.IGNORECASE)
IBAN = re.compile(r"[A-Za-z]{2}[0-9]{2}(?:\x20?[A-Za-z0-9]){11,30}")
SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
ACCOUNT = re.compile(r"[0-9](?:[\x20-]?[0-9]){5,19}(?![0-9])")

# Fixed lengths of account numbers by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22,
    "DK": 18, "DO": 28, "EE": 20, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28,
    "IE": 22, "IL": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22,
    "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24,
    "SI": 19, "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29, "VG": 24, "XK": 20,
}

# Fixed anchors: schemes and identifier cues, in lower case; found in any case.
SCHEMES = ("http://", "https://", "ftp://", "ftps://", "sftp://", "ssh://", "smtp://", "imap://", "jdbc:", "mongodb://", "redis://", "amqp://")
CUES = ("iban", "ssn", "social security", "account", "acct", "passport", "routing", "customer id", "tax id")


def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    a.add_word("@", "@")
    a.add_word("+", "+")
    for d in "0123456789":
        a.add_word(d, "0")
    for words, kind in ((SCHEMES, "scheme"), (CUES, "cue")):
        for w in words:
            a.add_word(w, kind)
    a.make_automaton()
    return a


LOWER = {c: c + 32 for c in range(65, 91)}


def lowered(text: str) -> str:
    """``text`` in lower case with the same offsets."""
    low = text.lower()
    return low if len(low) == len(text) else text.translate(LOWER)  # some letters have a longer lower case


def luhn(digits: str) -> bool:
    odd = sum(int(d) for d in digits[-1::-2])
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def iban_ok(raw: str) -> bool:
    s = raw.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def iban_end(text: str, start: int, end: int) -> int | None:
    """Where the account number that starts here ends: before a character that can't go on a word, with the length of its country
    (any, if that isn't listed) and a right checksum; the longest of several."""
    country = IBAN_LENGTHS.get(text[start:start + 2].upper())
    for stop in range(end, start + 14, -1):
        if text[stop - 1] == " " or (stop < len(text) and text[stop].isalnum()):
            continue
        raw = text[start:stop].upper()
        if (country is None or len(raw) - raw.count(" ") == country) and iban_ok(raw):
            return stop
    return None


def left_run(text: str, low: int, end: int, chars: str) -> int:
    """Start of the longest run of ``chars`` that ends at ``end`` and doesn't pass ``low``."""
    width = 64
    while True:
        start = max(low, end - width)
        part = text[start:end]
        kept = len(part.rstrip(chars))
        if kept or start == low:
            return start + kept
        width *= 4


def small(number: str) -> bool:
    n = number.lstrip("0")
    return len(n) <= 3 and int(n or "0") <= 255


class AnchorScanner:
    """All spans of one text, by kind as listed and then by start."""

    def __init__(self):
        self.anchors = automaton()

    def scan(self, text: str) -> list[tuple[str, int, int]]:
        found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
        at = dict.fromkeys(KINDS, 0)  # where the next match of a kind may start
        for last, anchor in self.anchors.iter(lowered(text)):
            if anchor == "0":
                if last >= at["ip"]:
                    self._ip(text, last, found, at)
                if last >= at["card"]:
                    self._card(text, last, found, at)
            elif anchor == "@":
                self._email(text, last, found, at)
            elif anchor == "+":
                if last >= at["phone"]:
                    self._phone(text, last, found, at)
            elif anchor == "scheme":
                m = USERINFO.match(text, last + 1)
                if m and last >= at["url"]:
                    found["url"].append(m.span())
                    at["url"] = m.end()
            elif last >= at["account"]:
                self._account(text, last + 1, found, at)
        return [(k, a, b) for k in KINDS for a, b in found[k]]

    @staticmethod
    def _email(text, i, found, at):
        start = left_run(text, at["email"], i, LOCAL)
        m = DOMAIN.match(text, i + 1) if start < i else None
        if m:
            found["email"].append((start, m.end()))
            at["email"] = m.end()

    @staticmethod
    def _ip(text, i, found, at):
        m = IP.match(text, i)
        if not m:
            at["ip"] = DIGITS.match(text, i).end()  # no later start in this run of digits can do better
            return
        at["ip"] = m.end()
        if all(map(small, m.groups())):
            found["ip"].append(m.span())

    @staticmethod
    def _card(text, i, found, at):
        m = CARD.match(text, i)
        if not m:
            at["card"] = i + 1
            return
        at["card"] = m.end()
        if m.end() - i <= 37:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                found["card"].append(m.span())

    @staticmethod
    def _phone(text, i, found, at):
        m = PHONE.match(text, i)
        if m:
            at["phone"] = m.end()
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                found["phone"].append(m.span())

    @staticmethod
    def _account(text, i, found, at):
        i = CUE_GAP.match(text, i).end()
        for parser in (IBAN, SSN, ACCOUNT):
            m = parser.match(text, i)
            end = m and (iban_end(text, *m.span()) if parser is IBAN else m.end())
            if end:
                found["account"].append((i, end))
                at["account"] = end
                return


SPAN_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id`` and ``spans``, an array of (kind, start, end)."""
    src = pick(docs, doc_id=id_col, text=text_col)
    kind = src.schema["doc_id"].dataType.simpleString()

    def make():
        scanner = AnchorScanner()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            spans = [[dict(zip(("kind", "start", "end"), s)) for s in scanner.scan(t.as_py() or "")] for t in batch.column("text")]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, SPAN_ARROW)], ["doc_id", "spans"])
        return step
    return map_batches(src, make, f"doc_id {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>")


def pii_digests(found: DataFrame) -> DataFrame:
    """Digest columns of ``find_pii``: counts per base kind, hash of the base spans, all spans as text."""
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE))
    return found.select("doc_id", *[kind_count(spans, k).alias(f"n_{k}") for k in BASE], F.sha2(span_text(base), 256).alias("base_sha256"),
                        span_text(spans).alias("spans"), *[kind_count(spans, k).alias(f"n_{k}") for k in KINDS[len(BASE):]])


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with each span replaced by its kind in brackets; overlapping spans become one."""
    out, end = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            out += [text[end:a], f"[{kind.upper()}]"]
        end = max(end, b)
    return "".join([*out, text[end:]])


def mask_pii(docs: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` with the personal data of ``text_col`` masked, all other columns as they were.

    A null text stays null.  With ``length_col`` that column is set to the new length of each
    text that changed.  Rows without personal data come back unchanged.
    """
    at = docs.columns.index(text_col)
    n_at = docs.columns.index(length_col) if length_col else -1

    def make():
        scanner = AnchorScanner()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(at).to_pylist()
            lengths = batch.column(n_at).to_pylist() if n_at >= 0 else []
            for i, text in enumerate(texts):
                if text and (spans := scanner.scan(text)):
                    texts[i] = masked(text, spans)
                    if n_at >= 0:
                        lengths[i] = len(texts[i])
            cols = list(batch.columns)
            cols[at] = pa.array(texts, batch.schema.field(at).type)
            if n_at >= 0:
                cols[n_at] = pa.array(lengths, batch.schema.field(n_at).type)
            return pa.RecordBatch.from_arrays(cols, names=batch.schema.names)
        return step
    return map_batches(docs, make, docs.schema)


__all__ = ["AnchorScanner", "find_pii", "mask_pii", "masked", "pii_digests"]
