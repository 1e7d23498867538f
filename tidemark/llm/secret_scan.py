"""Secrets in texts: a keyword automaton finds where to look, anchored patterns decide there, checksums confirm.

One pass over the texts in Arrow batches; nothing is shuffled. Every text is scanned whole, as UTF-8 bytes, since all patterns
are ASCII; offsets are turned into code points at the end.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import query, table

# Kinds in the order in which spans with one start are listed.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "github", "npm", "iban", "card")

# The patterns of the three base kinds, and of tokens that carry a checksum.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{32,}")
GITHUB = re.compile(rb"gh[pousr]_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
NPM = re.compile(rb"npm_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
IBAN = re.compile(rb"(?i:iban)[\x20:=\"']{0,4}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
CARD = re.compile(rb"card[^0-9\n]{0,24}([0-9](?:[\x20-]?[0-9]){12,18})(?![0-9])", re.IGNORECASE)
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 8, 16, 32

BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def crc_tail(body: bytes) -> bytes:
    """Six base-62 digits of the CRC-32 of a token's random part."""
    value, out = zlib.crc32(body), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        out = BASE62[digit] + out
    return out.encode()


def luhn(number: bytes) -> bool:
    total = 0
    for place, digit in enumerate(reversed([c - 48 for c in number if 48 <= c <= 57])):
        total += digit if place % 2 == 0 else (2 * digit - 9 if digit > 4 else 2 * digit)
    return total % 10 == 0


def iban_holds(code: bytes) -> bool:
    code = code.replace(b" ", b"").upper().decode()
    return 15 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


# What each keyword leads to: kind, pattern, group that is the span, and what must hold.
Rule = tuple[str, re.Pattern, int, Callable[[re.Match], bool]]
_ASSIGN: Rule = ("assign", ASSIGN, 0, lambda m: len(m[2]) >= LEAST_VALUE)
_GITHUB: Rule = ("github", GITHUB, 0, lambda m: crc_tail(m[1]) == m[2])
RULES: dict[str, Rule] = {
    **dict.fromkeys(("password", "passwd", "secret", "token", "apikey", "api_key"), _ASSIGN),
    "akia": ("access", ACCESS, 0, lambda m: len(m[0]) >= LEAST_ACCESS),
    **dict.fromkeys(("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), _GITHUB),
    "npm_": ("npm", NPM, 0, lambda m: crc_tail(m[1]) == m[2]),
    "iban": ("iban", IBAN, 1, lambda m: iban_holds(m[1])),
    "card": ("card", CARD, 1, lambda m: luhn(m[1])),
}

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_HEX_OR_NOT = bytes(104 if chr(c) in "0123456789abcdef" else 32 for c in range(256))
_HEX_RUN = b"h" * LEAST_HEX


def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for word in RULES:
        found.add_word(word, word)
    found.make_automaton()
    return found


def spans_of(data: bytes, keywords) -> list[tuple[int, int, str]]:
    """(start, end, kind) in bytes of all secrets of a text, by start, then kind as listed."""
    out = []
    hits = [(end - len(word) + 1, word) for end, word in keywords.iter(data.translate(_LOWER).decode("latin-1"))]
    reached: dict[str, int] = {}  # per kind: where its last match ended, kept or not
    for start, word in sorted(hits):
        kind, pattern, group, holds = RULES[word]
        if start < reached.get(kind, 0):
            continue
        m = pattern.match(data, start)
        if m:
            reached[kind] = m.end()
            if holds(m):
                out.append((m.start(group), m.end(group), kind))
    if _HEX_RUN in data.translate(_HEX_OR_NOT):
        out += [(m.start(), m.end(), "hex") for m in HEX.finditer(data)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def in_code_points(data: bytes, spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Byte offsets to code points."""
    if not spans or data.isascii():
        return spans
    inner = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) == 0x80).tolist()  # bytes that continue a code point
    return [(a - bisect.bisect_left(inner, a), b - bisect.bisect_left(inner, b), kind) for a, b, kind in spans]


SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keywords = automaton()
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        found = []
        for value in texts:
            data = value.as_py() or b""
            found.append([{"kind": k, "start": a, "end": b} for a, b, k in in_code_points(data, spans_of(data, keywords))] if data else [])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, _SPAN)], ["doc_id", "spans"])


def scan_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id, spans`` of every row of ``docs`` (``doc_id, text``; other columns are ignored).

    Spans are (kind, start, end) in code points, end exclusive, by start and then kind. Kinds ``assign, access, hex`` follow their
    patterns alone, leftmost without overlap within a kind; ``github, npm, iban, card`` must also satisfy the checksum they
    carry. Null and empty texts have no spans; repeated rows are scanned each; without rows the result is empty.
    """
    rows = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_scan, f"doc_id {kind}, spans {SPANS}")


@query("op10_secret_spans")
def op10(spark, sf_dir):
    found = scan_secrets(table(spark, sf_dir, "documents"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select("doc_id", *(count(k) for k in BASE_KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
