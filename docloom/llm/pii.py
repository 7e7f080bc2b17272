"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Each kind has a pattern, a validator and context words. A span starts from the kind's base score;
a helpful word within ``CONTEXT`` characters adds ``BOOST``, a harmful one takes it away. The base
kinds (email, ip, card, phone) are kept whenever their validator passes; the added kinds (iban, ssn,
short_card) also need a score of ``MIN_SCORE``.

Defined results: a null or empty text has no spans; repeated rows give repeated results; a null id
is carried through; an empty table gives no rows; other columns of ``detect``'s input are not looked at, those of
``redact_table``'s stay as they are, whatever their names. Every search is linear in the text, so very long texts are
scanned whole.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import map_batches, texts

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "short_card")
CONTEXT, BOOST, MIN_SCORE = 48, 0.25, 0.6

# Starting scores and context words of each kind.
BASE_SCORE = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.7, "ssn": 0.4, "short_card": 0.4}
HELPS = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "call", "tel", "mobile"),
    "iban": ("iban", "account", "bank", "konto"),
    "ssn": ("ssn", "social security", "tax id"),
    "short_card": ("card", "amex", "credit", "payment"),
}
HARMS = {"ip": ("version", "release"), "card": ("order", "serial"), "phone": ("serial", "isbn"), "ssn": ("part", "serial"), "short_card": ("order", "serial", "isbn")}

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A dotted quad, a card and a phone number never start within the digits of an earlier one, hence the look-behind.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_DIGIT = re.compile(r"[0-9]")
_NON_DIGIT = re.compile(r"[^0-9]")
_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        total += _DOUBLED[int(digit)] if place % 2 else int(digit)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    compact = iban.replace(" ", "")
    if not 15 <= len(compact) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: the longest local part before each @ that reaches back no further than the last match."""
    found, floor = [], 0
    for m in _AT.finditer(text):
        start = at = m.start()
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            found.append((start, m.end()))
            floor = m.end()
    return found


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _score(kind: str, around: str) -> float:
    score = BASE_SCORE[kind]
    if any(word in around for word in HELPS[kind]):
        score += BOOST
    if any(word in around for word in HARMS.get(kind, ())):
        score -= BOOST
    return round(min(1.0, max(0.0, score)), 2)


def find_spans(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) in code points, by kind in the order of ``KINDS``, then by start."""
    spans: list[tuple[str, int, int]] = []
    if "@" in text:
        spans += [("email", a, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        spans += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_small, m.group().split(".")))]
        short = []
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = _NON_DIGIT.sub("", m.group())
                if 13 <= len(digits) <= 19 and luhn(digits):
                    (spans if len(digits) >= 16 else short).append(("card" if len(digits) >= 16 else "short_card", *m.span()))
        if "+" in text:
            spans += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_NON_DIGIT.sub("", m.group())) <= 15]
        spans += [("iban", *m.span()) for m in _IBAN.finditer(text) if mod97(m.group())]
        spans += [("ssn", *m.span()) for m in _SSN.finditer(text)]
        spans += short
    out = []
    for kind, start, end in spans:
        score = _score(kind, (text[max(0, start - CONTEXT) : start] + " " + text[end : end + CONTEXT]).lower())
        if kind in BASE_KINDS or score >= MIN_SCORE:
            out.append((kind, start, end, score))
    return out


def redact(text: str, spans: list[tuple[str, int, int, float]]) -> str:
    """The text with each span, or run of overlapping spans, replaced by the tag of the first kind in it."""
    parts, done = [], 0
    for kind, start, end, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= done:
            parts += [text[done:start], f"<{kind.upper()}>"]
        done = max(done, end)
    return "".join(parts) + text[done:]


def detect(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", redacted: bool = True) -> DataFrame:
    """One row per document: doc_id, spans array<struct<kind,start,end,score>> and, unless not wanted, redacted
    string. No shuffle."""

    def run(batch: pa.RecordBatch) -> dict:
        found, clean = [], []
        for text in batch.column("text").to_pylist():
            spans = find_spans(text)
            found.append([dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in spans])
            if redacted:
                clean.append(redact(text, spans) if spans else text)
        return {"doc_id": batch.column("doc_id"), "spans": found, "redacted": clean}

    schema = "doc_id long, spans array<struct<kind:string,start:int,end:int,score:double>>" + (", redacted string" if redacted else "")
    return map_batches(texts(df, id_col, text_col), run, schema)


def span_digest(found: DataFrame) -> DataFrame:
    """Counts, digest and span list of ``detect``'s rows, in SQL."""
    label = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        "doc_id",
        *map(count, KINDS[:4]),
        F.sha2(F.array_join(F.transform(base, label), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", label), ",").alias("spans"),
        *map(count, KINDS[4:]),
        F.array_join(F.transform("spans", lambda s: F.format_string("%.2f", s["score"])), ",").alias("scores"),
    )


def redact_table(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with personal data in ``text_col`` replaced by tags; null texts stay null. No shuffle."""

    @F.pandas_udf("string")
    def clean(column):  # noqa: ANN001, ANN202
        return column.map(lambda t: t if t is None else redact(t, find_spans(t)))

    return df.withColumn(text_col, clean(F.col(text_col)))


