"""Personal data in texts: patterns propose, validators confirm, context words adjust the score.

Base kinds (e-mail, IP, payment card, phone) are reported wherever their pattern and check hold.
Further kinds (account and identity numbers, secrets) are reported when their score reaches
``THRESHOLD``: it starts from what pattern and checksum alone are worth, words near the span that name
the kind raise it, and words that name something else of that look lower it.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "nir", "dni", "secret")  # listing order for spans of one start
THRESHOLD = 0.6
NEAR = 48  # characters before and after a span that are searched for context words

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_NIR = re.compile(r"(?<![0-9])[12]\x20?[0-9]{2}\x20?(?:0[1-9]|1[0-2])\x20?[0-9]{2}\x20?[0-9]{3}\x20?[0-9]{3}\x20?[0-9]{2}(?![0-9])")
_DNI = re.compile(r"(?<![A-Za-z0-9])(?:[0-9]{8}|[XYZ][0-9]{7})-?[A-Z](?![A-Za-z0-9])")
_SECRET = re.compile(r"(?<![A-Za-z0-9_/+-])[A-Za-z0-9_/+-]{20,}={0,2}(?![A-Za-z0-9_/+=-])")
_DIGIT = re.compile(r"[0-9]")

#: Context words of the kinds that need them (fixed list).
CONTEXT = {
    "email": ("mail", "contact", "write to"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "transfer", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social security"),
    "nir": ("nir", "insee", "carte vitale", "securite sociale", "sécurité sociale"),
    "dni": ("dni", "nif", "nie", "documento", "identidad"),
    "secret": ("token", "secret", "password", "passwd", "api key", "api_key", "apikey", "access key", "access_key", "auth", "bearer", "credential"),
}
#: Words that name something else of the same look (fixed list).
AGAINST = {
    "iban": ("serial", "part no", "part number", "isbn", "order no", "order number"),
    "ssn": ("part no", "part number", "order no", "order number", "serial"),
    "nir": ("serial", "order no", "order number", "isbn"),
    "dni": ("serial", "part no", "part number"),
    "secret": ("commit", "sha1", "sha256", "md5", "checksum", "digest", "etag", "revision"),
}
#: Score of a span by its pattern and validator alone, and what context words add or take.
BASE_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.7, "ssn": 0.3, "nir": 0.65, "dni": 0.4, "secret": 0.35}
CONTEXT_SCORE = 0.35
AGAINST_SCORE = 0.35
MIN_ENTROPY = 3.0  # bits a character that a secret has at least
_DNI_LETTERS = "TRWAGMYFPDXBNJZSQVHLCKE"  # check letter by the number modulo 23 (fixed value)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    text = iban.replace(" ", "")
    return 15 <= len(text) <= 34 and int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def _ssn_ok(span: str) -> bool:
    area, group, serial = span.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


def _nir_ok(span: str) -> bool:
    digits = span.replace(" ", "")
    return int(digits[13:]) == 97 - int(digits[:13]) % 97


def _dni_ok(span: str) -> bool:
    span = span.replace("-", "")
    number = int(str("XYZ".find(span[0])) + span[1:-1] if span[0] in "XYZ" else span[:-1])
    return _DNI_LETTERS[number % 23] == span[-1]


def _secret_ok(span: str) -> bool:
    """Letters and digits, as mixed as random ones: words and numbers are not."""
    if not (_DIGIT.search(span) and re.search("[A-Za-z]", span)):
        return False
    n = len(span)
    return -sum(c / n * math.log2(c / n) for c in Counter(span).values()) >= MIN_ENTROPY


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from each @ outwards."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
        at = text.find("@", max(at + 1, free))


def _ip_ok(span: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-4:] if len(p) > 4 else p) <= 255 for p in span.split("."))


def _card_ok(span: str) -> bool:
    digits = span.replace(" ", "").replace("-", "")
    return 14 <= len(digits) <= 19 and luhn(digits)


def _phone_ok(span: str) -> bool:
    return 10 <= sum(c.isdigit() for c in span) <= 15


def _iban_spans(text: str) -> Iterator[tuple[int, int]]:
    """The longest stretch from each start whose checksum holds, cut at its inner spaces; the search
    goes on after that stretch, or at the next word where none holds."""
    m = _IBAN.search(text)
    while m:
        span = m[0]
        while span and not mod97(span):
            span = span.rpartition(" ")[0]
        if span:
            yield m.start(), m.start() + len(span)
        skip = len(span) or m[0].find(" ") + 1 or len(m[0])
        m = _IBAN.search(text, m.start() + skip)


def _score(kind: str, text: str, start: int, end: int) -> float:
    """Context words are those beside the span, not inside it."""
    near = f"{text[max(0, start - NEAR):start]}\n{text[end:end + NEAR]}".lower()
    score = BASE_SCORE[kind] + CONTEXT_SCORE * any(w in near for w in CONTEXT[kind])
    return max(0.0, min(1.0, score) - AGAINST_SCORE * any(w in near for w in AGAINST.get(kind, ())))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base kinds in code points, sorted by start, then kind as listed."""
    found = [(s, e, "email") for s, e in _emails(text)]
    if _DIGIT.search(text):
        found += [(m.start(), m.end(), "ip") for m in _IP.finditer(text) if _ip_ok(m[0])]
        found += [(m.start(), m.end(), "card") for m in _CARD.finditer(text) if _card_ok(m[0])]
        if "+" in text:
            found += [(m.start(), m.end(), "phone") for m in _PHONE.finditer(text) if _phone_ok(m[0])]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def more_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the further kinds whose score reaches ``THRESHOLD``."""
    if not _DIGIT.search(text):
        return []
    found = [(s, e, "iban") for s, e in _iban_spans(text)]
    for kind, pattern, ok in (("ssn", _SSN, _ssn_ok), ("nir", _NIR, _nir_ok), ("dni", _DNI, _dni_ok), ("secret", _SECRET, _secret_ok)):
        found += [(m.start(), m.end(), kind) for m in pattern.finditer(text) if ok(m[0])]
    return [(s, e, k) for s, e, k in found if _score(k, text, s, e) >= THRESHOLD]


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                             ("score", pa.float64()), ("base", pa.bool_())]))


def find_personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, spans), one row per input row; spans: array of (kind, start, end, score, base) by
    start, then kind, in code points, end exclusive.

    Null and empty texts have no spans; texts of any length are searched whole; null and repeated
    ids pass through; an empty table gives none."""

    def spans(text: str | None) -> list[dict]:
        if not text:
            return []
        base = base_spans(text)
        rows = [(s, e, k, True) for s, e, k in base]
        rows += [(*x, False) for x in more_spans(text)]
        rows.sort(key=lambda r: (r[0], KINDS.index(r[2])))
        return [{"kind": k, "start": s, "end": e, "score": _score(k, text, s, e), "base": b} for s, e, k, b in rows]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([spans(t) for t in batch.column(1).to_pylist()], _SPANS)
            yield pa.RecordBatch.from_arrays([batch.column(0), found], ["id", "spans"])

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, spans array<struct<kind:string,start:int,end:int,score:double,base:boolean>>") \
               .withColumnRenamed("id", id_col)
