"""Format-preserving pseudonyms for personal data.

Detected values are permuted by a keyed Feistel network inside their own format, so a value is replaced by another of
the same shape, equal values are replaced alike in every document, and who holds the key can undo it. Card numbers keep
a valid check digit, dates stay dates, phone numbers keep their punctuation and prefix, addresses their dots.

Numbers and dates are validated before they are replaced, and what fails stays: a card number by its issuer, length and
check digit, an IBAN by mod 97, a social security number by its ranges, a phone number by country code and length, an IP
address by its parts, a date by the calendar. The replacement of a valid value is valid, with right check digits. Where a
run of digits is not valid as a whole, its groups are looked at. E-mail addresses and secrets (the value after a word
such as token, key, password) are permuted letter for letter. A secret is quoted, or has a digit or a capital behind a
small letter, so that prose after such a word stays.

The key is ``spark.helixframe.pii.key`` of the session; without it a key that anybody can read here is used, with a
warning. Values of over 48 characters are permuted in pieces of 48, each by its place, so their time grows with their length.

Null texts stay null; empty ones are unchanged, an empty table stays empty. Rows that repeat are treated alike. Whole
texts are scanned, in time proportional to their length. Columns of the input named like an output column are replaced.
"""

from __future__ import annotations

import datetime
import hashlib
import logging
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T

KEY = b"helixframe-demonstration-key"
KEY_SETTING = "spark.helixframe.pii.key"
ROUNDS = 8
# A round's digest has 128 bits; half of a piece has fewer.
PIECE = 48
DAY_ZERO, DAYS = datetime.date(1900, 1, 1).toordinal(), 73_049  # 1900 to 2099

# What is looked for. Order decides when two begin at the same place.
PATTERNS = {
    "secret": r"(?i:\b(?:token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|auth)\b\s*[=:]\s*)(?:\"[^\"\n]{4,}\"|'[^'\n]{4,}'|[A-Za-z0-9_\-+/.]{8,})",
    "email": r"(?<![A-Za-z0-9_.+%-])[.+%-]*[A-Za-z0-9_][A-Za-z0-9_.+%-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "date": r"(?<![\d.\-/])(?:(?:19|20)\d\d([-/.])\d{1,2}\1\d{1,2}|\d{1,2}([-/.])\d{1,2}\2(?:19|20)\d\d)(?![\d\-/]|\.\d)",
    "ip": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d]|\.\d)",
    "card": r"(?<![\dA-Za-z])\d(?:[ -]?\d){12,18}(?![\dA-Za-z])",
    "phone": r"(?<![\dA-Za-z])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3,4}[ .-]?\d{4}(?![\dA-Za-z])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
}
# First digits of card issuers, as ranges, with the lengths they give out.
ISSUERS = [
    ("4", "4", {13, 16, 19}), ("51", "55", {16}), ("2221", "2720", {16}), ("34", "34", {15}), ("37", "37", {15}), ("6011", "6011", range(16, 20)),
    ("644", "659", range(16, 20)), ("62", "62", range(16, 20)), ("81", "82", range(16, 20)), ("3528", "3589", range(16, 20)), ("36", "36", range(14, 20)),
    ("38", "39", range(14, 20)), ("300", "305", range(14, 20)), ("3095", "3095", range(14, 20)), ("2200", "2204", range(16, 20)), ("60", "60", {16}), ("508", "508", {16}),
    ("5018", "5020", range(13, 20)), ("5038", "5038", range(13, 20)), ("5893", "5893", range(13, 20)), ("6304", "6304", range(13, 20)),
    ("6759", "6763", range(13, 20)), ("9792", "9792", {16}), ("1", "1", {15}), ("506099", "506198", range(16, 20)),
]
# Assigned country calling codes; none is the beginning of another.
COUNTRY_CODE = re.compile(
    r"1|7|2(?:0|7|1[12368]|[2346]\d|5[0-8]|9[01789])|3(?:[0123469]|5\d|7\d|8[0-35-79])|4(?:[013-9]|2[013])|5(?:[1-8]|0\d|9\d)"
    r"|6(?:[0-6]|7[02-9]|8[0-35-9]|9[0-2])|8(?:[1246]|0[08]|5[02356]|7[0-4]|8[0-368]|78)|9(?:[0-58]|6[0-8]|7[0-79]|9[2-68])")
# A text without any of these characters holds nothing that is looked for.
HINT = re.compile(r"[\d@=:]")
FINDER = re.compile("|".join(f"(?P<{n}>{p.replace(chr(92) + '1', '(?P=d1)').replace('([-/.])', '(?P<d1>[-/.])', 1).replace(chr(92) + '2', '(?P=d2)').replace('([-/.])', '(?P<d2>[-/.])', 1) if n == 'date' else p})" for n, p in PATTERNS.items()))
EACH = {n: re.compile(p) for n, p in PATTERNS.items()}


SECRET_HEAD = re.compile(r"[^=:]*[=:]\s*")


class Permutation:
    """A keyed permutation of 0 .. n-1: an alternating Feistel network on a x b >= n, walked until inside."""

    def __init__(self, key: bytes, label: str, n: int):
        self.n = n
        self.a = max(2, math.isqrt(n - 1) + 1)
        self.base = hashlib.blake2b(f"{label}/{n}".encode(), key=key[:64], digest_size=16)

    def _round(self, i: int, half: int) -> int:
        h = self.base.copy()
        h.update(f"{i}/{half}".encode())
        return int.from_bytes(h.digest(), "big")

    def _once(self, x: int, rounds: range, sign: int) -> int:
        left, right = divmod(x, self.a)
        for i in rounds:
            if i % 2:
                left = (left + sign * self._round(i, right)) % self.a
            else:
                right = (right + sign * self._round(i, left)) % self.a
        return left * self.a + right

    def apply(self, x: int, back: bool = False) -> int:
        rounds = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
        while True:
            x = self._once(x, rounds, -1 if back else 1)
            if x < self.n:
                return x


@lru_cache(maxsize=4096)
def permutation(key: bytes, label: str, n: int) -> Permutation:
    return Permutation(key, label, n)


def luhn_digit(digits: str) -> str:
    """Check digit of a card number without it."""
    total = sum(sum(divmod(int(d) * (2 if i % 2 == 0 else 1), 10)) for i, d in enumerate(reversed(digits)))
    return str(-total % 10)


def iban_digits(value: str) -> str:
    """Check digits of an IBAN, from its country and account."""
    held = value.replace(" ", "")
    return f"{98 - int(''.join(str(int(c, 36)) for c in held[4:] + held[:2] + '00')) % 97:02d}"


def country_code(value: str) -> str:
    """Country calling code of a phone number written with a plus; empty if it has none or an unassigned one."""
    found = COUNTRY_CODE.match(re.sub(r"\D", "", value)) if value[0] == "+" else None
    return found[0] if found else ""


def valid(kind: str, value: str) -> bool:
    """Whether a value that looks like its kind is one. Dates and addresses are seen to by ``pseudonym``."""
    held = re.sub(r"\D", "", value)
    if kind == "card":
        return luhn_digit(held[:-1]) == held[-1] and any(lo <= held[: len(lo)] <= hi and len(held) in lengths for lo, hi, lengths in ISSUERS)
    if kind == "iban":
        return 15 <= len(value.replace(" ", "")) <= 34 and iban_digits(value) == value[2:4]
    if kind == "secret":
        core = value[len(SECRET_HEAD.match(value)[0]) :]
        return core[0] in "\"'" or re.search(r"\d|[a-z][A-Z]", core) is not None
    if kind == "ssn":
        return held[:3] not in ("000", "666") and held[0] != "9" and held[3:5] != "00" and held[5:] != "0000"
    if kind == "phone":
        code = country_code(value)
        return (code != "" or value[0] != "+") and len(held) <= 15 and held[len(code) :].strip("0") != ""
    return True


def _refill(shape: str, characters: str, pick) -> str:
    it = iter(characters)
    return "".join(next(it) if pick(c) else c for c in shape)


def digits(value: str, key: bytes, label: str, back: bool = False, fixed: int = 0) -> str:
    """Permute the digits of a value after the first ``fixed`` ones; everything else stays."""
    held = re.sub(r"\D", "", value)
    body = held[fixed:]
    if not body:
        return value
    got = permutation(key, f"{label}/{held[:fixed]}", 10 ** len(body)).apply(int(body), back)
    return _refill(value, held[:fixed] + str(got).zfill(len(body)), str.isdigit)


def letters(value: str, key: bytes, label: str, back: bool = False) -> str:
    """Permute letters among letters of their case and digits among digits, as one mixed-radix number per piece."""
    if len(value) > PIECE:
        return "".join(letters(value[i : i + PIECE], key, f"{label}/{i}/{len(value)}", back) for i in range(0, len(value), PIECE))
    kinds = [(26, "A") if "A" <= c <= "Z" else (26, "a") if "a" <= c <= "z" else (10, "0") if "0" <= c <= "9" else None for c in value]
    size, number = 1, 0
    for c, kind in zip(value, kinds, strict=True):
        if kind:
            size, number = size * kind[0], number * kind[0] + ord(c) - ord(kind[1])
    if size == 1:
        return value
    shape = "".join(k[1] if k else c for c, k in zip(value, kinds, strict=True))
    number = permutation(key, f"{label}/{hashlib.sha1(shape.encode()).hexdigest()}", size).apply(number, back)
    out = []
    for c, kind in zip(reversed(value), reversed(kinds), strict=True):
        if kind:
            number, r = divmod(number, kind[0])
            c = chr(ord(kind[1]) + r)
        out.append(c)
    return "".join(reversed(out))


def hexadecimal(value: str, key: bytes, label: str, back: bool = False) -> str:
    """Permute a hexadecimal value among those of its length and case."""
    if len(value) > PIECE:
        # A piece without letters has the case of the whole.
        done = [hexadecimal(value[i : i + PIECE].lower(), key, f"{label}/{i}/{len(value)}", back) for i in range(0, len(value), PIECE)]
        return "".join(done).upper() if value.lower() != value else "".join(done)
    got = permutation(key, f"{label}/{len(value)}", 16 ** len(value)).apply(int(value, 16), back)
    text = format(got, "x").zfill(len(value))
    return text.upper() if value.upper() == value and value.lower() != value else text


def date(value: str, key: bytes, back: bool = False) -> str | None:
    """A date of the same format, or None if the value is no date."""
    parts = re.split(r"[-/.]", value)
    mark = value[len(parts[0])]
    year_first = len(parts[0]) == 4
    orders = [(0, 1, 2)] if year_first else [(2, 1, 0), (2, 0, 1)]
    for y, m, d in orders:
        try:
            day = datetime.date(int(parts[y]), int(parts[m]), int(parts[d])).toordinal() - DAY_ZERO
        except ValueError:
            continue
        if not 0 <= day < DAYS:
            continue
        # Days that read as the same order keep it, so the replacement can be undone.
        days = permutation(key, f"date/{y}{m}{d}", DAYS)
        while True:
            day = days.apply(day, back)
            got = datetime.date.fromordinal(day + DAY_ZERO)
            if year_first or (y, m, d) == orders[0] or got.day > 12:
                break
        new = {y: f"{got.year:04d}", m: f"{got.month:02d}", d: f"{got.day:02d}"}
        return mark.join(new[i] for i in range(3))
    return None


def pseudonym(kind: str, value: str, key: bytes = KEY, back: bool = False) -> str | None:
    """Replacement of a value of this format, valid if the value is; None for a date or an address that is none."""
    new = _permuted(kind, value, key, back)
    if new is not None and valid(kind, value):
        while not valid(kind, new):
            new = _permuted(kind, new, key, back)
    return new


def _permuted(kind: str, value: str, key: bytes, back: bool) -> str | None:
    if kind == "card":
        held = re.sub(r"\D", "", value)
        if luhn_digit(held[:-1]) == held[-1]:
            body = digits(held[:-1], key, "card", back)
            return _refill(value, body + luhn_digit(body), str.isdigit)
        return digits(value, key, "number", back)
    if kind == "date":
        return date(value, key, back)
    if kind == "ip":
        parts = [int(p) for p in value.split(".")]
        if max(parts) > 255:
            return None
        got = permutation(key, "ip", 256**4).apply(int.from_bytes(bytes(parts), "big"), back)
        return ".".join(str(b) for b in got.to_bytes(4, "big"))
    if kind in ("phone", "ssn"):
        # The country code stays.
        return digits(value, key, kind, back, fixed=len(country_code(value)))
    if kind == "iban":
        # The country stays.
        new = value[:4] + letters(value[4:], key, f"iban/{value[:2]}", back)
        return new[:2] + iban_digits(new) + new[4:]
    if kind == "secret":
        head = SECRET_HEAD.match(value)[0]
        body = value[len(head) :]
        quote = body[0] if body[0] in "\"'" else ""
        core = body[1:-1] if quote else body
        new = hexadecimal(core, key, "secret", back) if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", core) else letters(core, key, "secret", back)
        return f"{head}{quote}{new}{quote}"
    if kind == "email":
        name, _, host = value.partition("@")
        return f"{letters(name, key, 'email', back)}@{host}"
    return letters(value, key, kind, back)


def _readings(text: str, found: re.Match) -> Iterator[tuple[str, str]]:
    """(kind, value) that may begin where the finder stopped: the longest first, then without its last groups."""
    first = next(k for k in PATTERNS if found[k] is not None)
    for kind in list(PATTERNS)[list(PATTERNS).index(first) :]:
        m = found if kind == first else EACH[kind].match(text, found.start())
        value = m[0] if m else ""
        while value:
            yield kind, value
            cut = max(value.rfind(" "), value.rfind("-")) if kind in ("card", "iban") else -1
            value = value[:cut] if cut > 0 and EACH[kind].fullmatch(value[:cut]) else ""


def redact(text: str | None, key: bytes = KEY) -> tuple[str | None, list[tuple]]:
    """Text with pseudonyms, and (kind, start, end) of what was replaced in the original."""
    if not text or not HINT.search(text):
        return text, []
    out, spans, at = [], [], 0
    m = FINDER.search(text)
    while m:
        resume = m.start() + 1
        for kind, value in _readings(text, m):
            new = pseudonym(kind, value, key) if valid(kind, value) else None
            if new is not None:
                resume = m.start() + len(value)
                out += [text[at : m.start()], new]
                spans.append((kind, m.start(), resume))
                at = resume
                break
        m = FINDER.search(text, resume)
    return "".join(out) + text[at:], spans


def key_of(spark: SparkSession) -> bytes:
    """The key that the session names."""
    key = spark.conf.get(KEY_SETTING, "")
    if not key:
        logging.getLogger(__name__).warning("%s is not set: pseudonyms can be undone by anybody", KEY_SETTING)
    return key.encode() or KEY


def pseudonymise(docs: DataFrame, key: bytes = KEY, text: str = "text") -> DataFrame:
    """Replace the text and add ``pii``: kind and span, in the original text, of every value replaced."""
    span = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))
    kept = [f for f in docs.schema.fields if f.name != "pii"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                done = [redact(t, key) for t in part.column(text).to_pylist()]
                spans = [[{"kind": k, "start": a, "stop": b} for k, a, b in s] for _, s in done]
                columns = [pa.array([t for t, _ in done], pa.string()) if n == text else part.column(n) for n in part.schema.names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, kind)], [*part.schema.names, "pii"])

    return docs.select([f.name for f in kept]).mapInArrow(rows, T.StructType([*kept, T.StructField("pii", span)]))
