"""Format-preserving pseudonyms for personal data.

Validated values (mail addresses, IBANs, dates, social security numbers, IPv4 addresses, payment cards, phone numbers) are
replaced by another valid value of the same format: a keyed permutation of the format's numbers gives it, so equal values
get equal pseudonyms in every document and different values stay different. The permutation is a Feistel network of keyed
hash rounds, walked until it falls within the format's numbers. It is used as P(P^-1(x) + 1), which is one cycle through
all numbers of the format, so no value is ever its own pseudonym and the key's holder can go back.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Callable, Iterator
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import slices

ROUNDS = 10
KINDS = ("email", "iban", "date", "ssn", "ip", "card", "phone")
#: Dates from FIRST on, so many days, are one format's numbers.
FIRST, DAYS = date(1900, 1, 1), (date(2100, 1, 1) - date(1900, 1, 1)).days


class Permutation:
    """A keyed permutation of the numbers below ``size``, for each ``tag`` another one."""

    def __init__(self, key: bytes, tag: str, size: int):
        self.key, self.size = hashlib.blake2b(key, digest_size=32, person=b"opinara").digest(), size
        self.half = max(1, ((size - 1).bit_length() + 1) // 2)
        self.mask = (1 << self.half) - 1
        self.tag = f"{tag}/{size}/".encode()

    def _round(self, i: int, x: int) -> int:
        out, n = 0, 0
        while n < self.half:  # wide halves take several digests
            data = self.tag + bytes([i, n // 512]) + x.to_bytes(self.half // 8 + 1, "big")
            out |= int.from_bytes(hashlib.blake2b(data, key=self.key).digest(), "big") << n
            n += 512
        return out & self.mask

    def _net(self, x: int, rounds: range) -> int:
        left, right = x >> self.half, x & self.mask
        for i in rounds if rounds.step > 0 else ():
            left, right = right, left ^ self._round(i, right)
        for i in rounds if rounds.step < 0 else ():
            left, right = right ^ self._round(i, left), left
        return left << self.half | right

    def _walk(self, x: int, rounds: range) -> int:
        while True:
            x = self._net(x, rounds)
            if x < self.size:
                return x

    def there(self, x: int) -> int:
        if self.size < 2:
            return x
        return self._walk((self._walk(x, range(ROUNDS - 1, -1, -1)) + 1) % self.size, range(ROUNDS))

    def back(self, x: int) -> int:
        if self.size < 2:
            return x
        return self._walk((self._walk(x, range(ROUNDS - 1, -1, -1)) - 1) % self.size, range(ROUNDS))


# ---- formats: each takes a match, a way (key, tag, size) -> number -> number, and gives the pseudonym or None --------

Way = Callable[[str, int], Callable[[int], int]]


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _refill(text: str, digits: str) -> str:
    """``text`` with its digits replaced in order."""
    put = iter(digits)
    return "".join(next(put) if "0" <= c <= "9" else c for c in text)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _characters(text: str, way: Way, tag: str) -> str | None:
    """Letters to letters and digits to digits, as one number in mixed base; case and other characters stay."""
    base = [26 if c.isalpha() else 10 for c in text if c.isascii() and c.isalnum()]
    size = n = 0
    if not base:
        return None
    size = 1
    for c, b in zip([c for c in text if c.isascii() and c.isalnum()], base, strict=True):
        size *= b
        n = n * b + (ord(c.lower()) - 97 if b == 26 else int(c))
    form = "".join("a" if b == 26 else "0" for b in base)
    n, put = way(f"{tag}:{form}", size)(n), []
    for b in reversed(base):
        n, x = divmod(n, b)
        put.append(chr(97 + x) if b == 26 else str(x))
    out = iter(reversed(put))
    return "".join((next(out).upper() if c.isupper() else next(out)) if c.isascii() and c.isalnum() else c for c in text)


def _email(text: str, way: Way) -> str | None:
    local, _, domain = text.rpartition("@")
    made = _characters(local, way, "email")
    return made and f"{made}@{domain}"


def _iban_check(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def _iban(text: str, way: Way) -> str | None:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34 or _iban_check(plain) != 1:
        return None
    body = _characters(plain[4:], way, f"iban-{plain[:2]}")
    made = f"{plain[:2]}{98 - _iban_check(plain[:2] + '00' + body):02d}{body}"
    put = iter(made)
    return "".join(c if c == " " else next(put) for c in text)


def _number(digits: str, way: Way, tag: str) -> str:
    return f"{way(tag, 10 ** len(digits))(int(digits)):0{len(digits)}d}"


def _card(text: str, way: Way) -> str | None:
    digits = _digits(text)
    if not luhn(digits) or not int(digits):
        return None
    body = _number(digits[:-1], way, f"card-{len(digits)}")
    return _refill(text, next(body + str(c) for c in range(10) if luhn(body + str(c))))


def _phone(text: str, way: Way) -> str | None:
    """Ten digits behind a country code. One digit repeated is no number; an area code that begins with 2 to 9 gets one
    that does, too."""
    digits = _digits(text)
    if not 10 <= len(digits) <= 13 or len(set(digits[-10:])) == 1:
        return None
    n, least = int(digits[-10:]), 2 * 10**9
    n = least + way("phone", 8 * 10**9)(n - least) if n >= least else way("phone-low", least)(n)
    return _refill(text, f"{digits[:-10]}{n:010d}")


def _ip(text: str, way: Way) -> str | None:
    parts = [int(p) for p in text.split(".")]
    if max(parts) > 255 or any(len(p) > 1 and p[0] == "0" for p in text.split(".")):
        return None
    n = way("ip", 1 << 32)(int.from_bytes(bytes(parts), "big"))
    return ".".join(map(str, n.to_bytes(4, "big")))


def _ssn(text: str, way: Way) -> str | None:
    valid = lambda d: d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"
    digits = _digits(text)
    if not valid(digits):
        return None
    while not valid(digits := _number(digits, way, "ssn")):
        pass
    return _refill(text, digits)


def _day(y: str, m: str, d: str) -> int | None:
    try:
        n = (date(int(y), int(m), int(d)) - FIRST).days
    except ValueError:
        return None
    return n if 0 <= n < DAYS else None


@functools.cache
def _class(late: bool) -> tuple[list[int], dict[int, int]]:
    """The dates with a day above 12, or the others, and their places."""
    days = [n for n in range(DAYS) if ((FIRST + timedelta(days=n)).day > 12) == late]
    return days, {n: i for i, n in enumerate(days)}


def _date(text: str, way: Way) -> str | None:
    """A date has one pseudonym in all layouts. Days above 12 stay above 12, as only they show that the month comes first."""
    a, sep, b, _, c = re.split(r"([-/.])", text)
    if len(a) == 4:
        n, shape = _day(a, b, c), "{t.year:04d}{s}{t.month:02d}{s}{t.day:02d}"
    elif (n := _day(c, b, a)) is not None:
        shape = "{t.day:02d}{s}{t.month:02d}{s}{t.year:04d}"
    else:
        n, shape = _day(c, a, b), "{t.month:02d}{s}{t.day:02d}{s}{t.year:04d}"
    if n is None:
        return None
    late = (FIRST + timedelta(days=n)).day > 12
    days, place = _class(late)
    return shape.format(t=FIRST + timedelta(days=days[way(f"date-{late}", len(days))(place[n])]), s=sep)


_FORMATS = {"email": _email, "iban": _iban, "date": _date, "ssn": _ssn, "ip": _ip, "card": _card, "phone": _phone}
#: How the kinds look. What is found is validated before it is replaced.
_LOOKS = re.compile(
    r"""
      (?P<email>(?<![\w.+%-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24}(?![\w]))
    | (?P<iban>(?<!\w)[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?:\ [A-Z0-9]{4}){2,7}(?:\ [A-Z0-9]{1,3})?)(?!\w))
    | (?P<date>(?<![\w./-])(?:\d{4}(?P<s1>[-/.])\d{2}(?P=s1)\d{2}|\d{2}(?P<s2>[-/.])\d{2}(?P=s2)\d{4})(?![\w/-]))
    | (?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))
    | (?P<ip>(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\.?\w))
    | (?P<card>(?<![\w-])(?:\d{13,19}|\d{4}([ -])\d{4}\8\d{4}\8\d{4}|\d{4}([ -])\d{6}\9\d{5})(?![\w-]))
    | (?P<phone>(?<![\w+])(?:\+?\d{1,3}[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])|(?<![\w+])\+\d{11,13}(?![\w-]))
    """.replace(r"([ -])\d{4}\8\d{4}\8", r"(?P<s3>[ -])\d{4}(?P=s3)\d{4}(?P=s3)").replace(r"([ -])\d{6}\9", r"(?P<s4>[ -])\d{6}(?P=s4)"),
    re.VERBOSE,
)
_MAYBE = re.compile(r"@|[0-9][^\w\s]?[0-9]|[0-9]\)")


def pseudonymiser(key: bytes, reverse: bool = False) -> Callable[[str], tuple[str, dict[str, int]]]:
    """A function from a text to the text with pseudonyms and the number replaced of each kind."""

    @functools.lru_cache(4096)
    def permutation(tag: str, size: int) -> Permutation:
        return Permutation(key, tag, size)

    def way(tag: str, size: int) -> Callable[[int], int]:
        p = permutation(tag, size)
        return p.back if reverse else p.there

    @functools.lru_cache(65_536)
    def of(kind: str, value: str) -> str | None:
        return _FORMATS[kind](value, way)

    def run(text: str) -> tuple[str, dict[str, int]]:
        counts: dict[str, int] = {}
        if not _MAYBE.search(text):
            return text, counts

        def put(m: re.Match) -> str:
            kind = next(k for k in KINDS if m[k] is not None)
            made = of(kind, m[0])
            if made is None:
                return m[0]
            counts[kind] = counts.get(kind, 0) + 1
            return made

        return _LOOKS.sub(put, text), counts

    return run


#: Keys drawn for applications that name none; they are written nowhere.
_DRAWN: dict[str, bytes] = {}


def session_key(spark: SparkSession) -> bytes:
    """The key that the session names in spark.opinara.pii.key; an error if it names none."""
    named = spark.conf.get("spark.opinara.pii.key", None)
    if not named:
        raise ValueError("spark.opinara.pii.key must name the key of pseudonyms")
    return named.encode()


def passing_key(spark: SparkSession) -> bytes:
    """The session's key or, if it names none, one drawn at random for this application and thrown away with it: equal values
    stay linked in what the application writes, and nobody can go back from pseudonyms to values."""
    if spark.conf.get("spark.opinara.pii.key", None):
        return session_key(spark)
    return _DRAWN.setdefault(spark.sparkContext.applicationId, os.urandom(32))


def pseudonymise(docs: DataFrame, *, key: bytes, text: str = "text", reverse: bool = False, counts: bool = True) -> DataFrame:
    """``docs`` with the column ``text`` rewritten and ``n_email ... n_phone`` (long) added; all other columns stay.

    ``key`` is the secret that the permutations hang on. Whole texts are searched, however long. A null text stays null and
    counts 0; texts without such values come back unchanged; equal rows give equal rows, so repeated rows stay equal; an
    empty table gives none. Columns that are named like an added one are replaced by it; without ``counts`` none is added and
    all stay. The domain of a mail address, the
    country of an IBAN and country codes of phones stay as they are. ``reverse`` undoes a run with the same key.
    """
    if not key:
        raise ValueError("a key is needed")
    names = [f"n_{k}" for k in KINDS] if counts else []
    rest = [c for c in docs.columns if c not in names]
    held = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)))  # whatever their names
    where = rest.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        change = pseudonymiser(key, reverse)
        for batch in slices(batches):
            texts, found = [], {k: [] for k in KINDS}
            for t in batch.column(where).to_pylist():
                made, n = (None, {}) if t is None else change(t)
                texts.append(made)
                for k in KINDS:
                    found[k].append(n.get(k, 0))
            columns = list(batch.columns)
            columns[where] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(found[k], pa.int64()) for k in KINDS if counts)], names=[*rest, *names])

    schema = StructType([*(StructField(c, f.dataType) for c, f in zip(rest, held.schema.fields, strict=True)), *(StructField(n, LongType()) for n in names)])
    return held.mapInArrow(run, schema)
