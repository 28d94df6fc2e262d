"""Format-preserving pseudonyms by keyed Feistel permutations.

A value that passes its check (Luhn, mod 97, calendar, ranges of the numbering plan)
becomes a number within the set of all values of its format. A Feistel network,
keyed and walked until it stays in that set, permutes the set; the result is written
in the same format with its check digits made anew. Equal values become equal
pseudonyms in all documents, different values of a format stay different, and no
table of values is needed: each text is handled by itself.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import string
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tickloom.llm import fields

ROUNDS = 10
#: Characters that are permuted together; longer values are permuted block by block.
BLOCK = 64
_CLASSES = (string.digits, string.ascii_lowercase, string.ascii_uppercase)
_FIRST_DAY = dt.date(1900, 1, 1).toordinal()
_DAYS = dt.date(2100, 1, 1).toordinal() - _FIRST_DAY


class Permutation:
    """Keyed permutations of 0 .. size - 1, one for each label."""

    def __init__(self, key: bytes):
        if not key:
            raise ValueError("a key is needed")
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def __call__(self, value: int, size: int, label: str) -> int:
        if size < 2:
            return value
        half = max(1, ((size - 1).bit_length() + 1) // 2)
        mask = (1 << half) - 1
        while True:
            left, right = value >> half, value & mask
            for n in range(ROUNDS):
                message = f"{label}|{size}|{n}|{right:x}".encode()
                mixed = hashlib.blake2b(message, key=self.key, digest_size=32).digest()
                wide = int.from_bytes(mixed, "big")
                while half > 256 and wide.bit_length() < half:
                    mixed = hashlib.blake2b(mixed, key=self.key, digest_size=32).digest()
                    wide = wide << 256 | int.from_bytes(mixed, "big")
                left, right = right, left ^ (wide & mask)
            value = left << half | right
            if value < size:
                return value

    def digits(self, values: list[int], sizes: list[int], label: str) -> list[int]:
        """The same for a number with a base of its own at every place."""
        number = reduce(lambda n, p: n * p[1] + p[0], zip(values, sizes, strict=True), 0)
        number = self(number, reduce(lambda a, b: a * b, sizes, 1), label)
        out = []
        for size in reversed(sizes):
            number, digit = divmod(number, size)
            out.append(digit)
        return out[::-1]

    def characters(self, text: str, label: str) -> str:
        """Letters and digits, each within its class; other characters stay.

        A long text is cut into blocks. What became of the blocks before enters the label
        of the next one, so the whole is a permutation and its cost follows the length.
        """
        if len(text) > BLOCK:
            out, before = [], hashlib.blake2b(digest_size=16)
            for at in range(0, len(text), BLOCK):
                out.append(self.characters(text[at : at + BLOCK], f"{label}|{at}|{before.hexdigest()}|"))
                before.update(out[-1].encode())
            return "".join(out)
        classes = [next((c for c in _CLASSES if ch in c), "") for ch in text]
        at = [i for i, c in enumerate(classes) if c]
        form = "".join(c[:1] for c in classes)
        new = self.digits([classes[i].index(text[i]) for i in at], [len(classes[i]) for i in at], label + form)
        out = list(text)
        for i, d in zip(at, new, strict=True):
            out[i] = classes[i][d]
        return "".join(out)


def luhn(digits: str) -> int:
    """Sum of the Luhn check, 0 modulo 10 for a valid number."""
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10


def _refill(form: str, digits: str) -> str:
    """The digits in the places of the digits of ``form``."""
    left = iter(digits)
    return "".join(next(left) if c in string.digits else c for c in form)


def _only_digits(text: str) -> str:
    return "".join(c for c in text if c in string.digits)


def card(value: str, p: Permutation) -> str | None:
    digits = _only_digits(value)
    if not 13 <= len(digits) <= 19 or luhn(digits) or len(set(digits)) == 1:
        return None
    new = digits[0] + p.characters(digits[1:-1], "card")
    check = (10 - luhn(new + "0")) % 10
    return _refill(value, f"{new}{check}")


def _iban_check(country: str, account: str) -> int:
    text = account + country + "00"
    return 98 - int("".join(str(int(c, 36)) for c in text)) % 97


def iban(value: str, p: Permutation) -> str | None:
    plain = value.replace(" ", "")
    country, check, account = plain[:2], plain[2:4], plain[4:]
    if not 15 <= len(plain) <= 34 or _iban_check(country, account) != int(check):
        return None
    account = p.characters(account, "iban")
    new = iter(f"{country}{_iban_check(country, account):02d}{account}")
    return "".join(c if c == " " else next(new) for c in value)


def ip(value: str, p: Permutation) -> str | None:
    octets = value.split(".")
    if any(int(o) > 255 or (len(o) > 1 and o[0] == "0") for o in octets):
        return None
    return ".".join(map(str, p.digits([int(o) for o in octets], [256] * 4, "ip")))


def phone(value: str, p: Permutation) -> str | None:
    """North American numbers, then others after the first two digits of the country.

    Numbers within the ranges of their plan stay within them. Others are taken if a
    country code or parentheses mark them as numbers, and stay outside the ranges.
    """
    digits = _only_digits(value)
    if value[0] == "+" and digits[0] != "1":
        if not 8 <= len(digits) <= 15:
            return None
        return _refill(value, digits[:2] + p.characters(digits[2:], "phone"))
    code, own = digits[:-10], digits[-10:]
    if len(own) < 10 or code not in ("", "1"):
        return None
    outside = lambda d: d[0] in "01" or d[3] in "01"
    if outside(own):
        if value[0] not in "+(":
            return None
        own = p.characters(own, "outside")
        while not outside(own):
            own = p.characters(own, "outside")
        return _refill(value, code + own)
    sizes = [8, 10, 10, 8, 10, 10, 10, 10, 10, 10]
    low = [2, 0, 0, 2, 0, 0, 0, 0, 0, 0]
    new = p.digits([int(d) - a for d, a in zip(own, low, strict=True)], sizes, "nanp")
    return _refill(value, code + "".join(str(d + a) for d, a in zip(new, low, strict=True)))


def social(value: str, p: Permutation) -> str | None:
    area, group, serial = (int(x) for x in re.split("[- ]", value))
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    place = area - 1 - (area > 666)
    place, group, serial = p.digits([place, group - 1, serial - 1], [898, 99, 9999], "social")
    return f"{place + 1 + (place >= 665):03d}{value[3]}{group + 1:02d}{value[6]}{serial + 1:04d}"


def _day(parts: list[str], order: str) -> int | None:
    by = dict(zip(order, map(int, parts), strict=True))
    try:
        day = dt.date(by["y"], by["m"], by["d"]).toordinal() - _FIRST_DAY
    except ValueError:
        return None
    return day if 0 <= day < _DAYS else None


def date(value: str, p: Permutation) -> str | None:
    """yyyy-mm-dd and yyyy/mm/dd, dd.mm.yyyy, mm/dd/yyyy, from 1900 to 2099. One permutation for all.

    dd/mm/yyyy is taken where mm/dd/yyyy is no date, that is with a day above 12, and the new
    day is above 12 as well, so that different values stay apart.
    """
    mark = next(c for c in value if not c.isdigit())
    parts = value.split(mark)
    order = "ymd" if len(parts[0]) == 4 else "mdy" if mark == "/" else "dmy"
    day = _day(parts, order)
    turned = day is None and order == "mdy"
    if turned:
        order = "dmy"
        day = _day(parts, order)
    if day is None:
        return None
    day = p(day, _DAYS, "date")
    while turned and dt.date.fromordinal(_FIRST_DAY + day).day <= 12:
        day = p(day, _DAYS, "date")
    new = dt.date.fromordinal(_FIRST_DAY + day)
    return mark.join({"y": f"{new.year:04d}", "m": f"{new.month:02d}", "d": f"{new.day:02d}"}[c] for c in order)


def mail(value: str, p: Permutation) -> str | None:
    local, _, domain = value.rpartition("@")
    if not any(c.isalnum() for c in local):
        return None
    return p.characters(local, "mail") + "@" + domain


def access_key(value: str, p: Permutation) -> str | None:
    return value[:4] + p.characters(value[4:], "key")


def secret(value: str, p: Permutation) -> str | None:
    """What follows the name of a secret and its sign."""
    head = re.match(r"\w[\w-]*?\s*[=:]\s*[\"']?", value).group()
    return head + p.characters(value[len(head) :], "secret")


Kind = tuple[str, re.Pattern, Callable[[str, Permutation], str | None]]

#: In order of precedence; a candidate that fails its check is left to the kinds after it.
KINDS: tuple[Kind, ...] = (
    ("mail", re.compile(r"(?<![\w.+%-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}", re.A), mail),
    ("access_key", re.compile(r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])"), access_key),
    ("secret", re.compile(r"(?i)(?<![A-Za-z])(?:password|passwd|pwd|secret|api[_-]?key|token)\s*[=:]\s*[\"']?[^\s\"',;]{6,}"), secret),
    ("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{1,4}){3,8}(?![A-Za-z0-9])", re.A), iban),
    ("card", re.compile(r"(?<![\w.+-])\d(?:[ -]?\d){12,18}(?![\w-])", re.A), card),
    ("ip", re.compile(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)", re.A), ip),
    ("social", re.compile(r"(?<![\w-])\d{3}([- ])\d{2}\1\d{4}(?![\w-])", re.A), social),
    ("date", re.compile(r"(?<![\w.-])(?:\d{4}([-/])\d{2}\1\d{2}(?=T\d)|(?:\d{4}([-/])\d{2}\2\d{2}|\d{2}([./])\d{2}\3\d{4})(?![\w-]))", re.A), date),
    ("phone", re.compile(r"(?<![\w+])(?:\+\d(?:[ .()/-]{0,2}\d){7,14}|\(\d{3}\) ?\d{3}[-. ]\d{4}|\d{3}[-.]\d{3}[-.]\d{4})(?!\w)", re.A), phone),
)
_ANY = re.compile(r"[0-9@=:]", re.A)


def pseudonyms(text: str, p: Permutation, kinds: tuple[Kind, ...] = KINDS) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and (kind, start, end) of each, in the new text."""
    if not _ANY.search(text):
        return text, []
    found: list[tuple[int, int, str, str]] = []
    taken = bytearray(len(text))
    for kind, pattern, replace in kinds:
        for m in pattern.finditer(text):
            if 1 not in taken[m.start() : m.end()]:
                new = replace(m.group(), p)
                if new is not None:
                    found.append((m.start(), m.end(), kind, new))
                    taken[m.start() : m.end()] = b"\1" * (m.end() - m.start())
    out, spans, at, length = [], [], 0, 0
    for start, end, kind, new in sorted(found):
        out += [text[at:start], new]
        length += start - at
        spans.append((kind, length, length + len(new)))
        length += len(new)
        at = end
    return "".join([*out, text[at:]]), spans


def pseudonymise(
    docs: DataFrame, key: bytes, text_col: str = "text", spans_col: str | None = "pii"
) -> DataFrame:
    """``docs`` with pseudonyms in the text and, unless ``spans_col`` is None, their places.

    Places are structs (kind, start, end) in characters of the new text. A null text
    stays null with no places, an empty one empty; texts are read whole; equal rows
    give equal rows. An empty table gives no rows. Other columns are kept; one named
    ``spans_col`` is replaced.
    """
    names = [c for c in docs.columns if c not in (text_col, spans_col)]
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    arrow_span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    hidden, pairs = fields.hide(docs.select(*(f"`{c}`" for c in [*names, text_col])))
    schema = T.StructType([*hidden.schema.fields, T.StructField("_spans", T.ArrayType(span))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Permutation(key)
        for batch in fields.pieces(batches):
            texts, places = [], []
            for t in batch.column(batch.num_columns - 1):
                old = t.as_py()
                new, spans = (None, []) if old is None else pseudonyms(old, p)
                texts.append(new)
                places.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array(places, arrow_span)],
                names=[*batch.schema.names, "_spans"],
            )

    done = hidden.mapInArrow(run, schema)
    new_name = dict(pairs)
    columns = [f"`{new_name[c]}` AS `{c}`" for c in docs.columns if c != spans_col]
    return done.selectExpr(*columns, *([f"_spans AS `{spans_col}`"] if spans_col else []))
