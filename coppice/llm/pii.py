"""Format-preserving pseudonyms for personal data (operator 2).

Numbers and dates that validate, mail addresses and secrets are found in each text and replaced by
another value of the same format: the value is read as an integer below the number of values that
its format has, sent through a keyed Feistel permutation of just that range (cycle-walking until
the result is in it and valid), and written out again with the same separators and letter cases.
A value gets the same pseudonym wherever it occurs, so that equal values stay linked across
documents, and different values of one format never share one. Without the key it cannot be undone.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Callable, Iterator
from datetime import date
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_class, flat, slices, small_batches, text_of

ROUNDS = 8
_FIRST_DAY, _LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()


def permute(value: int, size: int, key: bytes, tweak: str) -> int:
    """Keyed permutation of ``range(size)``: a Feistel network on the next larger product of two
    near-equal ranges, walked until it is back in range."""
    if size < 2:
        return value
    left = 1 << ((size - 1).bit_length() + 1) // 2
    right = -(-size // left)
    while True:
        a, b = value % left, value // left
        for k in range(ROUNDS):
            message = f"{tweak}:{size}:{k}:{b if k % 2 == 0 else a}".encode()
            word = int.from_bytes(hmac.digest(key, message, "sha256") + hmac.digest(key, message + b"+", "sha256"), "big")
            if k % 2 == 0:
                a = (a + word) % left
            else:
                b = (b + word) % right
        value = b * left + a
        if value < size:
            return value


def luhn_digit(body: str) -> str:
    """The check digit that completes ``body``."""
    total = 0
    for k, d in enumerate(reversed(body)):
        v = int(d) * (2 - k % 2)
        total += v - 9 * (v > 9)
    return str(-total % 10)


def iban_digits(country: str, body: str) -> str:
    number = int("".join(str(int(c, 36)) for c in body + country + "00"))
    return f"{98 - number % 97:02d}"


def _digits(text: str) -> str:
    return re.sub(r"\D", "", text)


def _refill(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced in order."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in shape)


def _number(digits: str, key: bytes, tweak: str) -> str:
    return f"{permute(int(digits), 10 ** len(digits), key, f'{tweak}{len(digits)}'):0{len(digits)}d}"


# Alphabets within which characters are exchanged.
_ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ")
_HEX = ("0123456789abcdef", "0123456789ABCDEF")


def permute_string(text: str, key: bytes, tweak: str, alphabets=_ALPHABETS) -> str:
    """Exchanges the characters of ``text`` within their alphabets, as one value; others stay."""
    sets = [next((a for a in alphabets if c in a), None) for c in text]
    value, size = 0, 1
    for c, a in zip(text, sets, strict=True):
        if a:
            value, size = value * len(a) + a.index(c), size * len(a)
    value = permute(value, size, key, tweak + ":" + ",".join(str(alphabets.index(a)) if a else c for c, a in zip(text, sets, strict=True)))
    out = []
    for c, a in zip(reversed(text), reversed(sets), strict=True):
        if a:
            value, at = divmod(value, len(a))
            out.append(a[at])
        else:
            out.append(c)
    return "".join(reversed(out))


# Each kind: a function of (text found, key) that gives the pseudonym, or None if it does not validate.
def mail(found: str, key: bytes) -> str | None:
    """The name and the first parts of the domain change, its last two stay where there are more."""
    name, domain = found.rsplit("@", 1)
    parts = domain.split(".")
    kept = parts[-2:] if len(parts) > 2 else parts[-1:]
    changed = ".".join(parts[: len(parts) - len(kept)])
    new = permute_string(f"{name}@{changed}", key, "mail")
    return ".".join([new, *kept])


def card(found: str, key: bytes) -> str | None:
    """13 to 19 digits whose last is the check digit; the issuer's first digit stays."""
    digits = _digits(found)
    if not 13 <= len(digits) <= 19 or len(set(digits)) < 2 or luhn_digit(digits[:-1]) != digits[-1]:
        return None
    body = digits[0] + _number(digits[1:-1], key, "card" + digits[0])
    return _refill(found, body + luhn_digit(body))


def iban(found: str, key: bytes) -> str | None:
    plain = found.replace(" ", "").upper()
    country, check, body = plain[:2], plain[2:4], plain[4:]
    if not 11 <= len(body) <= 30 or iban_digits(country, body) != check:
        return None
    body = permute_string(body, key, "iban" + country)
    it = iter(country + iban_digits(country, body) + body)
    return "".join(c if c == " " else next(it) for c in found)


def _country_code(found: str) -> int:
    """Where the country code of a number with + ends: with a first group of up to three digits, else
    by the plan of country codes."""
    written = re.match(r"\+(\d{1,3})\D", found)
    if written:
        return written.end(1)
    return 2 if found[1] in "17" else 3 if found[1:3] in _TWO_DIGITS else 4


def phone(found: str, key: bytes) -> str | None:
    """The country code stays, the national digits behind it change, but for a zero in brackets; area
    and exchange codes of ten digits go on from 2 to 9 where they did, other numbers from 0."""
    cut = _country_code(found) if found[0] == "+" else 0
    if zero := re.match(r"[ .-]?\(0\)", found[cut:]):
        cut += zero.end()
    head, body = _digits(found[:cut]), _digits(found[cut:])
    if found[0] == "+" and re.fullmatch(r"\+\d\.\d+", found) or len(set(head + body)) < 2:
        return None  # a decimal fraction
    if not (10 if len(head) < 2 else 7) <= len(body) <= (12 if head else 10):
        return None
    regular = lambda d: d[0] in "23456789" and d[3] in "23456789" if len(d) == 10 else d[0] != "0"
    was = regular(body)
    new = body
    while True:
        new = _number(new, key, f"phone{head}:{was}:")
        if regular(new) == was:
            return found[:cut] + _refill(found[cut:], new)


def address(found: str, key: bytes) -> str | None:
    """Four numbers from 0 to 255."""
    parts = found.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    value = permute(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, key, "ip")
    return ".".join(map(str, value.to_bytes(4, "big")))


def social(found: str, key: bytes) -> str | None:
    """Area 1 to 899 but 666, group and serial not zero."""
    valid = lambda d: d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"
    digits = _digits(found)
    if not valid(digits):
        return None
    while True:
        digits = _number(digits, key, "social")
        if valid(digits):
            return _refill(found, digits)


def day(found: str, key: bytes) -> str | None:
    """A calendar day of 1900 to 2099, year first or last; with the year last the day is read first
    unless only month first makes a day."""
    a, b, c = (int(p) for p in re.split(r"\D", found))
    order = "ymd" if a > 99 else "dmy" if b <= 12 else "mdy"
    y, m, d = {"ymd": (a, b, c), "dmy": (c, b, a), "mdy": (c, a, b)}[order]
    try:
        number = date(y, m, d).toordinal()
    except ValueError:
        return None
    if not _FIRST_DAY <= number <= _LAST_DAY:
        return None
    # With month first, days that would read as day first are no values of this format.
    while True:
        number = _FIRST_DAY + permute(number - _FIRST_DAY, _LAST_DAY - _FIRST_DAY + 1, key, "day" + order)
        new = date.fromordinal(number)
        if order != "mdy" or new.day > 12:
            break
    fields = {"y": f"{new.year:04d}", "m": f"{new.month:02d}", "d": f"{new.day:02d}"}
    return "".join(fields[o] + s for o, s in zip(order, [*re.findall(r"\D", found), ""], strict=True))


def secret(found: str, key: bytes) -> str | None:
    kind = _HEX if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", found) else _ALPHABETS
    alphabets = [a for a in kind if kind is not _HEX or all(c in a for c in found)][:1] if kind is _HEX else kind
    return permute_string(found, key, "secret", tuple(alphabets))


_KINDS: list[tuple[str, Callable, re.Pattern, int]] = [
    ("mail", mail, re.compile(r"(?<![\w.+%-])[^\W_](?:[\w.+%-]*[\w+%-])?@[^\W_](?:[\w-]*[^\W_])?(?:\.[^\W_](?:[\w-]*[^\W_])?)+"), 0),
    (
        "secret",
        secret,
        re.compile(
            r"(?i)(?<![^\W_])(?:password|passwd|pwd|token|secret|api[_-]?key|access[_-]?key|auth)\b[\"']?\s{0,3}[=:]\s{0,3}[\"']?"
            r"([A-Za-z0-9_+/~-]{8,}={0,2})"
        ),
        1,
    ),
    ("iban", iban, re.compile(r"(?<!\w)[A-Za-z]{2}\d{2}(?: ?[A-Za-z0-9]{4}){2,7}(?: ?[A-Za-z0-9]{1,3})?(?!\w)"), 0),
    ("ip", address, re.compile(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\w)"), 0),
    ("date", day, re.compile(r"(?<![\w.-])(?:\d{4}([-/.])\d{1,2}\1\d{1,2}|\d{1,2}([-/.])\d{1,2}\2\d{4})(?![\w-])"), 0),
    ("social", social, re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"), 0),
    ("card", card, re.compile(r"(?<![\w])\d(?:[ -]?\d){12,18}(?!\w)"), 0),
    (
        "phone",
        phone,
        re.compile(
            r"(?<![\w+])\+[1-9](?:(?:[ .-]|[ .-]?\(|\)[ .-]?)?\d){7,15}(?!\w)|"
            r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\w)"
        ),
        0,
    ),
]
# Characters of an IBAN by country. The IBAN registry.
IBAN_LENGTHS = {
    c: n
    for n, names in {
        15: "NO", 16: "BE BI", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH CR HR LI LV",
        22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
        26: "IS TR", 27: "DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA",
        30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for c in names.split()
}
# Country codes of two digits, and most national digits where numbers of a country have one length.
# The plan of country codes (E.164).
_TWO_DIGITS = frozenset(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 "
    "93 94 95 98".split()
)
PHONE_DIGITS = {"1": 10, "7": 10, "30": 10, "31": 9, "32": 9, "33": 9, "34": 9, "41": 9, "44": 10, "45": 8, "47": 8, "48": 9, "351": 9}
# A text without any of these bytes and words holds nothing that the patterns could find.
_MAYBE = byte_class(b"0123456789@")
_WORD = re.compile(r"(?i)password|passwd|pwd|token|secret|key|auth")


def _iban_ends(found: str) -> list[int]:
    """Ends at the country's length, of the whole, and for other countries before every space."""
    length = IBAN_LENGTHS.get(found[:2].upper())
    places = [k + 1 for k, c in enumerate(found) if c != " "]
    borders = [k for k in reversed(places) if k == len(found) or found[k] == " "]
    own = [k for k in places[length - 1 : length] if k in borders] if length else borders
    return [*own, *([len(found)] if len(found) not in own else [])]


def _card_ends(found: str) -> list[int]:
    """Ends of 19 to 13 digits, not inside a group of digits."""
    places = [k + 1 for k, c in enumerate(found) if c.isdigit()]
    return [k for k in reversed(places[12:19]) if k == len(found) or not found[k].isdigit()]


def _phone_ends(found: str) -> list[int]:
    """Of a number with +, ends at most as long as the country's numbers, longest first, then longer
    ones; not inside a group of digits."""
    if found[0] != "+":
        return [len(found)]
    cut = _country_code(found)
    if zero := re.match(r"[ .-]?\(0\)", found[cut:]):
        cut += zero.end()
    places = [cut + k + 1 for k, c in enumerate(found[cut:]) if c.isdigit()]
    most = PHONE_DIGITS.get(found[1 : _country_code(found)], 12)
    ends = [k for k in places[6:12] if k == len(found) or not found[k].isdigit()]
    fit = [k for k in ends if places.index(k) < most]
    return [*reversed(fit), *(k for k in ends if k not in fit)]


# Kinds whose pattern may run on into what stands behind a value, and the ends to try in order.
_ENDS: dict[str, Callable[[str], list[int]]] = {"iban": _iban_ends, "card": _card_ends, "phone": _phone_ends}


def find(text: str, key: bytes, known: Callable | None = None) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, pseudonym) of what validates, in order, not overlapping; a kind that comes
    first in the list of kinds has the first choice."""
    out: list[tuple[str, int, int, str]] = []
    # Characters that belong to a value found before.
    taken = bytearray(len(text))
    for kind, make, pattern, group in _KINDS:
        pos = 0
        while hit := pattern.search(text, pos):
            start, pos = hit.start(group), hit.end()
            value = hit.group(group)
            for length in _ENDS[kind](value) if kind in _ENDS else [len(value)]:
                end = start + length
                if taken.find(1, start, end) >= 0:
                    continue
                new = known(kind, value[:length]) if known else make(value[:length], key)
                if new is not None:
                    out.append((kind, start, end, new))
                    taken[start:end] = b"\1" * (end - start)
                    pos = end if kind in _ENDS else pos
                    break
    return sorted(out, key=lambda x: x[1])


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``text_col`` rewritten, and ``pii``: kind, start and end in the
    old text (in characters), and pseudonym of each place, in order. ``key`` decides the pseudonyms.

    A NULL text stays NULL, an empty one empty; both have no places. A column ``pii`` of ``docs`` is
    replaced; rows are kept as they are otherwise. Texts are read and kept whole."""
    secret_key = hashlib.sha256(key.encode()).digest()
    inner = small_batches(docs).drop("pii").withColumn(text_col, F.col(text_col).cast("string"))
    names, at = inner.columns, inner.columns.index(text_col)
    place = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("pseudonym", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        makers = {kind: make for kind, make, _, _ in _KINDS}
        known = lru_cache(1 << 16)(lambda kind, value: makers[kind](value, secret_key))
        for batch in batches:
            for part in slices(batch, text_col):
                texts = text_of(part.column(at))
                buf, first = flat(texts)
                hits = np.concatenate([[0], np.cumsum(_MAYBE[buf])])
                maybe = hits[first[1:]] > hits[first[:-1]]
                new, places = [], []
                for k, text in enumerate(part.column(at).to_pylist()):
                    found = find(text, secret_key, known) if text and (maybe[k] or _WORD.search(text)) else []
                    if found:
                        pieces, done = [], 0
                        for _, start, end, pseudonym in found:
                            pieces += [text[done:start], pseudonym]
                            done = end
                        text = "".join([*pieces, text[done:]])
                    new.append(text)
                    places.append([dict(zip(("kind", "start", "end", "pseudonym"), f, strict=True)) for f in found])
                cols = [part.column(k) if k != at else pa.array(new, pa.string()) for k in range(len(names))]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(places, pa.list_(place))], [*names, "pii"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in inner.schema.fields)
    return inner.mapInArrow(run, f"{fields}, pii array<struct<kind:string,start:int,end:int,pseudonym:string>>")
