"""Format-preserving pseudonyms for personal numbers, dates and addresses.

A value is found by its pattern, checked by its own rule (check digits, number ranges, calendar),
and replaced by another value of the same format: a keyed Feistel network permutes the numbers
0 .. size - 1 of the format, walking the cycle until it lands inside. The permutation depends on
key and format only, so equal values get equal pseudonyms in every document, and two different
values never get the same one.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Callable, Iterator
from datetime import date, timedelta
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROUNDS = 10
ROWS_AT_ONCE = 1_000
DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def permute(key: bytes, tweak: str, value: int, size: int) -> int:
    """Keyed permutation of 0 .. size - 1: a balanced Feistel network with cycle walking."""
    if not 0 <= value < size:
        raise ValueError("value outside its format")
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        left, right = value >> half, value & mask
        for i in range(ROUNDS):
            message = f"{tweak}|{size}|{i}|{right}".encode()
            digest = hmac.digest(key, message, hashlib.sha256)
            left, right = right, left ^ (int.from_bytes(digest, "big") & mask)
        value = left << half | right
        if value < size:
            return value


def _luhn(digits: str) -> int:
    """Sum that is divisible by ten for valid card numbers."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total


def _refill(shape: str, chars: str) -> str:
    """``shape`` with its digits replaced by ``chars``, separators kept."""
    fresh = iter(chars)
    return "".join(next(fresh) if c.isdigit() else c for c in shape)


def _card(key: bytes, text: str) -> str | None:
    digits = re.sub(r"\D", "", text)
    if not 13 <= len(digits) <= 19 or _luhn(digits) % 10 or len(set(digits)) == 1:
        return None
    size = 10 ** (len(digits) - 2)  # the leading digit stays, the last one checks
    body = digits[0] + str(permute(key, f"card{digits[0]}", int(digits[1:-1]), size)).zfill(len(digits) - 2)
    return _refill(text, body + str(-_luhn(body + "0") % 10))


def _iban(key: bytes, text: str) -> str | None:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34 or int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 != 1:
        return None
    country, body = plain[:2], plain[4:]
    value, size = 0, 1
    for c in body:  # letters stay letters, digits stay digits
        base = 10 if c.isdigit() else 26
        value, size = value * base + (int(c) if c.isdigit() else ord(c) - 65), size * base
    shape = "".join("9" if c.isdigit() else "A" for c in body)
    value, out = permute(key, f"iban{country}{shape}", value, size), []
    for c in reversed(body):
        value, left = divmod(value, 10 if c.isdigit() else 26)
        out.append(str(left) if c.isdigit() else chr(65 + left))
    body = "".join(reversed(out))
    check = 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97
    fresh = iter(f"{country}{check:02d}{body}")
    return "".join(c if c == " " else next(fresh) for c in text)


def _ip(key: bytes, text: str) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or p != str(int(p)) for p in parts):
        return None
    value = permute(key, "ip", int.from_bytes(map(int, parts), "big"), 2**32)
    return ".".join(map(str, value.to_bytes(4, "big")))


#: Calling codes of one and of two digits; all others have three.
CALLING_CODE = r"\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"


def _phone(key: bytes, text: str) -> str | None:
    """All digits but a country code, or the zero before an area code, move."""
    head = re.match(rf"(?:\+\d{{1,3}}(?=[ .(-])|{CALLING_CODE})(?:[ .-]?\(0\))?", text) or re.match(r"\(?0(?=[1-9])", text)
    cut = head.end() if head else 0
    digits = re.sub(r"\D", "", text[cut:])
    least = 5 if text[0] == "+" else 8 if head else 7
    if not least <= len(digits) <= 14 or sum(map(str.isdigit, text)) > 15:
        return None
    value = permute(key, f"phone{len(digits)}", int(digits), 10 ** len(digits))
    return text[:cut] + _refill(text[cut:], str(value).zfill(len(digits)))


def _ssn(key: bytes, text: str) -> str | None:
    area, group, serial = text.split("-")
    if area in ("000", "666") or area >= "900" or group == "00" or serial == "0000":
        return None
    order = int(area) - 1 - (area > "666")
    value = (order * 99 + int(group) - 1) * 9999 + int(serial) - 1
    value, serial_now = divmod(permute(key, "ssn", value, 898 * 99 * 9999), 9999)
    order, group_now = divmod(value, 99)
    return f"{order + 1 + (order >= 665):03d}-{group_now + 1:02d}-{serial_now + 1:04d}"


FIRST_DAY = date(1900, 1, 1)
DAYS = (date(2100, 1, 1) - FIRST_DAY).days


def _date(key: bytes, text: str) -> str | None:
    """Year first with '-' or '/', or day first with '.', or month first with '/'."""
    a, sep, b, c = re.match(r"(\d+)([-/.])(\d+)[-/.](\d+)", text).groups()
    order = (a, b, c) if len(a) == 4 else (c, b, a) if sep == "." else (c, a, b)
    try:
        day = (date(*map(int, order)) - FIRST_DAY).days
    except ValueError:
        return None
    if not 0 <= day < DAYS:
        return None
    new = FIRST_DAY + timedelta(permute(key, "date", day, DAYS))
    year, month, dom = str(new.year), f"{new.month:02d}", f"{new.day:02d}"
    return sep.join((year, month, dom) if len(a) == 4 else (dom, month, year) if sep == "." else (month, dom, year))


def _over(alphabet: str, tweak: str) -> Callable[[bytes, str], str | None]:
    base = len(alphabet)

    def run(key: bytes, text: str) -> str:
        value = 0
        for c in text:
            value = value * base + alphabet.index(c)
        value, out = permute(key, f"{tweak}{len(text)}", value, base ** len(text)), []
        for _ in text:
            value, left = divmod(value, base)
            out.append(alphabet[left])
        return "".join(reversed(out))

    return run


def _access_key(key: bytes, text: str) -> str:
    return text[:4] + _upper(key, text[4:])


_upper = _over("ABCDEFGHIJKLMNOPQRSTUVWXYZ" + DIGITS, "upper")
_letters, _digits, _hex = _over(LOWER, "letters"), _over(DIGITS, "digits"), _over("0123456789abcdef", "hex")


def _email(key: bytes, text: str) -> str:
    """Runs of letters and of digits before the '@' move; the domain stays, dots and case too."""
    local, domain = text.rsplit("@", 1)
    runs = re.findall(r"[a-z]+|[0-9]+|[A-Z]+|[^a-zA-Z0-9]+", local)
    moved = []
    for run in runs:
        if run[0] in LOWER:
            moved.append(_letters(key, run))
        elif run[0].isdigit():
            moved.append(_digits(key, run))
        elif run.isalpha():
            moved.append(_letters(key, run.lower()).upper())
        else:
            moved.append(run)
    return f"{''.join(moved)}@{domain}"


def _secret(key: bytes, text: str) -> str:
    cut = re.match(r"\w+\s*[=:]\s*[\"']?", text).end()
    return text[:cut] + _hex(key, text[cut:])


#: Three, three and four digits, with or without a country code; then a country code with the rest
#: in one piece or in groups; a zero and area code before groups, nine digits at least; ten digits
#: in one piece as North America writes them. Behind a group of over four digits a number ends.
PHONE = (
    r"(?<![\w.])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![\w-])"
    r"|(?<![\w.+])\+[1-9][0-9]{7,14}(?![\w-])"
    r"|(?<![\w.+])\+[1-9][0-9]{0,2}(?:[ .-]?\(0\))?(?:[ .-]?\([0-9]{1,5}\)|[ .-]?[0-9]{1,5})(?![0-9])(?:[ ./-][0-9]{2,4}(?![0-9])){0,4}(?:[ ./-]|(?<=\)))[0-9]{2,8}(?![\w-])"
    r"|(?<![\w.+/-])(?:\(0[1-9][0-9]{0,3}\)|0[1-9][0-9]{0,3})(?:(?: ?[/-] ?| )[0-9]{2,4}(?![0-9])){0,4}(?: ?[/-] ?| |(?<=\)))[0-9]{2,8}(?![\w-])"
    r"|(?<![\w.+-])[2-9][0-9]{2}[2-9][0-9]{6}(?![\w-])"
)


def _card_ends(value: str) -> Iterator[int]:
    """Where a card may end in a run of 13 to 19 digits: an unbroken run of that length is one for
    itself, then 16 and 15 digits, then the longest."""
    runs = [m.span() for m in re.finditer("[0-9]+", value)]
    whole = [(a, b) for a, b in runs if 13 <= b - a <= 19]
    if whole and whole[0][0] > 0 and _luhn(value[whole[0][0] : whole[0][1]]) % 10 == 0:
        return  # it begins further on
    count, ends = 0, {}
    for a, b in runs:
        count += b - a
        if 13 <= count <= 19:
            ends[count] = b
    first = [runs[0][1]] if whole and whole[0][0] == 0 else []
    yield from dict.fromkeys([*first, *(ends[n] for n in (16, 15) if n in ends), *(ends[n] for n in sorted(ends, reverse=True))])


#: Length of an IBAN by country; others are tried from the longest on.
IBAN_LENGTHS = {
    code: length
    for length, codes in {
        15: "NO", 16: "BE", 18: "DK FI FO GL NL SD FK", 19: "MK SI", 20: "AT BA EE KZ LT LU XK MN",
        21: "CH CR HR LI LV", 22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM TL SO",
        24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
        28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for code in codes.split()
}


def _iban_ends(value: str) -> Iterator[int]:
    """Where an IBAN may end: behind the length of its country, then behind any group."""
    ends = {len(value[:b].replace(" ", "")): b for b in (m.end() for m in re.finditer("[A-Z0-9]+", value))}
    own = IBAN_LENGTHS.get(value[:2])
    yield from dict.fromkeys([*([ends[own]] if own in ends else []), *(ends[n] for n in sorted(ends, reverse=True))])


#: Kinds whose pattern may take what follows, and where their values may end instead.
ENDS: dict[str, Callable[[str], Iterator[int]]] = {"card": _card_ends, "iban": _iban_ends}

#: Patterns by kind, the earlier one wins where two start at the same place.
PATTERNS: dict[str, tuple[str, Callable[[bytes, str], str | None]]] = {
    "email": (r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", _email),
    "secret": (r"\b(?:password|passwd|token|secret|api_key)\s*[=:]\s*[\"']?[0-9a-f]{16,}\b", _secret),
    "access_key": (r"\bAKIA[A-Z0-9]{16}\b", _access_key),
    "iban": (r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b", _iban),
    "date": (r"(?<![\w.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}(?=[Tt][0-9]{2})|(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![\w-]))", _date),
    "ssn": (r"(?<![\w.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])", _ssn),
    "ip": (r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\w|\.[0-9])", _ip),
    "card": (r"(?<![\w-])[0-9](?:[ -]?[0-9]){12,18}(?![\w-])", _card),
    "phone": (PHONE, _phone),
}


class Pseudonyms:
    def __init__(self, key: bytes, kinds: tuple[str, ...]):
        self.key = key
        parts = [f"(?P<{kind}>{PATTERNS[kind][0]})" for kind in kinds]
        self.pattern = re.compile("|".join(parts))
        self.one = lru_cache(100_000)(self._one)
        # every value has a digit or an '@'; most texts end here
        self.may = re.compile("[0-9@]")

    def _one(self, kind: str, text: str) -> str | None:
        return PATTERNS[kind][1](self.key, text)

    def _first(self, kind: str, value: str) -> tuple[int, str | None]:
        """Length and pseudonym of the first of a kind's possible values that passes its check."""
        for end in ENDS[kind](value) if kind in ENDS else (len(value),):
            if (fresh := self.one(kind, value[:end])) is not None:
                return end, fresh
        return 0, None

    def replace(self, text: str) -> tuple[str, list[dict]]:
        """The text with pseudonyms, and (kind, start, length) of each in the new text."""
        if not self.may.search(text):
            return text, []
        out, spans, done, size, at = [], [], 0, 0, 0
        while found := self.pattern.search(text, at):
            kind, start = found.lastgroup, found.start()
            end, fresh = self._first(kind, found[0])
            if fresh is None:  # another kind may begin at the same place
                for other, (pattern, _) in PATTERNS.items():
                    again = re.compile(pattern).match(text, start) if other in self.pattern.groupindex else None
                    if again and other != kind:
                        end, fresh = self._first(other, again[0])
                        if fresh is not None:
                            kind = other
                            break
                else:
                    at = start + 1
                    while at < len(text) and text[at].isdigit():
                        at += 1
                    continue
            before = text[done:start]
            size += len(before)
            spans.append({"kind": kind, "start": size, "length": len(fresh)})
            out += [before, fresh]
            size += len(fresh)
            done = at = start + end
        return "".join([*out, text[done:]]) if out else text, spans


def pseudonymise(
    docs: DataFrame,
    key: str,
    kinds: tuple[str, ...] = tuple(PATTERNS),
    text: str = "text",
    keys: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``keys``, ``text`` with pseudonyms and ``found`` (array of kind, start, length), row by row.

    One pass, no shuffle. Null texts stay null with nothing found, empty texts stay empty;
    repeated rows come out repeated; an empty table gives an empty table; further columns are
    left behind. Texts are searched whole. Values that fail their check (Luhn, mod 97, number
    ranges, calendar) stay as they are; where a shorter value at the same place passes, it goes.
    """
    if not key:
        raise ValueError("a key is needed")
    secret = hashlib.sha256(key.encode()).digest()
    kept = docs.select(*keys, F.col(text).alias("text"))
    span = T.StructType(
        [T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType())]
    )
    schema = T.StructType(
        [*(kept.schema[k] for k in keys), T.StructField("text", T.StringType()), T.StructField("found", T.ArrayType(span))]
    )
    found_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("length", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Pseudonyms(secret, kinds)
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                done = [(None, []) if t is None else own.replace(t) for t in batch.column(len(keys)).to_pylist()]
                out = [batch.column(k) for k in range(len(keys))]
                out += [pa.array([t for t, _ in done], pa.string()), pa.array([s for _, s in done], found_type)]
                yield pa.RecordBatch.from_arrays(out, schema.names)

    return kept.mapInArrow(run, schema)
