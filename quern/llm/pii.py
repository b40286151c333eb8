"""PII (operator 10): format-preserving pseudonyms by a keyed Feistel network.

Found and validated: payment card numbers (13 to 19 digits, Luhn), IBANs (mod 97), US social security numbers (ranges),
telephone numbers (+ and country code, or with area code in brackets), IPv4 addresses (octets), dates (ISO, d/m/y with / . or
-; that exist, 1900 to 2099) and mail addresses (the local part's letters and digits; the domain stays). A value's symbols are
split in two halves that take turns in being shifted, position by position and each modulo its own radix, by a keyed hash of
the other half: a permutation of all values of the same kind and shape, so equal values stay equal across documents and
different ones stay different. Where a shape has values that aren't valid, the network is applied again until one is (cycle
walking). Check digits are computed anew. A number's punctuation and its country code after + stay; the same digits get the same
pseudonym whatever their punctuation. A date's format stays, and so does whether day and month have one digit or two and
whether the day can be a month, so that the format can be read again; the same date gets the same pseudonym in all formats.

Where a card number or IBAN as long as it can be read isn't valid, parts of it that separators bound are tried: for cards
of 13 to 19 digits, usual groupings first, then by start, longest first; for IBANs of the country's length. The search goes
on from the next separator. A pseudonym is chosen so that what was tried in vain before it stays invalid, and `back` reads
the same part; this doesn't hold where two card numbers of under 16 digits follow each other after one space.

Null texts stay null and have no values; empty texts stay empty; rows with null or repeated ids are rows of their own; an
empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
FIRST_DAY, N_DAYS = date(1900, 1, 1), (date(2100, 1, 1) - date(1900, 1, 1)).days
#: Kinds in the order in which they claim text; a later one takes only what is left.
PATTERNS = (
    ("email", re.compile(r"(?<![\w.+-])[\w.+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")),
    ("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", re.ASCII)),
    ("ip", re.compile(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.]*\d)", re.ASCII)),
    ("date", re.compile(r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}([/.-])\d{1,2}\1\d{4})(?![/-]?\d)", re.ASCII)),
    ("ssn", re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", re.ASCII)),
    ("phone", re.compile(r"\+\d{1,3}[\x20.-]?(?:\(\d{1,4}\)|\d{1,4})(?:[\x20.-]?\d{2,4}){2,4}(?!\d)|(?<![\d+])\(\d{3}\)\x20?\d{3}[\x20.-]\d{4}(?!\d)|(?<![\d.+-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d.-]*\d)", re.ASCII)),
    ("card", re.compile(r"(?<![\d-])\d(?:[\x20-]?\d){12,18}(?![\d-]*\d)", re.ASCII)),
)
KINDS = tuple(kind for kind, _ in PATTERNS)
#: Digits by group that card numbers are usually written in.
GROUPINGS = ((4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3))
IBAN_LENGTHS = {country: int(n) for n, countries in (
    ("15", "NO"), ("16", "BE"), ("18", "DK FI FO GL NL"), ("19", "MK SI"), ("20", "AT BA EE KZ LT LU XK"), ("21", "CH HR LI LV"), ("22", "BG BH CR DE GB GE IE ME RS VA"),
    ("23", "AE GI IL IQ OM SO TL"), ("24", "AD CZ ES MD PK RO SA SE SK TN VG"), ("25", "LY PT ST"), ("26", "IS TR"), ("27", "BI DJ FR GR IT MC MR SM"), ("28", "AL AZ BY CY DO GT HN HU LB NI PL SV"),
    ("29", "BR EG PS QA UA"), ("30", "JO KW MU YE"), ("31", "MT SC"), ("32", "LC"), ("33", "RU"),
) for country in countries.split()}
#: Country calling codes of one and of two digits; all others have three.
CALLING_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "53", "54", "55", "56", "57", "58",
                 "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "93", "94", "95", "98")
#: A text without any of these holds no value.
HINT = re.compile(r"\d[\d()./ +-]{6}|@|[A-Z]{2}\d{2}", re.ASCII)


class Feistel:
    """A keyed permutation of the lists of symbols of given radices."""

    def __init__(self, key: bytes, tweak: str):
        self.base = hashlib.blake2b(key=key[:64], person=hashlib.blake2b(tweak.encode(), digest_size=16).digest())

    def _shift(self, half: list[int], by: list[int], radices: list[int], turn: int, sign: int) -> list[int]:
        out, block, used = [], b"", 64
        for i, (symbol, radix) in enumerate(zip(half, radices, strict=True)):
            if used >= 64:
                h = self.base.copy()
                h.update(repr((turn, i, len(half), by)).encode())
                block, used = h.digest(), 0
            out.append((symbol + sign * int.from_bytes(block[used : used + 8], "big")) % radix)
            used += 8
        return out

    def encrypt(self, symbols: list[int], radices: list[int]) -> list[int]:
        m = (len(symbols) + 1) // 2
        a, b, ra, rb = symbols[:m], symbols[m:], radices[:m], radices[m:]
        for turn in range(ROUNDS):
            if turn % 2:
                b = self._shift(b, a, rb, turn, 1)
            else:
                a = self._shift(a, b, ra, turn, 1)
        return a + b

    def decrypt(self, symbols: list[int], radices: list[int]) -> list[int]:
        m = (len(symbols) + 1) // 2
        a, b, ra, rb = symbols[:m], symbols[m:], radices[:m], radices[m:]
        for turn in reversed(range(ROUNDS)):
            if turn % 2:
                b = self._shift(b, a, rb, turn, -1)
            else:
                a = self._shift(a, b, ra, turn, -1)
        return a + b


def luhn_digit(digits: list[int]) -> int:
    """The digit that makes a number valid that begins with `digits`."""
    total = sum(d if i % 2 else (2 * d - 9 * (d > 4)) for i, d in enumerate(reversed(digits)))
    return -total % 10


def luhn(digits: list[int]) -> bool:
    return luhn_digit(digits[:-1]) == digits[-1]


def mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def card_valid(value: str) -> bool:
    digits = [int(c) for c in value if _ascii_digit(c)]
    return 13 <= len(digits) <= 19 and luhn(digits) and any(digits)


def iban_valid(value: str) -> bool:
    plain = value.replace(" ", "")
    return 15 <= len(plain) <= 34 and mod97(plain) == 1


def card_parts(value: str) -> list[tuple[int, int]]:
    """(start, end) of what may be a card number in a match, itself first."""
    groups = [m.span() for m in re.finditer(r"\d+", value, re.ASCII)]
    sizes = [b - a for a, b in groups]
    found = [(i, j) for i in range(len(groups)) for j in range(len(groups), i, -1) if 13 <= sum(sizes[i:j]) <= 19 and j - i < len(groups)]
    usual = lambda p: tuple(sizes[p[0] : p[1]]) not in GROUPINGS
    return [(0, len(value)), *((groups[i][0], groups[j - 1][1]) for i, j in sorted(found, key=usual))]


def iban_parts(value: str) -> list[tuple[int, int]]:
    """A match itself, then its beginning of the country's length if a separator ends it there."""
    ends = [m.start() for m in re.finditer(" ", value)]
    return [(0, len(value)), *((0, e) for e in ends if e - value[:e].count(" ") == IBAN_LENGTHS.get(value[:2]))]


#: Kinds whose matches are tried in parts: the parts, and whether one is valid.
IN_PARTS = {"card": (card_parts, card_valid), "iban": (iban_parts, iban_valid)}


def ssn_valid(d: list[int]) -> bool:
    area = d[0] * 100 + d[1] * 10 + d[2]
    return 0 < area < 900 and area != 666 and any(d[3:5]) and any(d[5:])


def _put(value: str, symbols: Iterator[str], where=str.isdigit) -> str:
    """`value` with each character that is a symbol replaced by the next of `symbols`."""
    return "".join(next(symbols) if where(c) else c for c in value)


def _ascii_digit(c: str) -> bool:
    return "0" <= c <= "9"


class Taken:
    """Values found, in order; none overlaps another."""

    def __init__(self):
        self.values: list[tuple[int, int, str, str]] = []
        self.starts: list[int] = []

    def add(self, values: list[tuple[int, int, str, str]]) -> None:
        if values:
            self.values = sorted(self.values + values)
            self.starts = [v[0] for v in self.values]

    def meets(self, start: int, end: int) -> bool:
        before = bisect_left(self.starts, end)
        return before > 0 and self.values[before - 1][1] > start


class Pseudonyms:
    """Pseudonyms of each kind under a key; `back` undoes them."""

    def __init__(self, key: bytes, back: bool = False):
        self.key, self.back, self.nets = key, back, {}

    def _turn(self, kind: str, symbols: list[int], radices: list[int], valid=lambda x: True) -> list[int]:
        net = self.nets.setdefault(kind, Feistel(self.key, kind))
        step = net.decrypt if self.back else net.encrypt
        while True:
            symbols = step(symbols, radices)
            if valid(symbols):
                return symbols

    def card(self, value: str, others: Callable[[str], bool] = lambda new: True) -> str | None:
        digits = [int(c) for c in value if _ascii_digit(c)]
        if not card_valid(value):
            return None
        shown = lambda body: _put(value, iter("".join(map(str, [*body, luhn_digit(body)]))), _ascii_digit)
        return shown(self._turn("card", digits[:-1], [10] * (len(digits) - 1), lambda body: any(body) and others(shown(body))))

    def iban(self, value: str, others: Callable[[str], bool] = lambda new: True) -> str | None:
        plain = value.replace(" ", "")
        if not iban_valid(value):
            return None
        own = plain[4:]

        def shown(symbols: list[int]) -> str:
            new = "".join(str(s) if c.isdigit() else chr(65 + s) for s, c in zip(symbols, own, strict=True))
            check = f"{98 - mod97(plain[:2] + '00' + new):02d}"
            return _put(value, iter(plain[:2] + check + new), lambda c: c != " ")

        return shown(self._turn("iban", [int(c) if c.isdigit() else ord(c) - 65 for c in own], [10 if c.isdigit() else 26 for c in own], lambda s: others(shown(s))))

    def ip(self, value: str) -> str | None:
        octets = value.split(".")
        if any(int(x) > 255 or x != str(int(x)) for x in octets):
            return None
        return ".".join(map(str, self._turn("ip", [int(x) for x in octets], [256] * 4)))

    def date(self, value: str) -> str | None:
        """Day first where both readings exist. Days and months are permuted among those of the same width, and days that can
        be months among themselves, so a date that can be read only as month first still can and its format stays plain."""
        parts = re.split(r"[-/.]", value)
        orders = ((0, 1, 2),) if len(parts[0]) == 4 else ((2, 1, 0), (2, 0, 1))
        for order in orders:
            try:
                day = date(*(int(parts[i]) for i in order))
                break
            except ValueError:
                continue
        else:
            return None
        at, wide = (day - FIRST_DAY).days, 271  # 271 * 271 values hold all days
        if not 0 <= at < N_DAYS:
            return None
        kind = lambda d: (d.month > 9, (d.day > 9) + (d.day > 12))

        def valid(s: list[int]) -> bool:
            at = s[0] * wide + s[1]
            return at < N_DAYS and kind(FIRST_DAY + timedelta(at)) == kind(day)

        high, low = self._turn("date", [at // wide, at % wide], [wide, wide], valid)
        new = FIRST_DAY + timedelta(high * wide + low)
        shown = {i: str(x).zfill(len(parts[i])) for i, x in zip(order, (new.year, new.month, new.day), strict=True)}
        return re.search(r"[-/.]", value)[0].join(shown[i] for i in range(3))

    def ssn(self, value: str) -> str | None:
        digits = [int(c) for c in value if _ascii_digit(c)]
        if not ssn_valid(digits):
            return None
        return _put(value, iter("".join(map(str, self._turn("ssn", digits, [10] * 9, ssn_valid)))), _ascii_digit)

    def phone(self, value: str) -> str | None:
        digits = [int(c) for c in value if _ascii_digit(c)]
        if not 8 <= len(digits) <= 15:
            return None
        plain = "".join(map(str, digits))
        code = (next((n for n in (1, 2) if plain[:n] in CALLING_CODES), 3)) if value[0] == "+" else 0
        body = self._turn(f"phone{''.join(map(str, digits[:code]))}", digits[code:], [10] * (len(digits) - code))
        return _put(value, iter("".join(map(str, digits[:code] + body))), _ascii_digit)

    def email(self, value: str) -> str | None:
        local, _, domain = value.rpartition("@")
        kinds = [10 if _ascii_digit(c) else 26 if c.isascii() and c.isalpha() else 0 for c in local]
        at = [i for i, k in enumerate(kinds) if k]
        if not at:
            return None
        zero = ["0" if _ascii_digit(c) else "a" if c.islower() else "A" for c in local]
        # the domain takes part through the tweak, case apart as it stands
        symbols = self._turn(f"email@{domain.lower()}", [ord(local[i]) - ord(zero[i]) for i in at], [kinds[i] for i in at])
        out = list(local)
        for i, s in zip(at, symbols, strict=True):
            out[i] = chr(ord(zero[i]) + s)
        return "".join(out) + "@" + domain

    def _in_parts(self, kind: str, pattern: re.Pattern, text: str, taken: Taken) -> Iterator[tuple[int, int, str, str]]:
        parts, valid = IN_PARTS[kind]
        at = 0
        while m := pattern.search(text, at):
            value, start = m[0], m.start()
            tried: list[tuple[int, int]] = []
            at = start + next((i for i, c in enumerate(value) if c in " -"), len(value))
            for a, b in parts(value):
                if taken.meets(start + a, start + b):
                    continue
                if valid(value[a:b]):
                    others = lambda new, a=a, b=b: not any(valid((value[:a] + new + value[b:])[c:d]) for c, d in tried)  # noqa: B023, E731
                    yield start + a, start + b, kind, getattr(self, kind)(value[a:b], others)
                    at = start + b
                    break
                tried.append((a, b))

    def _matches(self, kind: str, pattern: re.Pattern, text: str, taken: Taken) -> Iterator[tuple[int, int, str, str]]:
        turn = getattr(self, kind)
        for m in pattern.finditer(text):
            if not taken.meets(m.start(), m.end()) and (new := turn(m[0])) is not None:
                yield m.start(), m.end(), kind, new

    def text(self, text: str) -> tuple[str, dict[str, int], list[tuple[str, int, int]]]:
        """The text with pseudonyms, how many by kind, and (kind, start, end) of each in the text given."""
        taken = Taken()
        if HINT.search(text):
            for kind, pattern in PATTERNS:
                taken.add(list((self._in_parts if kind in IN_PARTS else self._matches)(kind, pattern, text, taken)))
        counts, parts, at = dict.fromkeys(KINDS, 0), [], 0
        for start, end, kind, new in taken.values:
            counts[kind] += 1
            parts += (text[at:start], new)
            at = end
        return "".join((*parts, text[at:])), counts, [(kind, a, b) for a, b, kind, _ in taken.values]


def _done(batches: Iterator[pa.RecordBatch], key: bytes, back: bool) -> Iterator[pa.RecordBatch]:
    names = Pseudonyms(key, back)
    for batch in batches:
        texts, counts = [], {k: [] for k in KINDS}
        for x in batch.column("text"):
            text = x.as_py()
            new, found, _ = names.text(text) if text else (text, dict.fromkeys(KINDS, 0), [])
            texts.append(new)
            for k in KINDS:
                counts[k].append(found[k])
        yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "text": pa.array(texts, pa.string())} | {f"n_{k}": pa.array(v, pa.int64()) for k, v in counts.items()})


def pseudonymise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, key: bytes, back: bool = False) -> DataFrame:
    """One row per document: id, text with pseudonyms, n_values and counts by kind. With `back`, the reverse, for texts
    that hold pseudonyms of the same key only."""
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    schema = texts.select("id", "text", *[F.lit(0).cast("long").alias(f"n_{k}") for k in KINDS]).schema
    out = texts.mapInArrow(lambda b: _done(b, key, back), schema)
    total = sum((F.col(f"n_{k}") for k in KINDS), F.lit(0).cast("long"))
    return out.select(F.col("id").alias(id_col), F.col("text").alias(text_col), total.alias("n_values"), *[f"n_{k}" for k in KINDS])
