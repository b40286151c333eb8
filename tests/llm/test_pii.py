import random
import re
from datetime import date

import pytest

from quern.llm import pii
from quern.llm.pii import Feistel, Pseudonyms, luhn, luhn_digit, mod97

VALUES = {
    "email": ["und.34@mail7.example.com", "a@b.co", "élan.9+x@x-y.example.org"],
    "iban": ["GB82 WEST 1234 5698 7654 32", "DE89370400440532013000"],
    "ip": ["97.51.17.173", "0.0.0.1", "255.255.255.255"],
    "date": ["1987-02-28", "2000-02-29", "3/4/1999", "28.02.1987", "12-31-2001", "2099-12-31", "1/11/2020", "11/1/2020", "05/3/2020", "10/11/2020", "5/13/1950", "01.02.2003"],
    "ssn": ["123-45-6789"],
    "phone": ["+1 (017) 555-7713", "(212) 555-1234", "212-555-1234", "+49 30 1234567", "+49301234567", "+353 1 234 5678", "+35312345678"],
    "card": ["4845168114407329", "4845-1681-1440-7329", "378282246310005"],
}
NOT = ["9807915762804490", "300.1.1.1", "1999-13-01", "2001-02-30", "000-12-3456", "01.2.3.4", "GB82 WEST 1234 5698 7654 33", "1.2.3", "x@y", "123456"]


def digits(x):
    return [int(c) for c in x if c.isdigit()]


@pytest.mark.parametrize("kind,value", [(k, v) for k, vs in VALUES.items() for v in vs])
def test_round_trip_and_format(kind, value):
    there, back = Pseudonyms(b"k"), Pseudonyms(b"k", back=True)
    text = f"x {value}, y"
    new, counts, spans = there.text(text)
    assert counts[kind] == 1 and sum(counts.values()) == 1 and spans == [(kind, 2, 2 + len(value))]
    assert there.text(text)[0] == new != text
    again = back.text(new)[0]
    assert re.sub(r"[0-9]", "0", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", new))) == re.sub(r"[0-9]", "0", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", text))) or kind == "ip"
    assert again == text
    shown = new[2:-3]
    if kind == "card":
        assert luhn(digits(shown))
    if kind == "iban":
        assert mod97(shown.replace(" ", "")) == 1 and shown[:2] == value[:2]


@pytest.mark.parametrize("value", NOT)
def test_invalid_values_stay(value):
    assert Pseudonyms(b"k").text(f"x {value} y")[0] == f"x {value} y"


def test_dates_permute_days():
    there, back = Pseudonyms(b"k"), Pseudonyms(b"k", back=True)
    days = [date.fromordinal(pii.FIRST_DAY.toordinal() + 37 * k) for k in range(1800)]
    shown = [there.date(d.isoformat()) for d in days]
    assert len(set(shown)) == len(days) and [back.date(x) for x in shown] == [d.isoformat() for d in days]


def test_equal_values_stay_linked():
    there = Pseudonyms(b"k")
    same = lambda a, b: digits(there.text(a)[0]) == digits(there.text(b)[0])
    assert same("4845168114407329", "4845-1681-1440-7329") and same("(212) 555-1234", "212-555-1234")
    for code in ("1", "7", "49", "44", "353", "420", "995"):  # whatever the punctuation, the country code stays
        a, b, c = f"+{code}301234567", f"+{code} 30 1234567", f"+{code} (30) 123-4567"
        assert same(a, b) and same(a, c) and there.text(a)[0].startswith("+" + code) and there.text(a)[0] != a
    d = ["3/4/1999", "03/04/1999", "03.04.1999", "1999-04-03"]
    assert len({tuple(sorted(map(int, re.split("[-/.]", there.text(x)[0])))) for x in d}) == 1
    d = [there.text(x)[0] for x in ("1987-02-28", "28.02.1987", "28/02/1987")]
    assert d[1] == d[2].replace("/", ".") and d[0] == "-".join(reversed(d[1].split(".")))
    assert Pseudonyms(b"other").text("97.51.17.173")[0] != there.text("97.51.17.173")[0]


def test_every_date_in_every_format_comes_back():
    there, back = Pseudonyms(b"k"), Pseudonyms(b"k", back=True)
    rng = random.Random(2)
    for _ in range(400):
        d = date.fromordinal(pii.FIRST_DAY.toordinal() + rng.randrange(pii.N_DAYS))
        pad = lambda x: rng.choice((str(x), f"{x:02d}"))
        a, b = (pad(d.day), pad(d.month)) if rng.random() < 0.7 else (pad(d.month), pad(d.day))
        sep = rng.choice("-/.")
        for x in (d.isoformat(), f"{a}{sep}{b}{sep}{d.year}"):
            assert back.date(there.date(x)) == x


def test_feistel_is_a_permutation():
    net = Feistel(b"key", "t")
    for radices in ([3, 4, 5], [7], [2, 2, 2, 2], [10, 26]):
        space = [[]]
        for r in radices:
            space = [s + [x] for s in space for x in range(r)]
        out = [net.encrypt(s, radices) for s in space]
        assert sorted(out) == space and [net.decrypt(o, radices) for o in out] == space
    assert not luhn([1, 2, 3]) and luhn([1, 2, 3, luhn_digit([1, 2, 3])])


def test_rows(spark, docs, rows, no_docs):
    some = [(1, "call +1 (017) 555-7713 or write a.b@c.org", "x"), (2, None, "x"), (3, "", "y"), (None, "97.51.17.173", None), (1, "97.51.17.173 97.51.17.173", "z")]
    got = pii.pseudonymise(spark.createDataFrame(some, "doc_id long, text string, n_values string"), key=b"k").collect()
    assert sorted(r["n_values"] for r in got) == [0, 0, 1, 2, 2]
    assert [r["text"] for r in got if r["doc_id"] == 2] == [None] and [r["text"] for r in got if r["doc_id"] == 3] == [""]
    twice = next(r["text"] for r in got if r["n_ip"] == 2).split()
    assert twice[0] == twice[1] == next(r["text"] for r in got if r["doc_id"] is None)
    assert pii.pseudonymise(docs, key=b"k").count() == len(rows)
    assert pii.pseudonymise(no_docs, key=b"k").collect() == []


def plain(text, key):
    """All values of a text, found without the hint and by comparing every two matches."""
    names, taken = Pseudonyms(key), []
    for kind, pattern in pii.PATTERNS:
        own, at = [], 0
        while m := pattern.search(text, at):
            at = m.end()
            if kind in pii.IN_PARTS:
                cuts, valid = pii.IN_PARTS[kind]
                free = [(m.start() + a, m.start() + b) for a, b in cuts(m[0]) if not any(x < m.start() + b and m.start() + a < y for x, y, _ in taken)]
                fits = [c for c in free if valid(text[c[0] : c[1]])]
                own += [(*fits[0], kind)] if fits else []
                at = fits[0][1] if fits else m.start() + next((i for i, c in enumerate(m[0]) if c in " -"), len(m[0]))
            elif not any(x < m.end() and m.start() < y for x, y, _ in taken) and getattr(names, kind)(m[0]) is not None:
                own.append((m.start(), m.end(), kind))
        taken += own
    return [(kind, a, b) for a, b, kind in sorted(taken)]


def test_values_found_against_brute_force():
    rng = random.Random(12)
    values = [v for vs in VALUES.values() for v in vs] + NOT + ["12/27", "EUR", "43", "x", ",", "(", "+", "-", "@", "."]
    for _ in range(600):
        text = "".join(rng.choice(values) + rng.choice(("", " ", " ", ", ", "-", "\n")) for _ in range(rng.randint(1, 8)))
        assert Pseudonyms(b"k").text(text)[2] == plain(text, b"k")


def test_texts_without_values_are_untouched():
    rng = random.Random(1)
    from .conftest import words

    for _ in range(50):
        t = words(rng, 50)
        assert Pseudonyms(b"k").text(t)[0] == t


def test_long_runs_take_linear_time():
    for t in ("a" * 300_000, "1" * 300_000, "1-" * 100_000, "A1" * 100_000, "1." * 100_000, "a." * 100_000 + "@", "+1 " * 60_000):
        Pseudonyms(b"k").text(t)


@pytest.mark.parametrize("before,value,after,kind", [
    ("", "4111 1111 1111 1111", " 12/27", "card"), ("", "4111 1111 1111 1111", " 123", "card"), ("43 ", "4111 1111 1111 1111", "", "card"), ("7 ", "4845168114407329", " 09", "card"),
    ("", "3782 822463 10005", " 1234", "card"), ("12-", "4111-1111-1111-1111", "", "card"), ("", "BE68 5390 0754 7034", " EUR", "iban"), ("AB13 ", "BE68 5390 0754 7034", "", "iban"), ("", "GB82 WEST 1234 5698 7654 32", " ABC", "iban"),
])
def test_values_beside_others(before, value, after, kind):
    for key in (b"k", b"l", *(bytes([k]) for k in range(1, 40))):
        text = f"x {before}{value}{after}, y"
        new, counts, spans = Pseudonyms(key).text(text)
        at = 2 + len(before)
        assert spans == [(kind, at, at + len(value))] and counts[kind] == 1
        assert new[:at] == text[:at] and new[at + len(value) :] == text[at + len(value) :] and new != text
        assert Pseudonyms(key, back=True).text(new)[0] == text


def test_many_digits_take_linear_time():
    for t in ("a.b@c.org 97.51.17.173 3/4/1999 " * 5_000, "1 " * 100_000, "4111 " * 40_000, "BE68 5390 0754 7034 EUR " * 8_000):
        Pseudonyms(b"k").text(t)
