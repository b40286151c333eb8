import random
import re

import pytest

from quern.llm import decontaminate
from quern.llm.decontaminate import Windows, joined, words_of

from .conftest import words


def split(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(doc, items, width):
    w, hit, met = split(doc), set(), set()
    for item, text in items:
        x = split(text)
        m = min(width, len(x))
        for i in range(len(x) - m + 1 if m else 0):
            for j in range(len(w) - m + 1):
                if w[j : j + m] == x[i : i + m]:
                    hit.update(range(j, j + m))
                    met.add("" if item is None else str(item))
    return len(w), len(hit), met


@pytest.mark.parametrize("width", [1, 2, 3, 10])
def test_search_against_brute_force(width):
    rng = random.Random(width)
    for _ in range(60):
        items = [(str(k), " ".join(rng.choice("abc") for _ in range(rng.randint(0, 6)))) for k in range(5)]
        doc = " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 40)))
        table = Windows(items, width)
        found = list(table.search([table.ids.get(w, 0) for w in words_of(doc)]))
        n, n_hit, met = brute(doc, items, width)
        assert sum(b - a for a, b in joined([(s, e) for s, e, _ in found])) == n_hit
        assert set().union(*[i for _, _, i in found]) == met


def items_and_docs():
    rng = random.Random(9)
    items = [(k, words(rng, rng.randint(12, 30))) for k in range(12)] + [(20, "Two WORDS!"), (21, ""), (22, None), (None, words(rng, 11)), (3, words(rng, 14)), (23, "É ü")]
    docs = []
    for k in range(40):
        text = items[k % 12][1].split()
        docs.append((k, f"{words(rng, 20)}, {' '.join(text[:rng.randint(5, 12)]).upper()}! {words(rng, 9)} two-words"))
    return items, [*docs, (100, None), (101, ""), (None, items[0][1]), (7, items[1][1]), (102, f"É ü x {items[15][1]}")]


@pytest.mark.parametrize("block_chars", [300, 10**6])
def test_rows_against_brute_force(spark, block_chars):
    items, rows = items_and_docs()
    table = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n_words long, items string")
    got = decontaminate.find_items(docs, table, block_chars=block_chars).collect()
    seen = sorted((str(r["id"]), r["n_words"], sum(b - a for a, b in r["spans"]), ",".join(sorted(r["items"]))) for r in got)
    want = []
    for i, t in rows:
        n, hit, met = brute(t, items, 10)
        want.append((str(i), n, hit, ",".join(sorted(met))))
    assert seen == sorted(want)


def test_clean_and_empty(spark, docs, no_docs):
    items, rows = items_and_docs()
    table = spark.createDataFrame(items, "item_id long, text string")
    own = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, id int")
    kept = decontaminate.clean(own, table)
    assert kept.columns == own.columns
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in own.collect() if not brute(r["text"], items, 10)[1])
    assert decontaminate.clean(docs, table.filter("false")).count() == docs.count()
    assert decontaminate.decontaminate(no_docs, table).collect() == []


def test_one_long_item_is_cut_and_blocks_stay_small(spark, monkeypatch):
    rng = random.Random(10)
    long = words(rng, 4000)
    items = spark.createDataFrame([(1, long), (2, words(rng, 300)), (1, long)], "item_id long, text string")
    made = []
    keep = Windows.__init__

    def noted(self, some, width):
        made.append(sum(len(w) for _, w in some))
        keep(self, some, width)

    monkeypatch.setattr(Windows, "__init__", noted)
    monkeypatch.setattr(decontaminate, "PIECE", 50)
    w = long.split()
    rows = [(k, " ".join([words(rng, 5), *w[at : at + 12], words(rng, 5)])) for k, at in enumerate(range(0, 3980, 97))] + [(900, words(rng, 40)), (901, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_hit"], r["n_items"]) for r in decontaminate.decontaminate(docs, items, block_chars=8_000).collect()}
    assert got == {k: (12, 1) if k < 900 else (0, 0) for k, _ in rows}
    assert len(made) >= 3 and max(made) < 0.8 * 4300
    kept = decontaminate.clean(docs, items)
    assert sorted(r["doc_id"] for r in kept.collect()) == [900, 901]


def test_bytes_a_window():
    import pickle

    rng = random.Random(11)
    table = Windows([(str(k), words(rng, 110)) for k in range(300)], 10)
    windows = sum(len(h) if isinstance(h, dict) else 1 for _, _, b in table.tables for h in b.values())
    assert windows > 30_000 and len(pickle.dumps(table)) < 120 * windows
