from collections import Counter

import numpy as np
import pytest

from quern.llm import suffix_dedup
from quern.llm.shingles import WordHashes


def covered(texts, size):
    """Positions in a run of `size` words that occurs twice."""
    split = [t.split() for t in texts]
    seen = Counter(tuple(w[i : i + size]) for w in split for i in range(len(w) - size + 1))
    return [{p for i in range(len(w) - size + 1) if seen[tuple(w[i : i + size])] > 1 for p in range(i, i + size)} for w in split]


def exact(texts, size):
    """Runs of positions that lie in a run of `size` words that occurs twice."""
    out = []
    for held in covered(texts, size):
        spans = []
        for p in sorted(held):
            if spans and spans[-1][1] == p:
                spans[-1][1] = p + 1
            else:
                spans.append([p, p + 1])
        out.append([tuple(s) for s in spans])
    return out


def found_of(spark, texts, **settings):
    rows = [(k, t) for k, t in enumerate(texts)]
    got = [[] for _ in texts]
    for r in suffix_dedup.repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), **settings).collect():
        assert r["n_words"] == r["end_word"] - r["start_word"]
        got[r["doc_id"]].append((r["start_word"], r["end_word"]))
    return [sorted(g) for g in got]


@pytest.mark.parametrize("min_words,window", [(50, 16), (20, 6)])
def test_spans_against_brute_force(docs, rows, min_words, window):
    found = suffix_dedup.repeats(docs, min_words=min_words, window=window).collect()
    texts = [t or "" for _, t, _ in rows]
    by_id = {}
    for r in found:
        by_id.setdefault(r["doc_id"], []).append((r["start_word"], r["end_word"]))
    ids = [i for i, _, _ in rows]
    for i, spans in zip(ids, exact(texts, min_words), strict=True):
        if ids.count(i) == 1:  # rows that share an id can't be told apart here
            assert sorted(by_id.get(i, [])) == spans


def test_passages_of_all_lengths_and_partners(spark):
    """Passages of 40 to 70 words, cut from shared ones so that left and right ends have different partners."""
    import random

    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    long = [[word() for _ in range(120)] for _ in range(6)]
    texts = []
    for _ in range(150):
        source = rng.choice(long)
        size = rng.randint(40, 70)
        at = rng.randint(0, len(source) - size)
        texts.append(" ".join([*(word() for _ in range(rng.randint(0, 30))), *source[at : at + size], *(word() for _ in range(rng.randint(0, 30)))]))
    assert found_of(spark, texts) == exact(texts, 50)


def test_two_partners_for_one_stretch_are_no_repeat(spark):
    a, b = [f"a{k}" for k in range(45)], [f"b{k}" for k in range(45)]
    own = lambda n, m: [f"x{n}y{k}" for k in range(m)]
    texts = [" ".join(t) for t in (a + b, own(1, 30) + a + own(2, 30), own(3, 30) + b + own(4, 30))]
    assert found_of(spark, texts) == [[], [], []]


def test_a_passage_in_a_third_of_all_texts_is_split_over_tasks(spark):
    own = lambda n: " ".join(f"x{n}y{k}" for k in range(30))
    passage = " ".join(f"p{k}" for k in range(64))
    texts = [f"{own(n)} {passage} {own(n + 1000)}" if n % 3 == 0 else own(n) for n in range(300)]
    assert found_of(spark, texts) == [[(30, 94)] if n % 3 == 0 else [] for n in range(300)]


def test_empty(no_docs):
    assert suffix_dedup.repeats(no_docs).collect() == []


def test_clean_documents_have_no_span(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(200))) for i in range(20)]
    assert suffix_dedup.repeats(spark.createDataFrame(rows, "doc_id long, text string")).count() == 0


def test_run_hashes_tell_runs_apart():
    h = WordHashes()("a b c a b d a b c".split())
    at = np.arange(len(h) - 2)
    got = suffix_dedup.Runs()(h, at, 3)
    assert got[0] == got[6] and len(set(got.tolist())) == 6
    assert (suffix_dedup.Runs(suffix_dedup._BASES[1])(h, at, 3) != got).all()
    long = WordHashes()([str(k % 700) for k in range(9000)])
    far = suffix_dedup.Runs()(long, np.arange(8000), 5)
    assert (far[:1000] == far[700:1700]).all() and len(set(far.tolist())) == 700


def test_sliding_against_brute_force():
    rng = np.random.default_rng(0)
    for size in range(1, 20):
        x = rng.integers(0, 50, 40).astype(np.uint64)
        assert suffix_dedup.sliding(x, size, np.minimum).tolist() == [x[i : i + size].min() for i in range(41 - size)]


def test_minimisers_depend_on_content_only():
    import random

    rng = random.Random(3)
    shared = [str(rng.random()) for _ in range(60)]
    hashes = WordHashes()
    spots = []
    for lead in (0, 7, 31):
        w = [str(rng.random()) for _ in range(lead)] + shared + [str(rng.random()) for _ in range(20)]
        at = suffix_dedup.minimisers(hashes(w), 8, 16)
        spots.append({int(p) - lead for p in at if 0 <= p - lead <= 60 - 23})
    inner = [{p for p in s if 15 <= p <= 22} for s in spots]
    assert inner[0] == inner[1] == inner[2]
    assert all(min(s) <= 15 for s in spots)
