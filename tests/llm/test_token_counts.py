import random

import pytest

from quern.llm import token_counts
from quern.llm.token_counts import MARK, Trie

PIECES = {MARK: -2.0, "a": -3.0, "b": -3.5, "ab": -4.0, "abc": -5.0, MARK + "ab": -4.5, "bca": -6.0, "ca": -4.0, "漢": -5.0}


def brute(word, scores, byte_score):
    """All segmentations."""
    word = MARK + word
    best = {0: (0.0, 0)}
    for end in range(1, len(word) + 1):
        size = len(word[end - 1].encode())
        options = [(best[end - 1][0] + size * byte_score, -(-best[end - 1][1] + size))]
        options += [(best[k][0] + scores[word[k:end]], best[k][1] - 1) for k in range(end) if word[k:end] in scores]
        best[end] = max(options)
    return -best[len(word)][1]


def test_against_brute_force():
    rng = random.Random(4)
    trie = Trie(PIECES, -20.0, 10_000)
    for _ in range(500):
        word = "".join(rng.choice("abcx漢😀") for _ in range(rng.randint(1, 12)))
        assert trie.count(word) == brute(word, PIECES, -20.0)


def test_small_tries_count_alike():
    rng = random.Random(5)
    some = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    large, small = Trie(PIECES, -20.0, 10**6), Trie(PIECES, -20.0, 5)
    assert [large.count(w) for w in some] == [small.count(w) for w in some]
    assert len(small.best) < 40


def test_long_pre_tokens_count_alike():
    rng = random.Random(6)
    deep, flat = Trie(PIECES, -20.0, 10**6, depth=10**6), Trie(PIECES, -20.0, 10**6, depth=1)
    for n in (*range(1, 20), 63, 64, 65, 500):
        word = "".join(rng.choice("abcx漢") for _ in range(n))
        assert flat.count(word) == deep.count(word) == Trie(PIECES, -20.0, 10**6).count(word)
    assert len(flat.best) <= 20 * (flat.depth + 1)


def test_a_pre_token_of_millions_of_characters_takes_bounded_memory():
    import tracemalloc

    word = "abcx" * 500_000
    trie = Trie(PIECES, -20.0, 400_000)
    tracemalloc.start()
    n = trie.count(word)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(trie.best) < 100 and peak < 10 * 2**20 and not trie.counts
    assert n > 500_000


def test_prefixes_share_nodes():
    trie = Trie(PIECES, -20.0, 1000)
    trie.count("abc")
    before = len(trie.best)
    trie.count("ab")
    assert len(trie.best) == before
    trie.count("aba")
    assert len(trie.best) == before + 1


def test_counts_of_documents(docs, rows, no_docs):
    got = token_counts.count_tokens(docs, vocabulary=PIECES).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    for i, t, _ in rows:
        if i is not None and [x[0] for x in rows].count(i) == 1:
            w = (t or "").split()
            assert (by_id[i]["n_chars"], by_id[i]["n_pretokens"], by_id[i]["n_distinct"]) == (len(t or ""), len(w), len(set(w)))
            if len(w) < 400:
                assert by_id[i]["n_tokens"] == sum(brute(x, PIECES, -20.0) for x in w)
    assert token_counts.count_tokens(no_docs, vocabulary=PIECES).collect() == []


def test_public_vocabulary():
    pytest.importorskip("sentencepiece")
    scores = token_counts.read_vocabulary()
    assert len(scores) > 30_000 and MARK in scores and not any(p.startswith("<0x") for p in scores)
