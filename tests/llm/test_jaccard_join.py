import random

import numpy as np
import pytest

from quern.llm import jaccard_join
from quern.llm.components import components
from quern.llm.shingles import MinHash, bands_for


def shingles(text, width=5):
    w = (text or "").lower().split()
    k = min(width, len(w))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def expected(rows, threshold=0.8):
    sets = [shingles(t) for _, t, _ in rows]
    n = len(rows)
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * n
    for a in range(n):
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    members = {}
    for x in range(n):
        members.setdefault(find(x), []).append(x)
    least = lambda xs: min((rows[x][0] for x in xs if rows[x][0] is not None), default=None)
    out = []
    for x in range(n):
        copies = [y for y in range(n) if sets[y] == sets[x]] if sets[x] else [x]
        out.append((rows[x][0], least(members[find(x)]), least(copies), len(copies), links[x]))
    return sorted(out, key=str)


@pytest.mark.parametrize("cut", [{}, {"chunk_shingles": 900}, {"chunk_classes": 3}])
def test_against_all_pairs(docs, rows, cut):
    got = jaccard_join.join(docs, recall=0.99999, **cut).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)


def family(n, size=120, edits=1, seed=3):
    """Near copies of one text, each with a few words changed."""
    rng = random.Random(seed)
    base = [f"w{k}" for k in range(size)]
    out = []
    for k in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(size)] = f"x{k}y{rng.random()}"
        out.append(" ".join(w))
    return out


def test_a_family_cut_into_many_chunks(spark):
    rows = [(k, t, None) for k, t in enumerate(family(60, 60, 3))]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = jaccard_join.join(docs, recall=0.99999, chunk_classes=7).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)


def test_whole_sets_go_once_to_each_bucket(spark, monkeypatch):
    """What is shuffled of a family of near copies grows about as its rows do, however many chunks it is cut into."""
    moved = []
    keep = jaccard_join.written

    def written(df, label):
        out = keep(df, label)
        if label == "found":
            deltas = out.filter("delta IS NOT NULL").selectExpr("coalesce(sum(octet_length(delta) + 60), 0)").first()[0]
            moved.append(deltas)
        return out

    monkeypatch.setattr(jaccard_join, "written", written)
    for n in (100, 400):
        docs = spark.createDataFrame([(k, t) for k, t in enumerate(family(n, 400))], "doc_id long, text string")
        assert {r["n_links"] for r in jaccard_join.join(docs, chunk_classes=50).collect()} == {n - 1}
    whole = 18 * 400 * 396 * 8  # once in each band
    assert moved[1] < 0.5 * whole


def test_rows_without_ids_meet_their_own_class_only(spark):
    rows = [(None, t, None) for t in family(30, 40, 1)] + [(None, None, None)] * 40 + [(5, "a b c", None), (5, "d e f", None), (5, "a b c d", None)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    assert sorted(map(tuple, jaccard_join.join(docs, recall=0.99999).collect()), key=str) == expected(rows)


def test_default_bands_find_near_copies(docs, rows):
    got = {r["doc_id"]: r for r in jaccard_join.join(docs).collect()}
    want = {r[0]: r for r in expected(rows)}
    assert sum(got[i]["n_links"] for i in got if i is not None) >= 0.99 * sum(want[i][4] for i in want if i is not None)


def test_one_of_each_group_stays(docs):
    joined = jaccard_join.join(docs)
    kept = jaccard_join.kept(docs, joined)
    assert kept.columns == docs.columns
    groups = {r["class_id"] for r in joined.collect() if r["class_id"] is not None}
    assert {r["doc_id"] for r in kept.collect() if r["doc_id"] is not None} == groups


def test_empty(no_docs):
    assert jaccard_join.join(no_docs).collect() == []


def test_bands_reach_recall():
    for rows in (3, 5, 8):
        b = bands_for(0.8, 0.995, rows)
        assert 1 - (1 - 0.8**rows) ** b >= 0.995 > 1 - (1 - 0.8**rows) ** (b - 1)


def test_minhash_meets_as_often_as_expected():
    rng = np.random.default_rng(0)
    signer, met = MinHash(200, 1), []
    for _ in range(20):
        both, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (80, 10, 10))
        keys = [signer.keys(np.unique(np.concatenate((both, x)))) for x in (a, b)]
        met.append((keys[0] == keys[1]).mean())
    assert abs(np.mean(met) - 0.8) < 0.03


def test_overlaps_by_matrix_and_by_pair():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(12)]
    at = np.arange(12)
    full = jaccard_join.overlaps(sets, np.ones((12, 12), bool), at, at, columns=7)
    assert all(full[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in at for j in at)


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(100, 100 + i) for i in range(1, 50)]
    got = dict(components(spark.createDataFrame([*path, *star, (7, 7)], "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(1, 61)}, **{100 + i: 100 for i in range(1, 50)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_rows_stay_by_class_and_not_by_id(spark):
    from .conftest import words

    rng = random.Random(11)
    a, b, c, d, e = (words(rng, 60) for _ in range(5))
    near = lambda t: t + " more"
    rows = [(1, a), (None, near(a)), (None, b), (None, None), (None, ""), (2, c), (7, near(c)), (7, d), (None, e), (None, near(e)), (None, e), (9, words(rng, 40))]
    rows.append(rows[-1])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for joined in (jaccard_join.join(docs), jaccard_join.join(docs, keyed=True)):
        got = [tuple(r) for r in jaccard_join.kept(docs, joined).collect()]
        of_e = [r for r in got if r[1] in (e, near(e))]
        want = [(1, a), (None, b), (None, None), (None, ""), (2, c), (7, d), rows[-1], rows[-1]]
        assert len(of_e) == 1 and sorted(map(str, got)) == sorted(map(str, [*want, *of_e]))
