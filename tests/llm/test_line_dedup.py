import random
from collections import defaultdict

from quern.llm import line_dedup
from quern.llm.line_dedup import common_blocks, patience, rising


def longest_rising(values):
    """By the plain quadratic recurrence; of equal ones, the latest at each step."""
    length, before = [], []
    for i, v in enumerate(values):
        prior = [j for j in range(i) if values[j] < v]
        length.append(1 + max((length[j] for j in prior), default=0))
        before.append(max((j for j in prior if length[j] == length[i] - 1), default=None))
    at = max((i for i in range(len(values)) if length[i] == max(length)), default=None)
    out = []
    while at is not None:
        out.append(at)
        at = before[at]
    return out[::-1]


def aligned(a, b, i=0, j=0):
    """Patience diff said recursively: pairs of positions in a + i and b + j."""
    if not a or not b:
        return []
    if a[0] == b[0]:
        return [(i, j), *aligned(a[1:], b[1:], i + 1, j + 1)]
    if a[-1] == b[-1]:
        return [*aligned(a[:-1], b[:-1], i, j), (i + len(a) - 1, j + len(b) - 1)]
    once = [x for x in a if a.count(x) == 1 and b.count(x) == 1]
    fixed = [once[k] for k in longest_rising([b.index(x) for x in once])]
    if not fixed:
        return []
    out, last_a, last_b = [], 0, 0
    for x in fixed:
        at, to = a.index(x), b.index(x)
        out += [*aligned(a[last_a:at], b[last_b:to], i + last_a, j + last_b), (i + at, j + to)]
        last_a, last_b = at + 1, to + 1
    return out + aligned(a[last_a:], b[last_b:], i + last_a, j + last_b)


def removed(earlier, later, min_words):
    """Positions of `later`, among lines that aren't blank, in aligned runs of enough words."""
    side = [[(p, x) for p, x in enumerate(t) if x in other] for t, other in ((earlier, set(later)), (later, set(earlier)))]
    out, run = set(), []
    pairs = [(side[0][i][0], side[1][j][0]) for i, j in aligned([x for _, x in side[0]], [x for _, x in side[1]])]
    for n, (i, j) in enumerate(pairs):
        run.append(j)
        if n + 1 == len(pairs) or pairs[n + 1] != (i + 1, j + 1):
            out |= set(run) if sum(len(later[k].split()) for k in run) >= min_words else set()
            run = []
    return out


def expected(rows, min_words):
    """Plain Python over all pairs of texts, by an aligner of its own and all their lines."""
    first = {}
    order = lambda x: (x is None, x or 0)
    for i, t, _ in sorted(rows, key=lambda r: order(r[0])):
        if t is not None:
            first.setdefault(t, i)
    texts = list(first)
    places = {t: [n for n, x in enumerate(t.split("\n")) if x.split()] for t in texts}
    lines = {t: [x for x in t.split("\n") if x.split()] for t in texts}
    holders = defaultdict(list)
    for t in texts:
        for x in set(lines[t]):
            holders[x].append(t)
    gone = {t: set() for t in texts}
    for n, b in enumerate(texts):
        near = {a for x in lines[b] for a in holders[x]}
        for a in texts[:n]:
            if a in near:
                gone[b] |= removed(lines[a], lines[b], min_words)
    out = []
    for i, t, _ in rows:
        if t is None:
            out.append((i, None, 0, 0))
        elif i != first[t] and sum(len(x.split()) for x in lines[t]) >= min_words:
            out.append((i, "", len(lines[t]), len(lines[t])))
        else:
            drop = {places[t][p] for p in gone[t]}
            out.append((i, "\n".join(x for k, x in enumerate(t.split("\n")) if k not in drop) if drop else t, len(lines[t]), len(drop)))
    return out


def key(r):
    return tuple((x is None, x if x is not None else "") for x in r)


def test_against_all_pairs(docs, rows):
    unique = [r for r in rows if [x[0] for x in rows].count(r[0]) == 1 or r[0] is None]  # ids with several texts have no order here
    ids = {r[0] for r in unique}
    kept = docs.filter(docs.doc_id.isNull() | docs.doc_id.isin([i for i in ids if i is not None]))
    for rare, min_words in ((4, 8), (2, 1), (100, 8)):
        got = line_dedup.dedup(kept, rare=rare, min_words=min_words).collect()
        assert sorted(map(tuple, got), key=key) == sorted(expected(unique, min_words), key=key)


def test_repeated_ids_and_empty(docs, no_docs, rows):
    assert line_dedup.dedup(docs).count() == len(rows)
    assert line_dedup.dedup(no_docs).collect() == []


def test_other_columns_stay(docs):
    out = line_dedup.applied(docs)
    assert [c for c in out.columns if c not in ("n_lines", "n_removed")] == [c for c in docs.columns if c != "n_lines"]


def test_a_line_stays_in_its_first_text(docs):
    lines = lambda df: {x for r in df.select("text").collect() for x in (r[0] or "").split("\n") if x.strip()}
    assert lines(line_dedup.dedup(docs)) == lines(docs)


def test_patience_is_a_common_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.choice("abcdefgh") for _ in range(rng.randint(0, 12))] for _ in range(2))
        got = patience(a, b)
        assert all(a[i] == b[j] for i, j in got)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:], strict=False))
    assert patience(list("abcdef"), list("abxdef")) == [(0, 0), (1, 1), (3, 3), (4, 4), (5, 5)]


def test_rising():
    assert [[5, 1, 2, 9, 3][k] for k in rising([5, 1, 2, 9, 3])] == [1, 2, 3]


def test_blocks_need_words_and_neighbours():
    a, b = [(0, b"x"), (1, b"y"), (5, b"z")], [(2, b"x"), (3, b"y"), (4, b"z")]
    words = {b"x": 3, b"y": 3, b"z": 5}
    assert common_blocks(a, b, words, 6) == [2, 3]
    assert common_blocks(a, b, words, 5) == [2, 3, 4]
    assert common_blocks(a, b, words, 7) == []


def test_frequent_lines_against_all_pairs(spark):
    """Blocks of frequent lines whose lines are first held by different texts; crossing and repeated ones."""
    rng = random.Random(2)
    stock = [f"{k} common line" for k in range(9)]
    rows = [(k, f"own {k} text\n{stock[k]}\nmore of {k}", "s") for k in range(9)]
    for k in range(9, 120):
        block = stock[rng.randint(0, 5) :][: rng.randint(1, 5)]
        other = [rng.choice(stock) for _ in range(rng.randint(0, 4))]
        rows.append((k, "\n".join([f"begins {k} here", *block, *[f"between {k}"] * rng.randint(0, 1), *other, f"end {k}"]), "s"))
    got = line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    want = expected(rows, 8)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def gone_of(spark, rows, **settings):
    got = line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string"), **settings).collect()
    assert sorted(map(tuple, got), key=key) == sorted(expected([(*r, None) for r in rows], settings.get("min_words", 8)), key=key)
    return {r["doc_id"]: r["n_removed"] for r in got if r["n_removed"]}


def test_a_block_around_a_frequent_line(spark):
    """The middle line is first held elsewhere and frequent; it belongs to the block all the same."""
    rows = [(k, f"text {k} of its own\nsee also below\nand no more {k}") for k in range(5)]
    block = "one line of five words\nsee also below\nand one more of six words"
    rows += [(10, f"ten begins\n{block}\nten ends"), (11, f"eleven begins\n{block}\neleven ends")]
    assert gone_of(spark, rows) == {11: 3}


def test_a_block_whose_lines_are_first_held_by_different_texts(spark):
    rows = [(1, "a line of five words\nx one"), (2, "y two\nand another of five words")]
    rows += [(k, f"text {k}\na line of five words\nand another of five words\nends {k}") for k in range(10, 16)]
    assert gone_of(spark, rows) == dict.fromkeys(range(11, 16), 2)


def test_the_two_aligners_agree():
    rng = random.Random(5)
    for _ in range(400):
        a, b = ([rng.choice("abcdefghijkl") for _ in range(rng.randint(0, 14))] for _ in range(2))
        assert patience(a, b) == aligned(a, b)
