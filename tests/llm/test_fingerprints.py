import hashlib

import xxhash
from pyspark.sql import functions as F

from quern.llm import fingerprints
from quern.llm.fingerprints import containment, printed, sketch, union


def spark_xxhash(words):
    seed = 42
    for w in words:
        seed = xxhash.xxh64_intdigest(w.encode(), seed)
    return seed - 2**64 if seed >= 2**63 else seed


def brute(text, width=5, fraction=fingerprints.FRACTION, floor=fingerprints.FLOOR):
    w = (text or "").lower().split()
    k = min(width, len(w))
    limit = int(-(2**63) + fraction * 2**64)
    every = sorted({spark_xxhash(w[i : i + k]) for i in range(len(w) - k + 1)}) if w else []
    return [h for n, h in enumerate(every) if h < limit or n < floor]


def brute_reach(hashes, fraction=fingerprints.FRACTION, floor=fingerprints.FLOOR):
    return max(int(-(2**63) + fraction * 2**64) - 1, hashes[-1]) if len(hashes) >= floor else 2**63 - 1


def brute_near(x, y, same):
    to = min(brute_reach(x), brute_reach(y))
    a, b = ({h for h in s if h <= to} for s in (x, y))
    return float(same) if not x and not y else len(a & b) / min(len(a), len(b)) if a and b else 0.0


def as_text(hashes):
    return "".join(f"{h & (2**64 - 1):016x}" for h in hashes)


def test_against_brute_force(docs, rows):
    own = [(i, t or "") for i, t, _ in rows if i is not None and [r[0] for r in rows].count(i) == 1]
    kept = docs.filter(docs.doc_id.isin([i for i, _ in own]))
    got = {r["doc_id"]: r for r in fingerprints.fingerprints(kept).collect()}
    own.sort()
    assert len(got) == len(own)
    for (i, t), (_, following) in zip(own, own[1:] + own[:1], strict=True):
        k = len(t) // 2
        edited = t[: len(t) - k] + following[:k]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        if all(c.isascii() for c in t + following):  # white space beyond ASCII is split differently by Python
            a, e, n = brute(t), brute(edited), brute(following)
            assert (r["fingerprint"], r["edited_fingerprint"]) == (as_text(a), as_text(e))
            assert abs(r["near_edited"] - brute_near(a, e, t == edited)) < 1e-12 and abs(r["near_next"] - brute_near(a, n, t == following)) < 1e-12


def test_next_by_buckets(spark):
    ids = [3, 9, 11, 12, 40, 41, 42, 43, 90, 100]
    docs = spark.createDataFrame([(i, f"t{i}") for i in ids], "id long, text string")
    for n in (1, 2, 3, 100):
        got = fingerprints.with_next(docs, F.col("id"), F.xxhash64("text"), ["text"], rows_per_bucket=n).collect()
        assert {r["id"]: r["next"]["text"] for r in got} == {a: f"t{b}" for a, b in zip(ids, ids[1:] + ids[:1], strict=True)}


def test_next_of_hot_and_null_ids(spark):
    """An id, and null, that hold a third of the rows each are cut by the hash of the text."""
    rows = [(i, f"t{i}") for i in range(40)] + [(17, f"hot{k}") for k in range(60)] + [(None, f"none{k}") for k in range(60)] + [(None, "none0")] * 3
    docs = spark.createDataFrame(rows, "id long, text string").withColumn("h", F.xxhash64("text"))
    order = sorted(docs.collect(), key=lambda r: (r["id"] is None, r["id"] or 0, r["h"]))
    want = sorted((str(a["id"]), a["text"], b["text"]) for a, b in zip(order, order[1:] + order[:1], strict=True))
    for n in (7, 1000):
        got = fingerprints.with_next(docs, F.col("id"), F.xxhash64("text"), ["text"], rows_per_bucket=n).collect()
        assert sorted((str(r["id"]), r["text"], r["next"]["text"]) for r in got) == want


def test_ranks_among_many_bounds(spark):
    for bounds in (list(range(0, 90_000, 3)), [5], list(range(-200, 200, 2))):
        values = [bounds[0], bounds[0] + 1, bounds[-1], bounds[-1] + 50, *bounds[100:60_000:1711], *(b + 1 for b in bounds[127:60_000:1711])]
        got = spark.createDataFrame([(v,) for v in values], "v long").select("v", fingerprints._rank(F.col("v"), bounds).alias("r")).collect()
        assert [r["r"] for r in got] == [sum(b <= v for b in bounds) - 1 for v in values]


def test_size_and_error_of_sketches(spark):
    """Long sketches take a small share of the text; estimates keep to the error stated."""
    import random

    rng = random.Random(2)
    words = [f"w{k}x{rng.random()}"[:9] for k in range(4000)]
    pairs = []
    for k in range(200):
        n = rng.choice((60, 300, 2000))
        a = rng.sample(words, n)
        pairs.append((k, n, " ".join(a), " ".join(a[: n // 2] + rng.sample(words, n - n // 2))))
    got = spark.createDataFrame(pairs, "k long, n int, a string, b string").select("n", "a", sketch(F.col("a")).alias("s"), containment(sketch(F.col("a")), sketch(F.col("b"))).alias("c")).collect()
    for n, most in ((60, 0.15), (300, 0.15), (2000, 0.08)):
        own = [r for r in got if r["n"] == n]
        assert (sum((r["c"] - 0.5) ** 2 for r in own) / len(own)) ** 0.5 <= most
        assert all(len(r["s"]) >= fingerprints.FLOOR for r in own)
    assert sum(16 * len(r["s"]) for r in got if r["n"] == 2000) < 0.1 * sum(len(r["a"]) for r in got if r["n"] == 2000)


def test_repeated_and_null_ids(docs, rows, spark):
    assert fingerprints.fingerprints(docs).count() == len(rows)
    none = spark.createDataFrame([(None, "a b"), (None, "c d")], "doc_id long, text string")
    assert len(fingerprints.fingerprints(none).collect()) == 2
    one = spark.createDataFrame([(5, "a b c d e f")], "doc_id long, text string").withColumn("next", F.lit(1))
    r = fingerprints.fingerprints(one).first()
    assert r["near_next"] == 1.0 and r["edited_sha256"] == hashlib.sha256(b"a b c a b c"[:6] + b"a b c").hexdigest()


def test_empty(no_docs):
    assert fingerprints.fingerprints(no_docs).collect() == []


def test_sketches_merge_and_estimate_containment(spark):
    import random

    rng = random.Random(1)
    long = [str(rng.random()) for _ in range(6000)]
    short = long[1000:1600]
    row = spark.createDataFrame([(" ".join(long), " ".join(short), " ".join(long[:3000]), " ".join(long[2996:]))], "a string, b string, c string, d string")
    got = row.select(containment(sketch(F.col("a")), sketch(F.col("b"))).alias("x"), (printed(union(sketch(F.col("c")), sketch(F.col("d")))) == printed(sketch(F.col("a")))).alias("same")).first()
    assert got["x"] == 1.0 and got["same"]


def test_main_path_is_native(docs):
    plan = fingerprints.fingerprints(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
