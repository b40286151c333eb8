"""Properties of the nested transforms and of packing, on generated input."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quern.operators import generate, nested, packing

SLOW = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
PAIRS = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 3)), max_size=12)


def column(spark, rows):
    return spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "k int, xs array<struct<t:string,n:int>>")


@SLOW
@given(rows=st.lists(PAIRS, min_size=1, max_size=15))
def test_dedupe_keeps_first_and_is_idempotent(spark, rows):
    once = lambda c: nested.dedupe(c, lambda x: x["t"])
    got = column(spark, rows).select("k", once(F.col("xs")).alias("a"), once(once(F.col("xs"))).alias("b")).collect()
    for r in got:
        want = list({t: (t, n) for t, n in reversed(rows[r["k"]])}.values())
        assert sorted(map(str, map(tuple, r["a"]))) == sorted(map(str, want)) and r["a"] == r["b"]


@SLOW
@given(rows=st.lists(PAIRS, min_size=1, max_size=15), cap=st.integers(1, 4))
def test_cap_keeps_the_first_of_each(spark, rows, cap):
    for r in column(spark, rows).select("k", nested.cap_per_key(F.col("xs"), lambda x: x["t"], cap).alias("a")).collect():
        seen, want = {}, []
        for t, n in rows[r["k"]]:
            seen[t] = seen.get(t, 0) + 1
            want += [(t, n)] if seen[t] <= cap else []
        assert list(map(tuple, r["a"])) == want


@SLOW
@given(rows=st.lists(st.lists(st.integers(0, 9), max_size=10), min_size=1, max_size=15), budget=st.integers(1, 6))
def test_plans_hold_every_element_once_within_budget(spark, rows, budget):
    df = spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "k int, sizes array<int>")
    for r in df.select("k", packing.chunk_plan(F.col("sizes"), budget).alias("p")).collect():
        sizes = rows[r["k"]]
        by_chunk, by_group = {}, {}
        for x in r["p"]:
            by_chunk[x["chunk"]] = by_chunk.get(x["chunk"], 0) + x["n"]
            by_group[x["group"]] = by_group.get(x["group"], 0) + x["n"]
        assert all(n <= budget for n in by_chunk.values()) and [by_group.get(g, 0) for g in range(len(sizes))] == sizes
        groups = [{"g": g, "meanings": list(range(n))} for g, n in enumerate(sizes)]
        assert len(by_chunk) == len(generate.chunks(groups, budget))
