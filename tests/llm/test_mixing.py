import re

import pytest
from pyspark.sql import functions as F

from quern.llm import mixing


def size(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def fill(sizes, weights, cap):
    """Targets by resharing the excess until none is above."""
    total, out, open_ = sum(sizes), [0.0] * len(sizes), list(range(len(sizes)))
    rest = float(total)
    while open_:
        w = sum(weights[i] for i in open_)
        over = [i for i in open_ if rest * weights[i] / w > cap * sizes[i]]
        if not over:
            for i in open_:
                out[i] = rest * weights[i] / w
            break
        for i in over:
            out[i] = float(cap * sizes[i])
        rest -= sum(out[i] for i in over)
        open_ = [i for i in open_ if i not in over]
    return out


def test_contract(docs, rows):
    got = mixing.mix(docs, docs_per_block=4, shards=8).collect()
    assert sorted((r["doc_id"], r["size"]) for r in got if r["doc_id"] is not None) == sorted((i, size(t)) for i, t, _ in rows if i is not None)
    sources = sorted({s for _, _, s in rows if s is not None}) + [None]
    sizes = [sum(size(t) for _, t, s in rows if s == x) for x in sources]
    want = dict(zip(sizes, fill(sizes, [(5, 2, 1)[k % 3] for k in range(len(sources))], 3), strict=True))
    assert len(want) == len(sizes)
    for s in sizes:
        own = [r for r in got if r["source_size"] == s]
        assert all(r["target"] == pytest.approx(want[s]) for r in own)
        assert abs(sum(r["taken"] for r in own) - want[s]) <= 0.5 + 1e-6
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in got)


def test_reruns_and_partitions_agree(docs):
    key = lambda r: str(tuple(r))
    one = sorted(mixing.mix(docs).collect(), key=key)
    assert one == sorted(mixing.mix(docs.repartition(7)).collect(), key=key)


def test_shards_get_equal_blocks_and_every_copy_once(spark):
    rows = [(i, "w " * (i % 7 + 1), f"s{i % 4}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    settings = {"docs_per_block": 5, "shards": 4}
    mixed = mixing.mix(docs, **settings)
    out = mixing.shuffled(docs.withColumn("shard", F.lit("x")), copies_per_slice=30, **settings)
    assert {r["shard"] for r in out.select("shard").distinct().collect()} == {0, 1, 2, 3}
    taken = {r["doc_id"]: r["words"] for r in out.groupBy("doc_id").agg(F.sum("words").alias("words")).collect()}
    assert taken == {r["doc_id"]: r["taken"] for r in mixed.collect() if r["taken"]}
    keyed = mixing.sizes(docs).join(mixing.targets(mixing.sizes(docs), docs_per_block=5).drop("source"), "skey")
    keyed = keyed.withColumn("block", F.col("id") % F.col("n_blocks"))
    dealt = mixing.blocks(keyed, "x", 4).filter("dealt IS NOT NULL").select(F.explode("dealt").alias("shard")).groupBy("shard").count().collect()
    assert max(r["count"] for r in dealt) - min(r["count"] for r in dealt) <= 2


def test_the_mix_of_rows_without_ids_and_of_repeated_rows(docs, rows):
    """Every copy is drawn once for every row, whatever its id; columns of the names made give way, others stay."""
    mixed = mixing.mix(docs, docs_per_block=4, shards=2).collect()
    out = mixing.shuffled(docs, docs_per_block=4, shards=2)
    made = ["size", "source_size", "target", "taken", "shard", "epoch", "words", "place"]
    assert out.columns == [c for c in docs.columns if c not in made] + made
    got = out.collect()
    assert sum(r["words"] for r in got) == sum(r["taken"] for r in mixed)
    assert len(got) == sum(len(r["shards"].split(",")) for r in mixed if r["shards"])
    by_id = lambda rs, c: sorted((str(i), sum(r[c] for r in rs if r["doc_id"] == i)) for i in {r["doc_id"] for r in rs if r[c]})
    assert by_id(got, "words") == by_id(mixed, "taken")
    assert all(r["words"] <= r["size"] and r["text"] is not None for r in got)


def test_a_shard_is_many_slices_in_order(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('w ', id) AS text", "'a' AS source")
    out = mixing.shuffled(docs, docs_per_block=10, shards=2, copies_per_slice=100)
    parts = out.select(F.spark_partition_id().alias("p"), "shard", "place", "doc_id").collect()
    slices = 3000 // 200 + 1
    cut = lambda r: (r["shard"], int(r["place"] / (2.0**60 / slices)))
    assert len({cut(r) for r in parts}) == 2 * slices
    for s in {cut(r) for r in parts}:
        own = [r for r in parts if cut(r) == s]
        assert len({r["p"] for r in own}) == 1 and [r["place"] for r in own] == sorted(r["place"] for r in own)
    order = [r["doc_id"] for r in sorted(parts, key=lambda r: (r["shard"], r["place"]))]
    assert sum(a < b for a, b in zip(order, order[1:], strict=False)) < 0.6 * len(order)
    with pytest.raises(ValueError):
        mixing.mix(docs, shards=12)


def test_places_against_one_window(spark):
    rows = [(k % 3, (k * 7919) % 50 * 2**50 + k % 5, k, k % 4) for k in range(500)]
    df = spark.createDataFrame(rows, "p int, __key long, t int, v int")
    got = {r["t"]: (r["b"], r["all"]) for r in mixing.placed(df, ["p"], ["t"], F.col("v"), "b", "all").collect()}
    for p in range(3):
        own = sorted((k, t, v) for q, k, t, v in rows if q == p)
        for n, (_, t, _) in enumerate(own):
            assert got[t] == (sum(v for _, _, v in own[:n]), sum(v for _, _, v in own))


def test_splits_are_hypergeometric(spark):
    """Means over seeds of a source's blocks that go left: half of them."""
    rows = [(s, b, 1, 0) for s, n in ((0, 12), (1, 4)) for b in range(n)]
    keyed = spark.createDataFrame([(s, b, w, r, 1) for s, b, w, r in rows], "sid int, block long, whole long, rest long, size long")
    left = [mixing.blocks(keyed, f"seed{k}", 2).filter("sid = 1 AND dealt[0] = 0").count() for k in range(12)]
    assert 1.2 < sum(left) / len(left) < 2.8


def test_edges(no_docs, spark):
    assert mixing.mix(no_docs).collect() == []
    nothing = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")
    assert [(r["taken"], r["target"]) for r in mixing.mix(nothing).collect()] == [(0, 0.0), (0, 0.0)]


def test_main_path_is_native(docs):
    plan = mixing.mix(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
