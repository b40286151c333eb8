import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quern.llm import mixing, toxicity
from quern.session import table

from .conftest import frame, words
from .test_decontaminate import brute
from .test_jaccard_join import expected as near
from .test_line_dedup import expected as deduped


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory, rows):
    """A folder of tables: the common corpus, toxic documents with labels, and benchmark passages."""
    rng = random.Random(12)
    folder = str(tmp_path_factory.mktemp("sf"))
    seen = set()
    own = [r for r in rows if r[0] is None or not (r[0] in seen or seen.add(r[0]))]  # an id has one text here
    labels, items = [], [(k, words(rng, 20)) for k in range(6)]
    for k in range(240):
        w = words(rng, rng.randint(20, 60)).split()
        bad = k % 3 == 0
        for _ in range(6 * bad):
            w[rng.randrange(len(w))] = rng.choice(["zzyqvur", "wwxztok"])
        if k % 40 == 1:
            w[5:5] = items[k % 6][1].split()[2:16]
        own.append((1000 + k, " ".join(w), f"s{k % 4}"))
        labels.append((1000 + k, int(bad)))
    frame(spark, own).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, own, dict(labels), items


@pytest.fixture(scope="module")
def staged(spark, world):
    """(name, input, output) of each stage."""
    folder, out = world[0], []
    docs = table(spark, folder, "documents")
    for name, stage in corpus_pipeline.STAGES:
        made = corpus_pipeline.written(stage(spark, docs, folder), "test")
        out.append((name, docs, made))
        docs = made
    return out


def triples(df):
    return [(r["doc_id"], r["text"], r["source"]) for r in df.collect()]


def key(r):
    return str(r)


def test_stages_and_columns(staged):
    assert [n for n, _, _ in staged] == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "mixing"]
    for _, before, after in staged[:-1]:
        assert after.columns == before.columns and after.dtypes == before.dtypes
        assert 0 < after.count() < before.count()


def test_toxicity(spark, staged, world):
    _, before, after = staged[0]
    scored = {r["doc_id"]: r["predicted"] for r in toxicity.score(before, toxicity.train(before, table(spark, world[0], "labels"))).collect()}
    kept = {r["doc_id"] for r in after.collect()}
    assert kept == {i for i, p in scored.items() if not p}
    assert sum((i in kept) == (not y) for i, y in world[2].items()) > 0.97 * len(world[2])


def test_line_dedup(staged):
    _, before, after = staged[1]
    want = [(i, t) for i, t, n, gone in deduped(triples(before), 8) if not gone or gone < n]
    assert sorted(((i, t) for i, t, _ in triples(after)), key=key) == sorted(want, key=key)
    assert after.filter("text IS NOT NULL AND n_chars != char_length(text)").count() == 0


def test_near_duplicates(staged):
    _, before, after = staged[2]
    rows = triples(before)
    want = {i for i, least, *_ in near(rows) if i is not None and i == least}
    assert {i for i, _, _ in triples(after) if i is not None} == want


def test_decontamination(staged, world):
    _, before, after = staged[3]
    want = [r for r in triples(before) if not brute(r[1], world[3], 10)[1]]
    assert sorted(triples(after), key=key) == sorted(want, key=key)


def test_mixing_and_run(spark, staged, world):
    """The mix drawn is the one planned: every copy once, with its document, and sources near their targets."""
    _, before, after = staged[4]
    plan = [r for r in mixing.mix(before).collect() if r["taken"]]
    drawn = after.collect()
    assert set(before.columns) <= set(after.columns)
    words = Counter()
    for r in drawn:
        words[r["doc_id"]] += r["words"]
    taken = Counter()
    for r in plan:
        taken[r["doc_id"]] += r["taken"]
    assert words == taken and len(drawn) == sum(len(r["shards"].split(",")) for r in plan)
    texts = {(r["doc_id"], r["text"], r["source"]) for r in before.collect()}
    assert all((r["doc_id"], r["text"], r["source"]) in texts for r in drawn)
    sources = {(r["source"], r["target"]) for r in drawn}
    assert all(abs(sum(r["words"] for r in drawn if r["source"] == s) - t) <= 1 for s, t in sources)
    whole = corpus_pipeline.run(spark, world[0])
    assert sorted(map(str, whole.collect())) == sorted(map(str, drawn))


def test_empty_tables(spark, tmp_path, no_docs):
    folder = str(tmp_path)
    no_docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_sql_is_none_or_text():
    assert corpus_pipeline.ORACLE_SQL is None
