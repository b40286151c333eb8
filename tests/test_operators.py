import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F

from quern.functions import canonical, ids, text
from quern.operators import audit, export, generate, latest, merge, packing, sampling, selection, validate
from quern.operators.generate import Attempts, Bundle, Reply
from quern.operators.validate import Invalid

TARGETS = [{"pos_group_id": "noun|et1", "pos": "noun", "sense_ids": ["s1", "s2"]}, {"pos_group_id": "verb|et1", "pos": "verb", "sense_ids": ["s1"]}]


def meaning(i, **more):
    return {"sense_id": i, "priority": " Core ", "short_gloss": "", "learner_explanation": "long enough text", "usage_note": ["a", " b "], "examples": None} | more


def answer(**more):
    groups = [{"pos_group_id": "verb|et1", "pos": "odd", "summary": "s", "usage_note": None, "meanings": [meaning("s1")]}, {"pos_group_id": "noun|et1", "pos": "noun", "summary": "s", "usage_note": "", "meanings": [meaning("s2"), meaning("s1")]}]
    return {"headword_summary": "h", "memory_hook": "m", "study_notes": None, "etymology_note": " ", "pos_groups": groups} | more


def test_response_is_aligned():
    got = validate.response(answer(), TARGETS)
    assert [g["pos_group_id"] for g in got["pos_groups"]] == ["noun|et1", "verb|et1"] and got["pos_groups"][1]["pos"] == "verb"
    m = got["pos_groups"][0]["meanings"]
    assert [x["sense_id"] for x in m] == ["s1", "s2"] and m[0]["priority"] == "core" and m[0]["usage_note"] == "a b" and m[0]["short_gloss"] is None and m[0]["examples"] == []
    assert got["study_notes"] == [] and got["etymology_note"] is None


def broken(change):
    x = answer()
    change(x)
    return x


@pytest.mark.parametrize("change", [
    lambda x: x.pop("memory_hook"), lambda x: x.update(headword_summary=" "), lambda x: x.update(study_notes=[1]), lambda x: x.update(memory_hook="a�"),
    lambda x: x["pos_groups"].pop(), lambda x: x["pos_groups"].append(x["pos_groups"][0]), lambda x: x["pos_groups"][0].update(pos_group_id="other"),
    lambda x: x["pos_groups"][0]["meanings"].clear(), lambda x: x["pos_groups"][0]["meanings"][0].update(priority="top"), lambda x: x["pos_groups"][0]["meanings"][0].update(sense_id="s9"),
    lambda x: x["pos_groups"][1]["meanings"].append(meaning("s1")), lambda x: x["pos_groups"][0]["meanings"][0].update(examples=[{"text": "a"}]), lambda x: x["pos_groups"][0]["meanings"][0].update(learner_explanation=None),
])
def test_faulty_responses(change):
    with pytest.raises(Invalid):
        validate.response(broken(change), TARGETS)


def test_overview_and_review():
    fields = {k: v for k, v in answer().items() if k != "pos_groups"}
    pair = {"pos_group_id": "noun|et1", "sense_id": "s1"}
    assert validate.overview(fields | {"core_senses": [pair, pair]}, TARGETS)["core_senses"] == [pair]
    for bad in ([], [{"pos_group_id": "noun|et1", "sense_id": "s7"}], [{}], "x"):
        with pytest.raises(Invalid):
            validate.overview(fields | {"core_senses": bad}, TARGETS)
    review = {"scores": dict.fromkeys(validate.SCORE_FIELDS, 5), "priority_ok": True, "verdict": " PASS", "issues": [{"kind": "odd", "note": "n"}]}
    assert validate.review(review) | {} == {"scores": review["scores"], "priority_ok": True, "verdict": "pass", "issues": [{"kind": "other", "location": "", "note": "n"}]}
    for change in ({"scores": review["scores"] | {"accuracy": True}}, {"scores": review["scores"] | {"accuracy": 6}}, {"verdict": "x"}, {"priority_ok": 1}, {"issues": [{"kind": "other"}]}):
        with pytest.raises(Invalid):
            validate.review(review | change)


def test_validated_column(spark):
    df = spark.createDataFrame([(canonical.dumps(answer()),), ("{bad",), (None,)], "p string").withColumn("t", F.lit(canonical.dumps(TARGETS)))
    got = [r["v"]["ok"] for r in df.select(validate.validated(validate.response, F.col("p"), F.col("t")).alias("v")).collect()]
    assert got == [True, False, False]


def test_chunks_and_plan(spark):
    groups = [{"pos_group_id": g, "pos": g, "meanings": [{"sense_id": f"s{i}"} for i in range(n)]} for g, n in (("v", 90), ("n", 10))]
    assert [sum(len(g["meanings"]) for g in c) for c in generate.chunks(groups, 40)] == [40, 40, 10, 10]
    rng = random.Random(1)
    rows = [[rng.randint(0, 12) for _ in range(rng.randint(0, 8))] for _ in range(60)]
    df = spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "k int, sizes array<int>")
    for r in df.select("k", packing.chunk_plan(F.col("sizes"), 5).alias("p")).collect():
        want = generate.chunks([{"g": g, "meanings": [(g, i) for i in range(n)]} for g, n in enumerate(rows[r["k"]])], 5)
        flat = [(c, g["g"], len(g["meanings"])) for c, part in enumerate(want, 1) for g in part]
        assert [(x["chunk"], x["group"], x["n"]) for x in r["p"]] == flat
    assert df.limit(1).select(packing.chunk_of_each(F.array(*[F.lit(x) for x in (3, 2, 4, 1, 5)]), 5).alias("c")).first()["c"] == [1, 1, 2, 2, 3]
    with pytest.raises(ValueError):
        generate.chunks(groups, 0)


def test_core_pairs_are_by_group():
    part = [[{"pos_group_id": g, "pos": "x", "meanings": [{"sense_id": "s1", "priority": "core"}]} for g in ("a", "b")]]
    fields = {k: None for k in validate.ENTRY_FIELDS}
    got = generate.assemble(fields, part, [{"pos_group_id": "b"}, {"pos_group_id": "a"}], [{"pos_group_id": "a", "sense_id": "s1"}])
    assert [(g["pos_group_id"], g["meanings"][0]["priority"]) for g in got["pos_groups"]] == [("b", "common"), ("a", "core")]
    with pytest.raises(Invalid):
        generate.assemble(fields, part, [{"pos_group_id": "c"}], None)


def test_retries():
    seen, pauses = [], []

    def bad(kind, prompt, payload, temperature, tokens):
        seen.append((temperature, tokens))
        return Reply("{}")

    call = Attempts(bad, Bundle("v", "c", "n"), 3, pauses.append)
    with pytest.raises(Invalid):
        call("entry", "{}", lambda x: validate.response(x, TARGETS))
    assert seen == [(0.0, 16000), (0.3, 16000), (0.0, 8000)] and pauses == [0.5, 1.0]


def test_ids(spark):
    words = ["a", "Straße", "漢字", "", "x y"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    assert [r[0] for r in df.select(ids.entry_id(F.lit("en"), F.col("w"))).collect()] == [str(uuid.uuid5(uuid.NAMESPACE_URL, f"en|{w}")) for w in words]
    assert df.limit(1).select(ids.group_id(F.lit(" "), F.lit("et1"))).first()[0] == "_|et1"


def test_text_rules(spark):
    df = spark.createDataFrame([("　 a \x1c",), ("Straße ΟΔΟΣ",), ("  ",)], "t string")
    got = df.select(text.strip_or_null(F.col("t")), text.casefold(F.col("t")), text.grouping_key(F.col("t"))).collect()
    assert got[0][0] == "a" and got[1][1] == "strasse οδοσ" and "ß" in got[1][2] and got[2][0] is None and got[2][1] is None
    assert df.limit(1).select(text.version_suffix(F.lit("zh Hans/x")), text.file_name(F.lit("http://a/b/c.gz?q=1"))).first()[:] == ("zh_Hans_x", "c.gz")
    lists = spark.createDataFrame([([" a", "b", "a ", "", None],)], "x array<string>")
    assert lists.select(text.text_list(F.col("x")), text.first_text(F.col("x")), text.joined_text(F.col("x"))).first()[:] == (["a", "b"], "a", "a b a")
    assert text.dotted("a. b") == ("a", "b") and text.language(" a", "b ") == {"code": "a", "name": "b"}
    for bad in (lambda: text.dotted("a."), lambda: text.language(" ", "x")):
        with pytest.raises(ValueError):
            bad()


def test_canonical_json(spark):
    df = spark.createDataFrame([(1, "é")], "b long, a string").select(F.struct("b", "a", F.lit(None).cast("string").alias("n"), F.array(F.struct(F.lit(None).cast("string").alias("x"), F.lit(1).alias("y"))).alias("meanings")).alias("s"))
    made = canonical.with_canonical(df, j=F.col("s")).first()["j"]
    assert made == '{"a": "é", "b": 1, "meanings": [{"x": null, "y": 1}], "n": null}'
    assert canonical.with_canonical(df, drop_nulls_in="meanings", compact=True, j=F.col("s")).first()["j"] == '{"a":"é","b":1,"meanings":[{"y":1}],"n":null}'


def population(spark):
    rows = [(f"w{i}", f"word{i}", [], 1) for i in range(900)] + [(f"p{i}", "two words", [], 3) for i in range(90)] + [(f"g{i}", "giant", [], 99) for i in range(10)]
    return spark.createDataFrame(rows, "entry_id string, word string, flags array<string>, n int").withColumn("stratum", sampling.stratum(F.col("word"), F.col("flags"), F.col("n")))


def test_stratified_sample(spark):
    pop = population(spark)
    one = {(r["entry_id"], r["sampling_weight"]) for r in sampling.stratified(pop, 200, "s").collect()}
    assert one == {(r["entry_id"], r["sampling_weight"]) for r in sampling.stratified(pop.orderBy(F.rand(3)).repartition(5), 200, "s").collect()}
    assert sum(w for _, w in one) == pytest.approx(1000)
    giants = [w for i, w in one if i[0] == "g"]
    assert len(giants) == 10 and set(giants) == {1.0} and sum(i[0] == "p" for i, _ in one) >= 25
    assert one != {(r["entry_id"], r["sampling_weight"]) for r in sampling.stratified(pop, 200, "t").collect()}


def test_kinds_and_bands(spark):
    rows = [("DNS", ["entry_type:proper_name"], 1), ("-ness", ["entry_type:affix"], 9), ("a b", [], 10), ("R&D", [], 28), ("cat", [], 29)]
    df = spark.createDataFrame(rows, "w string, f array<string>, n int")
    assert [r[0] for r in df.select(sampling.stratum(F.col("w"), F.col("f"), F.col("n"))).collect()] == ["proper_name|1", "affix_or_proverb|2-9", "phrase|10-28", "abbreviation|10-28", "word|sharded"]


def test_two_phase_sampler(spark):
    df = spark.createDataFrame([(i, f"s{i % 3}", f"b{i % 11}") for i in range(200)], "id int, sig string, bucket string")
    got = [r["id"] for r in sampling.two_phase(df, "id", "sig", "bucket", 50, 20, 10, 9, F.md5(F.col("id").cast("string"))).collect()]
    assert len(got) == len(set(got)) == 50


def test_selection(spark):
    freq = spark.createDataFrame([("a", 5.0), ("b", 3.0), ("c", 1.0)], "token string, zipf double")
    assert selection.threshold(freq, 2) == 3.0
    for n in (0, 4):
        with pytest.raises(ValueError):
            selection.threshold(freq, n)
    words = spark.createDataFrame([("A",), ("a b",), ("a d",), ("c",), (" ",)], "word string")
    assert sorted(r["word"] for r in selection.selected(words, freq, 3.0, 2.9).collect()) == ["A", "a b"]
    assert sorted(r["word"] for r in selection.selected(words, freq, 3.0).collect()) == ["A"]


def test_latest_and_preference(spark):
    at = dt.datetime(2024, 1, 1)
    log = spark.createDataFrame([("e1", "h1", 1, "succeeded", at), ("e1", "h1", 2, "succeeded", at), ("e1", "h2", 3, "succeeded", at), ("e2", "h9", 4, "succeeded", at), ("e3", "h3", 5, "failed", at)], "entry_id string, input_hash string, enrichment_id int, status string, created_at timestamp")
    assert {r["entry_id"]: r["enrichment_id"] for r in latest.latest_enrichments(log).collect()} == {"e1": 3, "e2": 4}
    wanted = spark.createDataFrame([("e1", "h1", 0), ("e1", "h2", 1), ("e2", "h2", 0), ("e3", "h3", 0)], "entry_id string, input_hash string, preference int")
    assert {r["entry_id"]: r["enrichment_id"] for r in latest.preferred(wanted, log).collect()} == {"e1": 2, "e2": None, "e3": None}
    assert sorted(r["entry_id"] for r in latest.pending(wanted.select("entry_id", "input_hash"), log.filter("status = 'succeeded'"), ["entry_id", "input_hash"]).collect()) == ["e2", "e3"]


def test_merges(spark, tmp_path):
    t = merge.VersionedTable(spark, str(tmp_path / "t"), "k int, v string")
    assert t.read().count() == 0
    rows = lambda *x: spark.createDataFrame(list(x), "k int, v string")
    t.append(rows((1, "a"), (2, "b")))
    t.upsert(rows((2, "c"), (3, "d")), ["k"])
    t.append(rows((4, "e")))
    assert sorted(map(tuple, t.read().collect())) == [(1, "a"), (2, "c"), (3, "d"), (4, "e")]
    t.write(merge.replaced(t.read(), rows((1, ""), (4, "")), rows((1, "x")), ["k"]))
    t.write(merge.inserted(t.read(), rows((1, "no"), (9, "yes"), (9, "yes")), ["k"]))
    assert sorted(map(tuple, t.read().collect())) == [(1, "x"), (2, "c"), (3, "d"), (9, "yes")]
    assert merge.deleted(rows((1, "a"), (None, "b")), rows((1, ""), (None, "")), ["k"]).collect()[0]["v"] == "b"
    t.truncate()
    assert t.read().count() == 0


def test_findings(spark):
    long = "a long explanation"
    x = answer(memory_hook="same", headword_summary="same ")
    for g in x["pos_groups"]:
        for m in g["meanings"]:
            m.update(priority="core", learner_explanation=long, usage_note=None, examples=[{"text": "a", "translation": "b"}])
    x["pos_groups"][0]["meanings"][0].update(learner_explanation="short", examples=[], usage_note="表示 something")
    x["pos_groups"][1]["meanings"][0].update(usage_note="表示“be doing”")
    x["pos_groups"][1]["meanings"] += [meaning(f"s{i}", priority="core", learner_explanation=long, usage_note=None, examples=[{"text": "a", "translation": "b"}]) for i in range(3, 7)]
    x["study_notes"] = ["这个 idea"]
    log = spark.createDataFrame([("e", "succeeded", canonical.dumps(x))], "entry_id string, status string, response_payload string")
    got = sorted(r["check"] for r in audit.audited(log).collect())
    assert got == ["core_over_budget", "hook_equals_summary", "missing_example", "mixed_language", "restate_style_usage_note", "short_explanation"]


def test_picks(spark):
    p = [("/a/", None, ["x"]), (None, "t", ["US"]), ("/us/", None, ["General-American"]), ("/uk/", None, ["UK"])]
    df = spark.createDataFrame([(0, p), (1, p[:2]), (2, []), (3, p[1:2])], "k int, p array<struct<ipa:string,pronunciation_text:string,tags:array<string>>>")
    got = {r["k"]: [(x["ipa"], x["text"], x["tags"]) for x in r["q"]] for r in df.select("k", export.picked_pronunciations(F.col("p")).alias("q")).collect()}
    assert got == {0: [("/us/", None, ["US"]), ("/uk/", None, ["UK"])], 1: [("/a/", None, [])], 2: [], 3: [(None, "t", [])]}


def test_log_health_and_newest_failures(spark):
    from quern.operators import audit

    meta = '{"sharded": true, "used_compact_retry_prompt": true, "usage": {"prompt_tokens": 10, "completion_tokens": 4}}'
    rows = [(f"{(7 * k) % 25:02d}", f"e{k}", "failed" if k % 2 else "succeeded", 1, meta if k < 10 else "{}", "bad", k) for k in range(25)]
    log = spark.createDataFrame(rows, "enrichment_id string, entry_id string, status string, retries int, generation_metadata string, error string, at int")
    log = log.selectExpr("*", "timestamp_seconds(at) AS created_at").repartition(4)
    got = audit.log_health(log, 10)
    assert [tuple(r) for r in got.collect()] == [(0, 5, 5, 10, 10, 10, 10.0, 4.0), (1, 5, 5, 10, 0, 0, None, None), (2, 3, 2, 5, 0, 0, None, None)]
    assert tuple(audit.log_totals(got).first()) == (13, 12, 25, 10)
    assert [r["entry_id"] for r in audit.recent_failures(log, by=("created_at", "enrichment_id")).collect()] == [f"e{k}" for k in range(23, 4, -2)]


def test_large_rows_are_turned_into_objects_alone():
    """Batches are cut by bytes: a row over the bound is alone, order and rows stay."""
    import pyarrow as pa

    from quern.functions.canonical import pieces

    texts = ["x" * n for n in (1, 2, 5000, 3, 4000, 1, 1, 1, 1, 1)]
    got = [b.column("t").to_pylist() for b in pieces([pa.RecordBatch.from_arrays([pa.array(texts)], names=["t"])], 1000)]
    assert [t for part in got for t in part] == texts and all(len(p) == 1 or sum(map(len, p)) < 1000 for p in got)


def test_elements_in_place_are_those_by_id(spark):
    """Also where ids repeat or are out of order."""
    from pyspark.sql import functions as F

    from quern.operators import export

    rows = [(k, [(i, f"{i}{n}") for n, i in enumerate(ids)]) for k, ids in enumerate(("abc", "cba", "abca", "cabcc", "aabc"))]
    df = spark.createDataFrame(rows, "k int, m array<struct<id:string,v:string>>")
    keys = F.array(*[F.lit(x) for x in "abc"])
    fast = F.transform(keys, lambda x, i: export.in_place(F.col("m"), "id", x, i, export.distinct_ids(F.col("m"), "id"))["v"])
    plain = F.transform(keys, lambda x: export.by_id(F.col("m"), "id", x)["v"])
    got = df.select("k", fast.alias("fast"), plain.alias("plain")).collect()
    assert all(r["fast"] == r["plain"] for r in got) and len(got) == 5
