import json
import sqlite3

import pytest

from quern import cli
from quern.operators import export, validate
from quern.operators.generate import Bundle, Reply, fake_generator
from quern.plans import stages
from quern.plans.registry import Registry
from quern.schemas import ENTRY, TRIAGE

BUNDLE = Bundle("v1", "zh-Hans", "Chinese (Simplified)")


def noun(word, n=1, **more):
    return {"word": word, "lang": "English", "lang_code": "en", "pos": "noun", "senses": [{"glosses": [f"gloss {word} {i}"]} for i in range(n)]} | more


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("store")
    records = [noun("cat", sounds=[{"ipa": "/k/", "tags": ["US"]}], synonyms=["puss"], forms=[{"form": "cats", "tags": ["plural"]}]), noun("Cat", pos="name"), noun("set", 31), noun("cats", senses=[{"glosses": ["plural of cat"], "form_of": ["cat"]}]), noun("x", pos="symbol")]
    path = folder / "a.jsonl"
    path.write_text("".join(json.dumps(r) + "\n" for r in records) + "{bad\n")
    registry = Registry(spark, str(folder / "db"))
    out = stages.workflow(registry, str(path), BUNDLE, str(folder / "out"), tiers=(2, 1))
    return registry, folder, path, out


def test_workflow(built):
    registry, folder, _, out = built
    assert (out["ingest"]["rows"], out["ingest"]["anomalies"], out["ingest"]["last_line"]) == (5, 1, 6)
    assert out["assemble"] == {"run_id": out["assemble"]["run_id"], "entries": 2, "relations": 1, "triage": 2}
    assert out["generate"]["succeeded"] == 2 and out["distribution"]["documents"] == 2
    runs = {(r["stage"], r["status"]) for r in registry.table("runs").read().collect()}
    assert {s for _, s in runs} == {"succeeded"} and ("workflow.run", "succeeded") in runs


def test_documents_validate(built, spark):
    _, folder, _, out = built
    lines = (folder / "out/distribution.jsonl").read_text().splitlines()
    docs = [validate.document(json.loads(x)) for x in lines]
    assert [d["normalized_headword"] for d in docs] == ["cat", "set"]
    assert docs[0]["entry_type"] == "standard" and docs[0]["pos_groups"][0]["pos"] == "name" and docs[0]["pos_groups"][0]["proper_name"]
    core = [m["sense_id"] for m in docs[1]["pos_groups"][0]["meanings"] if m["priority"] == "core"]
    assert len(docs[1]["pos_groups"][0]["meanings"]) == 31 and core == ["s1"]
    assert export.check_jsonl(spark, str(folder / "out/distribution.jsonl")) == 2
    bad = folder / "bad.jsonl"
    bad.write_text(lines[0] + "\n\n" + json.dumps(json.loads(lines[1]) | {"model": "x"}) + "\n")
    with pytest.raises(ValueError, match=r"bad.jsonl:3: "):
        export.check_jsonl(spark, str(bad))


@pytest.mark.parametrize("change", [
    {"schema_version": "v4"}, {"entry_type": "odd"}, {"headword": ""}, {"curated": 1}, {"pos_groups": "x"}, {"definition_language": {"code": "a"}}, {"study_notes": None},
])
def test_faulty_documents(built, change):
    _, folder, _, _ = built
    doc = json.loads((folder / "out/distribution.jsonl").read_text().splitlines()[0])
    with pytest.raises(validate.Invalid):
        validate.document(doc | change)


@pytest.mark.parametrize("change", [
    lambda g: g.update(pos_group_id="x"), lambda g: g.update(proper_name=1), lambda g: g.update(meanings=[]), lambda g: g["meanings"].append(g["meanings"][0]), lambda g: g["meanings"][0].update(citations=[]),
    lambda g: g["meanings"][0].update(priority="top"), lambda g: g["pronunciations"].append({"ipa": None, "text": " ", "tags": []}), lambda g: g["relations"].append({"type": "form_of", "word": "x"}),
    lambda g: g["pronunciations"].append({"ipa": "x", "tags": [], "audio_url": "u"}), lambda g: g["forms"].append({"text": "x", "tags": "y"}),
])
def test_faulty_groups(built, change):
    _, folder, _, _ = built
    doc = json.loads((folder / "out/distribution.jsonl").read_text().splitlines()[0])
    change(doc["pos_groups"][0])
    with pytest.raises(validate.Invalid):
        validate.document(doc)


def test_sqlite(built):
    _, folder, _, _ = built
    db = sqlite3.connect(folder / "out/distribution.sqlite")
    count = lambda t: db.execute(f"SELECT count(*) FROM {t}").fetchone()[0]
    assert [count(t) for t in ("entries", "pos_groups", "meanings", "meaning_examples", "pos_group_forms", "pos_group_relations", "pos_group_pronunciations")] == [2, 3, 33, 33, 1, 1, 1]
    assert db.execute("SELECT max(meaning_index), min(meaning_index) FROM meanings").fetchone() == (31, 1)
    assert db.execute("PRAGMA user_version").fetchone()[0] == 1
    doc = json.loads(db.execute("SELECT document_json FROM entries WHERE headword = 'set'").fetchone()[0])
    assert validate.document(doc)["headword"] == "set"


def test_reruns_change_nothing(built):
    registry, _, path, out = built
    again = stages.ingest(registry, str(path))
    assert (again["rows"], again["anomalies"]) == (5, 1)
    assert stages.assemble(registry)["triage"] == 2 and registry.table("entries", ENTRY).read().count() == 2
    assert stages.generate_definitions(registry, BUNDLE) | {"run_id": 0} == {"run_id": 0, "succeeded": 0, "failed": 0}
    assert stages.pending_count(registry, BUNDLE) == 0 and stages.pending_count(registry, Bundle("v2", "zh-Hans", "Chinese (Simplified)")) == 2
    assert registry.init() is False
    codes = sorted(r["reason_code"] for r in registry.table("triage", TRIAGE).read().collect())
    assert codes == ["derived_form_entry", "record_type_out_of_scope"]


def test_ingest_resumes_and_checks(built, tmp_path, spark):
    registry = Registry(spark, str(tmp_path / "db"))
    path = tmp_path / "b.jsonl"
    path.write_text('{"word": "a"}\n')
    first = stages.ingest(registry, str(path))
    assert registry.resumable("source.ingest", first["snapshot_id"]) is None  # the run has ended well
    raw = registry.table("raw")
    raw.append(raw.read().selectExpr("* EXCEPT (source_line)", "source_line + 7 AS source_line"))
    with pytest.raises(RuntimeError, match="checkpoint says"):
        stages.ingest(registry, str(path))
    failed = registry.table("runs").read().filter("status = 'failed'").collect()
    assert len(failed) == 1 and "RuntimeError" in failed[0]["error"]
    with pytest.raises(ValueError):
        registry.start("odd", {})


def test_stale_hash_is_skipped(built):
    registry, folder, _, _ = built
    other = Bundle("v9", "zh-Hans", "Chinese (Simplified)")
    out = stages.export_distribution(registry, [other], str(folder / "none.jsonl"))
    assert out["documents"] == 0 and out["skipped_unenriched"] == 2
    out = stages.export_distribution(registry, [other, BUNDLE], str(folder / "both.jsonl"))
    assert out["documents"] == 2


def test_failures_and_audit(built):
    registry, _, _, _ = built

    def broken(kind, prompt, payload, temperature, tokens):
        return Reply("not json") if '"set"' in payload else fake_generator(kind, prompt, payload, temperature, tokens)

    out = stages.generate_definitions(registry, Bundle("v3", "fr", "French"), broken, max_retries=2, pause=lambda s: None)
    assert (out["succeeded"], out["failed"]) == (1, 1)
    reports = stages.audit_definitions(registry)
    assert len(reports["failures"].collect()) == 1 and {r["check"] for r in reports["finding_counts"].collect()} <= {"short_explanation", "mixed_language"}


def test_reviews_resume(built):
    registry, _, _, _ = built
    assert stages.review(registry, size=50)["reviews"] == 2
    assert stages.review(registry, size=50)["reviews"] == 0
    assert stages.review(registry, size=50, seed="other")["reviews"] == 2


def test_audit_export(built):
    registry, folder, _, _ = built
    stages.assemble(registry)
    rows = [json.loads(x) for x in (folder / "out/audit.jsonl").read_text().splitlines()]
    assert [r["entries"]["normalized_word"] for r in rows] == ["cat", "set"] and all(r["definitions"]["response_payload"] for r in rows)


def test_install_is_atomic(tmp_path):
    target = tmp_path / "x"
    target.write_text("old")

    def fail(part):
        open(part, "w").write("half")
        raise RuntimeError

    with pytest.raises(RuntimeError):
        export.install(str(target), fail)
    assert target.read_text() == "old" and not (tmp_path / "x.part").exists()
    with pytest.raises(IsADirectoryError):
        export.install(str(tmp_path), fail)
    with pytest.raises(FileExistsError):
        export.install(str(target), fail, overwrite=False)


def test_cli(spark, tmp_path, capsys):
    (tmp_path / "a.jsonl").write_text(json.dumps(noun("cat")) + "\n")
    store = ["--store", str(tmp_path / "s")]
    for args in (["init-db"], ["ingest-snapshot", str(tmp_path / "a.jsonl")], ["assemble-entries", "--lang", "en"], ["generate-definitions"], ["export-distribution", str(tmp_path / "d.jsonl")], ["validate-distribution", str(tmp_path / "d.jsonl")]):
        assert cli.main([*store, *args]) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1]) == {"documents": 1}


def test_limits(built, spark):
    from quern.operators import curate, selection

    registry, _, _, _ = built
    rows = registry.table("raw").read()
    assert [r["normalized_word"] for r in curate.curate(rows, limit_groups=1).entries.collect()] == ["cat"]
    out = stages.generate_definitions(registry, Bundle("v7", "de", "German"), limit=1)
    assert (out["succeeded"], stages.pending_count(registry, Bundle("v7", "de", "German"))) == (1, 1)
    freq = spark.createDataFrame([("cat", 4.0), ("set", 2.0)], "token string, zipf double")
    rule = selection.Rule("en", "v1", 3.0)
    heads = rule.apply(curate.grouped_scan(rows), freq)
    assert [r["normalized_word"] for r in curate.curate(rows, selected=heads).entries.collect()] == ["cat"] and rule.metadata()["min_zipf"] == 3.0


def test_cancel(spark, tmp_path):
    registry = Registry(spark, str(tmp_path))
    run = registry.start("entries.assemble", {"a": 1})
    registry.update_config(run, {"b": 2})
    registry.cancel(run)
    row = registry.table("runs").read().first()
    assert row["status"] == "cancelled" and json.loads(row["config"]) == {"a": 1, "b": 2}
    with pytest.raises(KeyError):
        registry.complete("none", {})


def test_fixture_builder(spark, tmp_path):
    from quern.plans import fixture

    path = tmp_path / "d.jsonl"
    records = [noun(f"w{i}", pos=("noun", "verb", "adj")[i % 3], forms=[{"form": "f"}] * (i % 2), categories=["c"] * (i % 5)) for i in range(90)]
    path.write_text("".join(json.dumps(r) + "\n" for r in records))
    chosen, summaries = fixture.build(spark, str(path), limit=20, per_bucket=12, pool=5, quota=8)
    got = chosen.collect()
    assert len({r["source_line"] for r in got}) == len(got) == 20 and len({r["bucket"] for r in got}) == 3
    assert [r["source_line"] for r in got] == sorted(r["source_line"] for r in got)
    assert sum(r["count"] for r in summaries["bucket"].collect()) == 90
    assert {r["signature"] for r in summaries["signature"].collect()} == {"senses", "senses+categories", "senses+forms", "senses+forms+categories"}
    path.write_text("{bad\n")
    with pytest.raises(ValueError, match="d.jsonl:1"):
        fixture.build(spark, str(path))


def test_audit_reports_every_row_by_prompt_version(built):
    registry, _, _, _ = built
    n = registry.table("enrichments").read().count()
    reports = stages.audit_definitions(registry, bucket_size=2)
    assert sum(sum(r[k] for k in ("succeeded", "failed")) for r in reports["buckets"].collect()) == n
    assert stages.audit_definitions(registry, version_like="none%")["totals"].first()["succeeded"] == 0
    assert all(r["avg_prompt_tokens"] > 0 for r in reports["buckets"].collect() if r["succeeded"])


def lines_of(folder, n=9):
    path = folder / "k.jsonl"
    path.write_text("".join("{bad\n" if k % 4 == 3 else "\n" if k % 4 == 2 else json.dumps(noun(f"w{k}")) + "\n" for k in range(n)))
    return str(path)


@pytest.mark.parametrize("commits", [0, 1, 2, 3])
def test_an_ingest_that_dies_goes_on(spark, tmp_path, monkeypatch, commits):
    """Killed before its commits or after some of them, a rerun ends with every line once."""
    registry, path = Registry(spark, str(tmp_path / "db")), lines_of(tmp_path)
    keep, made = Registry.commit, []

    def dies(self, *changes):
        if len(made) == commits:
            raise RuntimeError("killed")
        made.append(1)
        keep(self, *changes)

    monkeypatch.setattr(Registry, "commit", dies)
    with pytest.raises(RuntimeError, match="killed"):
        stages.ingest(registry, path, chunk_lines=2)
    monkeypatch.setattr(Registry, "commit", keep)
    out = stages.ingest(registry, path, chunk_lines=2)
    assert ("resumed_run_id" in out) == (commits > 0)
    rows = registry.table("raw").read().collect()
    assert sorted(r["source_line"] for r in rows) == [1, 2, 5, 6, 9] and len({r["id"] for r in rows}) == 5
    assert sorted(r["source_line"] for r in registry.table("anomalies").read().collect()) == [4, 8]
    assert (out["rows"], out["anomalies"], out["last_line"]) == (5, 2, 9)


def test_replies_paid_for_stay(spark, tmp_path, monkeypatch):
    from quern.operators import merge

    registry, path = Registry(spark, str(tmp_path / "db")), lines_of(tmp_path, 30)
    stages.ingest(registry, path)
    stages.assemble(registry)
    n = registry.table("entries", ENTRY).read().count()
    keep, made = merge.VersionedTable.append, []

    def dies(self, df):
        if self.name == "enrichments":
            if len(made) == 2:
                raise RuntimeError("killed")
            made.append(1)
        keep(self, df)

    monkeypatch.setattr(merge.VersionedTable, "append", dies)
    with pytest.raises(RuntimeError, match="killed"):
        stages.generate_definitions(registry, BUNDLE, commit_rows=3)
    monkeypatch.setattr(merge.VersionedTable, "append", keep)
    first = registry.table("enrichments").read().count()
    assert 0 < first < n
    out = stages.generate_definitions(registry, BUNDLE, commit_rows=3, threads=3)
    log = registry.table("enrichments").read()
    assert out["succeeded"] == n - first and log.count() == log.select("entry_id").distinct().count() == n


def test_commits_are_whole_and_old_folders_stay_a_while(spark, tmp_path, monkeypatch):
    from quern.operators import merge

    monkeypatch.setattr(merge, "KEEP", 3)
    a, b = (merge.VersionedTable(spark, f"{tmp_path}/{n}", "x int") for n in "ab")
    frame = lambda *xs: spark.createDataFrame([(x,) for x in xs], "x int")
    values = lambda t: sorted(r["x"] for r in t.read().collect())
    a.append(frame(1))
    held = a.read()
    a.put(frame(9))  # a crash before the commit
    assert values(a) == [1] and values(b) == []
    a.store.commit(a.replacing(frame(2)) | b.adding(frame(3)))
    assert (values(a), values(b)) == ([2], [3]) and [r["x"] for r in held.collect()] == [1]
    (tmp_path / "_commits" / "part-x").write_text("half")
    for k in range(4, 8):
        b.append(frame(k))
    assert values(b) == [3, 4, 5, 6, 7] and len(a.store._numbers()) == 3
    monkeypatch.setattr(merge, "MOST_FOLDERS", 4)
    b.append(frame(8))
    assert values(b) == [3, 4, 5, 6, 7, 8] and len(b.store.state()["b"]) == 1
    b.truncate()
    assert values(b) == [] and values(a) == [2]


def test_failed_reviews_are_counted_and_reports_are_made(built):
    registry, _, _, _ = built

    def harsh(kind, prompt, payload, temperature, tokens):
        return Reply("[]") if '"set"' in payload else fake_generator(kind, prompt, payload, temperature, tokens)

    out = stages.review(registry, harsh, size=50, seed="harsh", commit_rows=1)
    assert (out["reviews"], out["failed"]) == (1, 1)
    reports = stages.review_reports(registry, seed="harsh")
    assert [(r["verdict"], r["reviews"], r["share"]) for r in reports["verdicts"].collect()] == [("pass", 1, 1.0)]
    assert reports["issues"].collect() == [] and [r["reviews"] for r in reports["strata"].collect()] == [1]
    assert stages.review(registry, size=50, seed="harsh")["reviews"] == 1  # what failed was still to be done


def test_prompts_name_every_field_and_the_language():
    from quern.operators import generate

    for kind in generate.PROMPTS:
        text = BUNDLE.text(kind)
        assert "Chinese (Simplified)" in text and "{language}" not in text
    assert all(f"`{f}`" in BUNDLE.text("entry") for f in (*validate.ENTRY_FIELDS, "summary", "priority", "examples"))
    assert all(f"`{f}`" in BUNDLE.text("review") for f in validate.SCORE_FIELDS)
    assert Bundle("v", "fr", "French", (("entry", "own"),)).text("entry") == "own"


def test_a_busy_pool_is_waited_for():
    from quern.operators import generate

    waits, calls = [], []

    def busy(kind, *rest):
        calls.append(kind)
        if len(calls) < 3:
            raise generate.PoolBusy if len(calls) == 1 else ValueError
        return Reply("{}")

    call = generate.Attempts(busy, BUNDLE, pause=waits.append)
    assert call("entry", "{}", lambda x: x) == {} and waits == [35.0, 1.0] and call.used_compact


def test_many_small_chunks_are_a_commit_each_and_few_jobs(spark, tmp_path, monkeypatch):
    """Each chunk is a commit with its checkpoint; the number of jobs doesn't grow with that of chunks."""
    from quern.operators import merge

    monkeypatch.setattr(merge, "KEEP", 3)
    tracker, states = spark.sparkContext.statusTracker(), []
    keep = Registry.commit

    def seen(self, *changes):
        keep(self, *changes)
        states.append((self.table("raw").store.state()["raw"], self.table("checkpoints").store.state()["checkpoints"]))

    monkeypatch.setattr(Registry, "commit", seen)

    def jobs(n: int) -> int:
        (tmp_path / str(n)).mkdir()
        registry, path = Registry(spark, str(tmp_path / f"db{n}")), lines_of(tmp_path / str(n), n)
        spark.sparkContext.setJobGroup(f"ingest-{n}", "ingest")
        out = stages.ingest(registry, path, chunk_lines=1)
        spark.sparkContext._jsc.clearJobGroup()
        assert (out["rows"], out["anomalies"], out["last_line"]) == (n // 2, n // 4, n)
        assert sorted(r["source_line"] for r in registry.table("raw").read().collect()) == [k + 1 for k in range(n) if k % 4 < 2]
        assert registry.table("checkpoints").read().count() == 1 and len(registry.store._numbers()) == 3
        return len(tracker.getJobIdsForGroup(f"ingest-{n}"))

    few = jobs(8)
    assert len(states) == 6  # the blank lines' chunks have nothing to commit
    assert jobs(80) <= few + 10 and len(states) == 6 + 60
    assert len(states[-1][0]) == 1 and len(states[-2][0]) > 30  # all chunks of a write are one folder in the end


def test_lines_written_at_once_are_bounded(spark, tmp_path, monkeypatch):
    """Writes of two chunks each, and of one: every line once, and its id."""
    monkeypatch.setattr(stages, "WRITTEN_LINES", 4)
    for size in (2, 5):
        (tmp_path / str(size)).mkdir()
        registry, path = Registry(spark, str(tmp_path / f"db{size}")), lines_of(tmp_path / str(size), 21)
        out = stages.ingest(registry, path, chunk_lines=size)
        rows = registry.table("raw").read().collect()
        assert sorted((r["source_line"], r["id"]) for r in rows) == [(k + 1, k + 1) for k in range(21) if k % 4 < 2] and out["anomalies"] == 5
