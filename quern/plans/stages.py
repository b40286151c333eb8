"""Tracked stages, composed from the operators."""

from __future__ import annotations

import functools
import json
import math
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.operators import audit, curate, export, generate, merge, validate
from quern.plans.registry import Registry
from quern.schemas import ENTRY, TRIAGE
from quern.session import dropped, written
from quern.sources import archive, jsonl, sqlite

#: About so many lines of an ingest are written at once, whatever the size of its chunks.
WRITTEN_LINES = 1_000_000
RELATIONS = "entry_id string, relation_type string, target_word string, target_lang_code string, source_scope string, payload string"


def tracked(stage: str):
    """Runs a stage under a run row; what it raises is recorded and raised again. The stage returns its stats."""

    def wrap(f):
        @functools.wraps(f)
        def run(registry: Registry, *args, parent: str | None = None, **options) -> dict:
            config = {k: v for k, v in options.items() if isinstance(v, str | int | float | bool | list)}
            run_id = registry.start(stage, config | {"args": [a for a in args if isinstance(a, str | int)]}, parent)
            try:
                stats = f(registry, run_id, *args, **options)
            except Exception as e:
                registry.fail(run_id, f"{type(e).__name__}: {e}"[:2000])
                raise
            registry.complete(run_id, stats)
            return {"run_id": run_id, **stats}

        return run

    return wrap


def counts(registry: Registry, snapshot_id: str) -> dict:
    """What is stored of a snapshot: rows, anomalies and the last line with its offset."""

    def of(name: str):
        last = F.max(F.struct("source_line", "source_byte_offset"))
        return registry.table(name).read().filter(F.col("snapshot_id") == snapshot_id).agg(F.count(F.lit(1)), last).first()

    rows, anomalies = of("raw"), of("anomalies")
    last = max(((x[0], x[1] or 0) for _, x in (rows, anomalies) if x), default=(0, 0))
    return {"rows": rows[0], "anomalies": anomalies[0], "last_line": last[0], "last_offset": last[1]}


@tracked("source.ingest")
def ingest(registry: Registry, run_id: str, path: str, *, source_name: str = "local", resume: bool = True, chunk_lines: int = 1_000_000) -> dict:
    """A JSONL file into raw rows and anomalies, from the line after the last one stored. Lines are judged once; each chunk of
    them is one commit with its rows, anomalies and checkpoint, so a run that dies goes on after its last chunk. Many small chunks
    are written by one job, a folder each, and then committed one by one without further jobs. Stored rows
    must be what the checkpoint says; rows without a checkpoint are an error."""
    found = archive.register(path)
    snapshot_id = registry.snapshot(source_name, found)
    registry.update_config(run_id, {"snapshot_id": snapshot_id})
    stored = counts(registry, snapshot_id)
    open_run = registry.resumable("source.ingest", snapshot_id)
    done = registry.table("checkpoints").read().filter(F.col("checkpoint_key") == snapshot_id).orderBy(F.desc("updated_at")).first()
    if stored["last_line"] and not (resume and done):
        raise RuntimeError("the snapshot has rows but no checkpoint to resume from")
    if done and json.loads(done["payload"]) != stored:
        raise RuntimeError(f"the checkpoint says {done['payload']}, stored is {json.dumps(stored)}")
    lines = jsonl.numbered_lines(registry.spark, found.path).filter(F.col("source_line") > stored["last_line"])
    scanned = written(jsonl.scan(lines).withColumn("run_id", F.lit(run_id)).withColumn("snapshot_id", F.lit(snapshot_id)), "scanned")
    raw, anomalies = registry.table("raw"), registry.table("anomalies")
    before = raw.read().agg(F.coalesce(F.max("id"), F.lit(0))).first()[0] - stored["last_line"]
    last_line = scanned.agg(F.max("source_line")).first()[0] or 0
    first, together = stored["last_line"], chunk_lines * max(1, WRITTEN_LINES // chunk_lines)
    for start in range(first, last_line, together):
        some = (F.col("source_line") > start) & (F.col("source_line") <= start + together)
        part = scanned.filter(some).withColumn("chunk", ((F.col("source_line") - first - 1) / chunk_lines).cast("int"))
        good, bad = F.col("kind") == "record", F.col("kind") != "record"
        last = F.max(F.struct("source_line", "source_byte_offset"))
        payloads, held = {}, {}
        for chunk, n_good, n_bad, at in part.groupBy("chunk").agg(F.count_if(good), F.count_if(bad), last).orderBy("chunk").collect():
            stored = {"rows": stored["rows"] + n_good, "anomalies": stored["anomalies"] + n_bad, "last_line": at[0], "last_offset": at[1] or 0}
            payloads[chunk], held[chunk] = stored, {"raw": n_good, "anomalies": n_bad}
        if not payloads:
            continue
        records = part.filter(good).withColumnRenamed("json_text", "payload").withColumn("id", F.col("source_line") + before)
        faults = part.filter(bad).select("run_id", "snapshot_id", "source_line", "source_byte_offset", F.col("kind").alias("anomaly_type"), "detail", F.col("json_text").alias("raw_payload"), "chunk")
        now = {t.name: t.packed() for t in (raw, anomalies)}
        new = {"raw": raw.put_parts(records, "chunk"), "anomalies": anomalies.put_parts(faults, "chunk")}
        old, done_at = {k: list(v) for k, v in now.items()}, registry.checkpoints(run_id, "source.ingest", snapshot_id, payloads)
        for chunk in payloads:
            for name in new:
                now[name] += [f"{new[name]}/chunk={chunk}"] * (held[chunk][name] > 0)
                if chunk == max(payloads) and len(now[name]) > len(old[name]):
                    now[name] = [*old[name], new[name]]
            registry.commit({k: list(v) for k, v in now.items()}, done_at[chunk])
    dropped(scanned)
    return {"snapshot_id": snapshot_id, **({"resumed_run_id": open_run[0]} if open_run else {}), **counts(registry, snapshot_id)}


@tracked("entries.assemble")
def assemble(registry: Registry, run_id: str, *, languages: list[str] | None = None, selected: DataFrame | None = None, limit_groups: int | None = None, replace: bool = False) -> dict:
    """Raw rows into entries, relations and triage: upserted, replaced by entry, replaced by (lang_code, word); one commit.
    With `replace` all old rows go, generated ones too."""
    made = curate.curate(registry.table("raw").read(), languages, selected, limit_groups, once=True)
    entries, relations, triage = registry.table("entries", ENTRY), registry.table("relations", RELATIONS), registry.table("triage", TRIAGE)
    old = (lambda t: t.read().limit(0)) if replace else (lambda t: t.read())
    seen = made.entries.select("lang_code", F.col("normalized_word").alias("word")).unionByName(made.triage.select("lang_code", "word"))
    registry.commit(
        {"enrichments": []} if replace else {},
        entries.replacing(merge.upserted(old(entries), made.entries, ["entry_id"])),
        relations.replacing(merge.replaced(old(relations), made.entries, made.relations, ["entry_id"])),
        triage.replacing(merge.replaced(old(triage), seen, made.triage, ["lang_code", "word"])),
    )
    return {"entries": entries.read().count(), "relations": relations.read().count(), "triage": triage.read().count()}


def sliced(rows: DataFrame, key: str, size: int, label: str) -> Iterator[DataFrame]:
    """`rows` in parts of about `size`, dealt by the hash of `key`."""
    every = written(rows, label)
    n = max(1, math.ceil(every.count() / size))
    for k in range(n):
        yield every.filter(F.pmod(F.xxhash64(key), F.lit(n)) == k) if n > 1 else every
    dropped(every)


@tracked("definitions.generate")
def generate_definitions(registry: Registry, run_id: str, bundle: generate.Bundle, generator: generate.Generator = generate.fake_generator, *, limit: int | None = None, recompute: bool = False, commit_rows: int = 1000, **options) -> dict:
    """Responses for what has none yet; about `commit_rows` of them are one commit, which a job that dies later leaves."""
    registry.register_prompt(bundle.version, bundle.text("entry"), bundle.language_code, bundle.language_name)
    log = registry.table("enrichments")
    asked = generate.wanted(registry.table("entries", ENTRY).read(), None if recompute else log.read(), bundle, limit)
    for part in sliced(asked, "entry_id", commit_rows, "asked"):
        log.append(generate.log_rows(part, bundle, run_id, generator, **options))
    own = log.read().filter(F.col("run_id") == run_id)
    return {"succeeded": own.filter("status = 'succeeded'").count(), "failed": own.filter("status = 'failed'").count()}


def pending_count(registry: Registry, bundle: generate.Bundle) -> int:
    asked = generate.requests(registry.table("entries", ENTRY).read(), bundle)
    done = registry.table("enrichments").read().filter("status = 'succeeded'")
    return asked.join(done, ["entry_id", "input_hash"], "left_anti").count()


def _documents(registry: Registry, bundles: list[generate.Bundle]) -> export.Export:
    return export.distribution(registry.table("entries", ENTRY).read(), registry.table("enrichments").read(), bundles)


@tracked("distribution.export")
def export_distribution(registry: Registry, run_id: str, bundles: list[generate.Bundle], path: str, *, parts: bool = False) -> dict:
    """One ordered file on the driver's disk, or with `parts` a folder of files in order, written by executors."""
    made = _documents(registry, bundles)
    documents = written(made.documents, "documents")
    stats = {"skipped_unenriched": made.skipped.count(), "definition_run_ids": [r[0] for r in documents.select("definition_run_id").distinct().orderBy("definition_run_id").collect()]}
    if parts:
        export.write_jsonl_parts(documents, path)
        stats["documents"] = documents.count()
        registry.artifact(run_id, "distribution_jsonl_parts", path, None, stats["documents"], stats)
        return stats
    done = export.write_jsonl(documents, path)
    stats["documents"] = done.rows
    dropped(documents)
    registry.artifact(run_id, "distribution_jsonl", path, done.sha256, done.rows, stats)
    return stats | {"sha256": done.sha256}


@tracked("distribution.sqlite_export")
def export_sqlite(registry: Registry, run_id: str, bundles: list[generate.Bundle], path: str) -> dict:
    made = _documents(registry, bundles)
    documents = written(made.documents, "documents")  # nine tables are made of them
    n = sqlite.write_sqlite(documents, path, {"schema_version": validate.DOCUMENT_VERSION, "run_id": run_id})
    dropped(documents)
    stats = {"documents": n, "skipped_unenriched": made.skipped.count()}
    registry.artifact(run_id, "distribution_sqlite", path, archive.fingerprint(path), n, stats)
    return stats


@tracked("audit.export")
def export_audit(registry: Registry, run_id: str, path: str, *, include_missing: bool = True) -> dict:
    rows = export.audit_rows(registry.table("entries", ENTRY).read(), registry.table("enrichments").read(), include_missing)
    done = export.write_jsonl(rows, path)
    registry.artifact(run_id, "audit_jsonl", path, done.sha256, done.rows, {})
    return {"documents": done.rows, "sha256": done.sha256}


@tracked("definitions.review")
def review(registry: Registry, run_id: str, generator: generate.Generator = generate.fake_generator, *, size: int = 1000, seed: str = "review-v1", version: str = "review_v1", model: str = "fake", version_like: str | None = None,
           language: str = "English", workers: int | None = None, commit_rows: int = 1000) -> dict:
    """Reviews of a stratified sample, but those there are already, of responses to prompts like `version_like`; about
    `commit_rows` of them are one commit. Those that fail are counted and stay to be done."""
    reviews = registry.table("reviews")
    population = audit.review_population(registry.table("entries", ENTRY).read(), registry.table("enrichments").read(), version_like)
    bundle = generate.Bundle(version, "", language)

    def judge(batches):
        import pyarrow as pa

        for batch in batches:
            call = generate.Attempts(generator, bundle)
            answers = []
            for request in batch.column("request").to_pylist():
                try:
                    answers.append(json.dumps(call("review", request, validate.review)))
                except Exception:
                    answers.append(None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(answers, pa.string())], names=[*batch.schema.names, "answer"])

    json_of = lambda p: F.get_json_object("answer", p)
    done = failed = 0
    for part in sliced(audit.review_requests(audit.to_review(population, reviews.read(), size, seed, version)), "entry_id", commit_rows, "to-review"):
        part = part.repartition(workers) if workers else part
        judged = written(part.mapInArrow(judge, part.withColumn("answer", F.lit(None).cast("string")).schema), "judged")
        reviews.append(judged.filter("answer IS NOT NULL").select(
            "entry_id", F.col("input_hash").alias("enrichment_input_hash"), F.lit(version).alias("review_prompt_version"), F.lit(model).alias("judge_model"), F.lit(seed).alias("sample_seed"), "stratum", "sampling_weight",
            json_of("$.verdict").alias("verdict"), json_of("$.scores").alias("scores"), json_of("$.issues").alias("issues"), F.lit(run_id).alias("run_id"),
        ))
        n, n_failed = judged.agg(F.count(F.lit(1)), F.count_if(F.col("answer").isNull())).first()
        done, failed = done + n - n_failed, failed + n_failed
        dropped(judged)
    return {"reviews": done, "failed": failed}


def review_reports(registry: Registry, version: str = "review_v1", seed: str = "review-v1") -> dict[str, DataFrame]:
    """Read-only reports over the reviews by a prompt of a sample: verdicts with weighted shares, issues by kind, strata."""
    rows = registry.table("reviews").read().filter((F.col("review_prompt_version") == version) & (F.col("sample_seed") == seed))
    return {"verdicts": audit.verdict_summary(rows, *validate.SCORE_FIELDS), "issues": audit.issue_histogram(rows), "strata": audit.stratum_report(rows)}


def audit_definitions(registry: Registry, sample: int | None = None, *, version_like: str = "%", bucket_size: int = 1000) -> dict[str, DataFrame]:
    """Read-only reports over prompt versions like `version_like`: buckets of the log and their totals over every row,
    findings, their counts and the newest failures."""
    log = registry.table("enrichments").read().filter(F.col("prompt_version").like(version_like))
    found = audit.audited(log, sample)
    buckets = audit.log_health(log, bucket_size)
    return {"buckets": buckets, "totals": audit.log_totals(buckets), "findings": found, "finding_counts": audit.finding_counts(found), "failures": audit.recent_failures(log, by=("created_at", "enrichment_id"))}


@tracked("workflow.run")
def workflow(registry: Registry, run_id: str, path: str, bundle: generate.Bundle, folder: str, generator: generate.Generator = generate.fake_generator, *, tiers: tuple[int, ...] = (8,)) -> dict:
    """All stages in order; generation runs once for each tier of workers while anything is pending."""
    registry.init()
    out = {"ingest": ingest(registry, path, parent=run_id), "assemble": assemble(registry, parent=run_id)}
    for workers in tiers:
        if not pending_count(registry, bundle):
            break
        out["generate"] = generate_definitions(registry, bundle, generator, workers=workers, parent=run_id)
    out["distribution"] = export_distribution(registry, [bundle], f"{folder}/distribution.jsonl", parent=run_id)
    out["sqlite"] = export_sqlite(registry, [bundle], f"{folder}/distribution.sqlite", parent=run_id)
    out["audit"] = export_audit(registry, f"{folder}/audit.jsonl", parent=run_id)
    return out
