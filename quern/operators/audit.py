"""Quality reports over responses and reviews."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.canonical import with_canonical
from quern.functions.text import strip
from quern.operators import sampling
from quern.operators.latest import latest_enrichments, pending
from quern.schemas import RESPONSE
from quern.session import written

# Fixed values.
HEURISTICS_VERSION = "definitions_audit_v1"
MIN_EXPLANATION_CHARS = 12
MAX_CORE_SENSES = 5
RESTATE_OPENERS = ("指", "表示", "意为", "即")
MIXED_LANGUAGE = r"[一-鿿] ?(?:idea|thing|word|concept|root|sense)"
QUOTED_LATIN = "[“\"'][^”\"']*[A-Za-z]"


def bucket_health(log: DataFrame, size: int = 1000) -> DataFrame:
    """By bucket of the numeric id: rows, failures, retries, and how many were sharded."""
    sharded = F.get_json_object("generation_metadata", "$.sharded") == "true"
    tokens = F.get_json_object("generation_metadata", "$.completion_tokens").cast("int")
    return log.groupBy(F.expr(f"enrichment_id div {size}").alias("bucket")).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") == "failed").alias("failed"), F.coalesce(F.sum("retries"), F.lit(0)).alias("retries"),
        F.count_if(sharded).alias("sharded"), F.round(F.avg(tokens), 1).alias("avg_completion_tokens"),
    )


def numbered(log: DataFrame) -> DataFrame:
    """`log` with `sequence`: 0, 1, ... from oldest to newest, counted by split of the sorted rows."""
    row = F.monotonically_increasing_id()
    rows = written(log.orderBy("created_at", "enrichment_id").withColumn("__row", row), "numbered")
    split = F.shiftright("__row", 33)
    sizes = sorted((r[0], r[1]) for r in rows.groupBy(split.alias("split")).count().collect())  # a row for each split
    before = dict(zip((k for k, _ in sizes), accumulate((n for _, n in sizes), initial=0), strict=False))
    first = F.element_at(F.create_map(*[F.lit(x).cast("long") for kv in before.items() for x in kv]), split) if before else F.lit(0)
    return rows.withColumn("sequence", first + F.col("__row").bitwiseAND((1 << 33) - 1)).drop("__row")


def log_health(log: DataFrame, size: int = 1000) -> DataFrame:
    """By thousands (or `size`) of the enrichment log from oldest to newest: succeeded, failed, retries, use of the compact
    prompt and of shards, mean tokens."""
    said = lambda p: F.get_json_object("generation_metadata", p)
    return numbered(log).groupBy(F.expr(f"sequence div {size}").alias("bucket")).agg(
        F.count_if(F.col("status") == "succeeded").alias("succeeded"), F.count_if(F.col("status") == "failed").alias("failed"), F.coalesce(F.sum("retries"), F.lit(0)).alias("retries"),
        F.count_if(said("$.used_compact_retry_prompt") == "true").alias("compact_used"), F.count_if(said("$.sharded") == "true").alias("sharded"),
        *[F.round(F.avg(F.coalesce(said(f"$.usage.{k}_tokens"), said(f"$.{k}_tokens")).cast("int")), 1).alias(f"avg_{k}_tokens") for k in ("prompt", "completion")],
    ).orderBy("bucket")


def log_totals(buckets: DataFrame) -> DataFrame:
    return buckets.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("succeeded", "failed", "retries", "compact_used")])


def totals(buckets: DataFrame) -> DataFrame:
    return buckets.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "failed", "retries", "sharded")])


def findings(response: Column, payload: Column) -> Column:
    """array<struct<check, detail>> of soft faults in a response; `payload` is its JSON."""
    finding = lambda check, detail: F.struct(F.lit(check).alias("check"), detail.cast("string").alias("detail"))
    kind = "array<struct<check:string,detail:string>>"
    senses = F.flatten(F.transform(response["pos_groups"], lambda g: F.transform(g["meanings"], lambda m: F.struct(F.concat_ws("/", g["pos_group_id"], m["sense_id"]).alias("at"), m.alias("m")))))
    n_core = F.size(F.filter(senses, lambda s: s["m"]["priority"] == "core"))
    over = F.when(n_core > MAX_CORE_SENSES, F.array(finding("core_over_budget", n_core)))

    def of_sense(s: Column) -> Column:
        m = s["m"]
        note = m["usage_note"]
        opens = F.lit(False)
        for opener in RESTATE_OPENERS:
            opens = opens | note.startswith(opener)
        return F.array_compact(F.array(
            F.when(m["priority"].isin("core", "common") & (F.coalesce(F.size(m["examples"]), F.lit(0)) < 1), finding("missing_example", F.concat(s["at"], F.lit(" ("), m["priority"], F.lit(")")))),
            F.when(F.char_length(F.coalesce(m["learner_explanation"], F.lit(""))) < MIN_EXPLANATION_CHARS, finding("short_explanation", s["at"])),
            F.when(F.coalesce(opens, F.lit(False)) & ~F.left(note, F.lit(40)).rlike(QUOTED_LATIN), finding("restate_style_usage_note", F.concat(s["at"], F.lit(": "), F.left(note, F.lit(60))))),
        ))

    hook, summary = (F.coalesce(strip(response[f]), F.lit("")) for f in ("memory_hook", "headword_summary"))
    same = F.when((hook != "") & (hook == summary), F.array(finding("hook_equals_summary", F.left(hook, F.lit(60)))))
    mixed = F.regexp_extract(payload, MIXED_LANGUAGE, 0)
    mixed = F.when(mixed != "", F.array(finding("mixed_language", mixed)))
    none = F.array().cast(kind)
    return F.concat(*[F.coalesce(p.cast(kind), none) for p in (over, F.flatten(F.transform(senses, of_sense)), same, mixed)])


def audited(log: DataFrame, sample: int | None = None, seed: str | None = None) -> DataFrame:
    """(entry_id, check, detail) of successful responses, all or a sample."""
    rows = log.filter("status = 'succeeded'")
    rows = sampling.random_sample(rows, sample, seed, "enrichment_id") if sample else rows
    read = rows.withColumn("r", F.from_json("response_payload", RESPONSE))
    return read.select("entry_id", F.explode(findings(F.col("r"), F.col("response_payload"))).alias("f")).select("entry_id", "f.*")


def finding_counts(found: DataFrame) -> DataFrame:
    return found.groupBy("check").agg(F.count(F.lit(1)).alias("n"))


def recent_failures(log: DataFrame, n: int = 10, by: tuple[str, ...] = ("enrichment_id",)) -> DataFrame:
    return log.filter("status = 'failed'").orderBy(*[F.desc(c) for c in by]).select("enrichment_id", "entry_id", F.left("error", F.lit(200)).alias("error")).limit(n)


def review_population(entries: DataFrame, log: DataFrame, version_like: str | None = None) -> DataFrame:
    """Entries that have a response, with their stratum."""
    n = F.aggregate("pos_groups", F.lit(0), lambda a, g: a + F.size(g["senses"]))
    shown = entries.select("entry_id", "word", sampling.stratum(F.col("word"), F.col("entry_flags"), n).alias("stratum"), n.alias("sense_count"))
    return shown.join(latest_enrichments(log, version_like=version_like).select("entry_id", "input_hash", "response_payload"), "entry_id")


def to_review(population: DataFrame, reviews: DataFrame, size: int, seed: str, review_version: str) -> DataFrame:
    """The stratified sample but what was reviewed already with this prompt and seed. Weights are those of the whole sample."""
    done = reviews.filter((F.col("review_prompt_version") == review_version) & (F.col("sample_seed") == seed))
    done = done.select("entry_id", F.col("enrichment_input_hash").alias("input_hash"))
    return pending(sampling.stratified(population, size, seed), done, ["entry_id", "input_hash"])


def verdict_summary(reviews: DataFrame, *scores: str) -> DataFrame:
    """By verdict: reviews, weight, share of all weight (4 places; no weight counts as 1) and mean scores (2 places)."""
    means = [F.round(F.avg(F.get_json_object("scores", f"$.{s}").cast("int")), 2).alias(f"avg_{s}") for s in scores]
    out = reviews.groupBy("verdict").agg(F.count(F.lit(1)).alias("reviews"), F.sum("sampling_weight").alias("weight"), *means)
    total = F.sum("weight").over(Window.partitionBy(F.lit(0)))  # a row per verdict
    return out.withColumn("share", F.round(F.col("weight") / F.when(total == 0, 1.0).otherwise(total), 4))


def issue_histogram(reviews: DataFrame) -> DataFrame:
    kinds = F.from_json("issues", "array<struct<kind:string>>")
    return reviews.select(F.explode(kinds).alias("i")).groupBy("i.kind").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "kind")


def stratum_report(reviews: DataFrame) -> DataFrame:
    major = F.count_if(F.col("verdict") == "major_issues").alias("major")
    return reviews.groupBy("stratum").agg(F.count(F.lit(1)).alias("reviews"), major).orderBy(F.desc("major"), "stratum")


def review_requests(todo: DataFrame) -> DataFrame:
    """Rows with `request`: what a reviewer is shown, compact."""
    shown = todo.withColumn("__shown", F.struct("word", "stratum", "response_payload"))
    return with_canonical(shown, compact=True, request=F.col("__shown")).drop("__shown")
