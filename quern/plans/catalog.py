"""Registered queries over the driver's tables, each beside the SQL that says the same.

The tables have no dictionary data, so two views stand in, defined alike in both languages: RAW makes a raw row of each
document, ENRICH a log row of each event."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import ids
from quern.functions.canonical import with_canonical
from quern.operators import audit, classify, curate, export, generate, latest, merge, nested, packing, sampling, selection
from quern.plans import registry
from quern.session import table, written
from quern.sources import jsonl

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

POS = ("noun", "verb", "adj", "adv", "name", "suffix", "proverb", "romanization", "character", "conj")
RAW = """raw AS (
  SELECT doc_id AS id, lang AS lang_code, regexp_extract(text, '[A-Za-z]+', 0) AS word,
         ['noun','verb','adj','adv','name','suffix','proverb','romanization','character','conj'][CAST(doc_id % 10 AS INTEGER) + 1] AS pos,
         CASE WHEN doc_id % 3 <> 0 THEN source END AS etymology_text, string_split(text, chr(10)) AS glosses, text
  FROM documents)"""
ENRICH = """enrich AS (
  SELECT user_id AS entry_id, event_id AS enrichment_id, ts AS created_at, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'succeeded' END AS status,
         event_type AS model, md5(props) AS input_hash, event_id % 3 AS retries, props
  FROM events)"""
TOKENS = """tokens AS (
  SELECT doc_id, lang, unnest(generate_series(0, len(w) - 1)) AS pos, unnest(w) AS token FROM (SELECT doc_id, lang, string_split(text, ' ') AS w FROM documents))"""


def query(sql: str | None = None):
    """Registers a function under its name, with its SQL where there is one."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.array(*[F.lit(p) for p in POS])
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.col("lang").alias("lang_code"), F.regexp_extract("text", "[A-Za-z]+", 0).alias("word"),
        F.get(kinds, (F.col("doc_id") % 10).cast("int")).alias("pos"), F.when(F.col("doc_id") % 3 != 0, F.col("source")).alias("etymology_text"),
        F.split("text", "\n").alias("glosses"), "text",
    )


def enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("entry_id"), F.col("event_id").alias("enrichment_id"), F.col("ts").alias("created_at"),
        F.when(F.col("event_type") == "error", "failed").otherwise("succeeded").alias("status"), F.col("event_type").alias("model"),
        F.md5("props").alias("input_hash"), (F.col("event_id") % 3).alias("retries"), "props",
    )


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "lang", F.posexplode(F.split("text", " ")).alias("pos", "token"))


# --- aggregates and reports


@query("""
WITH e AS (SELECT event_id, event_type, CAST(props->>'$.k' AS INTEGER) AS k FROM events)
SELECT event_id // 1000 AS bucket, CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS failed, CAST(sum(event_id % 3) AS BIGINT) AS retries,
       CAST(count(*) FILTER (WHERE k % 2 = 0) AS BIGINT) AS sharded, round(avg(k), 1) AS avg_completion_tokens
FROM e GROUP BY 1
""")
def bucket_health(spark, sf_dir):
    """Counts, failures and JSON fields by integer bucket of the id."""
    k = F.get_json_object("props", "$.k")
    meta = F.concat(F.lit('{"sharded": '), (k.cast("int") % 2 == 0).cast("string"), F.lit(', "completion_tokens": '), k, F.lit("}"))
    return audit.bucket_health(enrich(spark, sf_dir).withColumn("generation_metadata", meta))


@query(f"""
WITH {ENRICH}, b AS (SELECT enrichment_id // 1000 AS bucket, count(*) AS n, count(*) FILTER (WHERE status = 'failed') AS f, sum(retries) AS r FROM enrich GROUP BY 1)
SELECT CAST(sum(n) AS BIGINT) AS total, CAST(sum(f) AS BIGINT) AS failed, CAST(sum(r) AS BIGINT) AS retries, CAST(0 AS BIGINT) AS sharded FROM b
""")
def bucket_totals(spark, sf_dir):
    """Totals over the buckets (A5)."""
    return audit.totals(audit.bucket_health(enrich(spark, sf_dir).withColumn("generation_metadata", F.lit("{}"))))


@query(f"""
WITH {ENRICH} SELECT DISTINCT ON (entry_id) entry_id, enrichment_id, model, input_hash FROM enrich WHERE status = 'succeeded'
ORDER BY entry_id, created_at DESC, enrichment_id DESC
""")
def latest_per_key(spark, sf_dir):
    """The newest success of each entry."""
    return latest.latest_enrichments(enrich(spark, sf_dir)).select("entry_id", "enrichment_id", "model", "input_hash")


@query(f"""
WITH {ENRICH} SELECT DISTINCT ON (entry_id) entry_id, enrichment_id, model FROM enrich WHERE status = 'succeeded' AND model IN ('click', 'view') AND model LIKE 'v%'
ORDER BY entry_id, created_at DESC, enrichment_id DESC
""")
def latest_filtered(spark, sf_dir):
    """The newest success of some models, by an IN list and LIKE."""
    log = enrich(spark, sf_dir).withColumn("prompt_version", F.col("model"))
    return latest.latest_enrichments(log, models=["click", "view"], version_like="v%").select("entry_id", "enrichment_id", "model")


@query(f"""
WITH {ENRICH} SELECT DISTINCT ON (entry_id, input_hash) entry_id, input_hash, enrichment_id FROM enrich WHERE status = 'succeeded'
ORDER BY entry_id, input_hash, created_at DESC, enrichment_id DESC
""")
def candidate_per_hash(spark, sf_dir):
    """The newest success of each entry and hash."""
    ok = enrich(spark, sf_dir).filter("status = 'succeeded'")
    return latest.latest_per_key(ok, ["entry_id", "input_hash"], F.desc("created_at"), F.desc("enrichment_id")).select("entry_id", "input_hash", "enrichment_id")


@query(f"""
WITH {ENRICH}, e AS (SELECT c_custkey AS entry_id, unnest([0, 1, 2]) AS preference FROM customer),
h AS (SELECT entry_id, preference, md5('{{"k": ' || ((entry_id + preference * 7) % 100) || '}}') AS input_hash FROM e),
j AS (SELECT h.*, x.enrichment_id, x.created_at FROM h LEFT JOIN (SELECT * FROM enrich WHERE status = 'succeeded') x USING (entry_id, input_hash)),
r AS (SELECT *, row_number() OVER (PARTITION BY entry_id ORDER BY CASE WHEN enrichment_id IS NULL THEN 1 ELSE 0 END, preference, created_at DESC, enrichment_id DESC) AS n FROM j)
SELECT entry_id, preference, CAST(enrichment_id AS VARCHAR) AS enrichment_id FROM r WHERE n = 1
""")
def version_preference(spark, sf_dir):
    """Of several hashes of an entry the first that was answered, newest answer."""
    entries = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entry_id"), F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("preference"))
    key = F.concat(F.lit('{"k": '), ((F.col("entry_id") + F.col("preference") * 7) % 100).cast("string"), F.lit("}"))
    return latest.preferred(entries.withColumn("input_hash", F.md5(key)), enrich(spark, sf_dir)).select("entry_id", "preference", F.col("enrichment_id").cast("string").alias("enrichment_id"))


@query("""
SELECT o_orderkey, o_custkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_suppkey = o.o_custkey)
""")
def resume_anti_join(spark, sf_dir):
    """What a rerun still has to do, by two keys."""
    done = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("o_custkey"))
    return latest.pending(table(spark, sf_dir, "orders"), done, ["o_orderkey", "o_custkey"]).select("o_orderkey", "o_custkey")


@query("SELECT CAST(count(*) AS BIGINT) AS pending FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_quantity > 45)")
def pending_count(spark, sf_dir):
    """How many are left."""
    done = table(spark, sf_dir, "lineitem").filter("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return latest.pending(table(spark, sf_dir, "orders").select("o_orderkey"), done, ["o_orderkey"]).agg(F.count(F.lit(1)).alias("pending"))


LATEST = f"{ENRICH}, l AS (SELECT DISTINCT ON (entry_id) entry_id, enrichment_id, model FROM enrich WHERE status = 'succeeded' ORDER BY entry_id, created_at DESC, enrichment_id DESC)"


def _latest(spark, sf_dir, include_missing):
    entries = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entry_id"), "c_name")
    return latest.joined_latest(entries, enrich(spark, sf_dir).withColumn("prompt_version", F.lit("v1")), include_missing).select("entry_id", "c_name", F.col("enrichment_id").cast("string").alias("enrichment_id"), "model").orderBy("entry_id")


@query(f"WITH {LATEST} SELECT c_custkey AS entry_id, c_name, CAST(enrichment_id AS VARCHAR) AS enrichment_id, model FROM customer LEFT JOIN l ON c_custkey = entry_id ORDER BY 1")
def export_left(spark, sf_dir):
    """Entries with their newest enrichment, kept without one."""
    return _latest(spark, sf_dir, True)


@query(f"WITH {LATEST} SELECT c_custkey AS entry_id, c_name, CAST(enrichment_id AS VARCHAR) AS enrichment_id, model FROM customer JOIN l ON c_custkey = entry_id ORDER BY 1")
def export_inner(spark, sf_dir):
    """Entries with their newest enrichment, if there is one."""
    return _latest(spark, sf_dir, False)


@query("""
WITH r AS (SELECT o_orderkey, o_orderdate, o_orderstatus, CAST(o_custkey % 5 AS VARCHAR) AS snapshot_id FROM orders)
SELECT CAST(o_orderkey AS VARCHAR) AS run_id, CAST(l_linenumber AS VARCHAR) AS checkpoint_key, snapshot_id FROM lineitem JOIN r ON l_orderkey = o_orderkey WHERE o_orderstatus IN ('F', 'O') AND snapshot_id = '3'
ORDER BY l_shipdate DESC, o_orderdate DESC, 1, 2
""")
def checkpoint_join(spark, sf_dir):
    """Checkpoints of unfinished runs of a snapshot, which stats or else config names, newest first."""
    snapshot = F.concat(F.lit('{"snapshot_id": "'), (F.col("o_custkey") % 5).cast("string"), F.lit('"}'))
    odd = F.col("o_orderkey") % 2 == 1
    runs = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("run_id"), F.lit("source.ingest").alias("stage"), F.when(F.col("o_orderstatus") == "F", "failed").when(F.col("o_orderstatus") == "O", "running").otherwise("succeeded").alias("status"),
        F.when(odd, snapshot).otherwise('{"rows": 1}').alias("stats"), F.when(odd, '{"snapshot_id": "none"}').otherwise(snapshot).alias("config"), F.col("o_orderdate").alias("started_at"),
    )
    points = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("run_id"), F.col("l_linenumber").cast("string").alias("checkpoint_key"), F.col("l_shipdate").alias("updated_at"))
    return registry.resume_points(runs, points, "source.ingest", "3").select("run_id", "checkpoint_key", "snapshot_id")


# --- curation


@query(f"""
WITH {RAW}, c AS (SELECT id, lower(trim(word)) AS w, lang_code, pos FROM raw)
SELECT id, CASE WHEN w = '' OR lang_code IS NULL THEN 'triage' WHEN pos IN ('noun','verb','adj','adv','pron','num','prep','phrase','intj','det') THEN 'keep'
  WHEN pos IN ('proverb','suffix','prefix','name') THEN 'keep_with_flag' ELSE 'triage' END AS decision,
  CASE WHEN w = '' OR lang_code IS NULL THEN 'missing_lexical_identity' WHEN pos IN ('noun','verb','adj','adv','name','suffix','proverb') THEN NULL
  WHEN pos IN ('romanization','character') THEN 'record_type_out_of_scope' ELSE 'unknown_pos' END AS reason_code,
  CASE WHEN w = '' OR lang_code IS NULL THEN 'defer' WHEN pos = 'romanization' THEN 'convert_to_relation' WHEN pos = 'character' THEN 'drop' WHEN pos = 'conj' THEN 'requires_rule_update' END AS suggested_action
FROM c
""")
def classify_pos(spark, sf_dir):
    """Ordered rules by part of speech."""
    word = F.nullif(F.lower(F.trim("word")), F.lit(""))
    verdict = classify.decide(word, F.col("lang_code"), F.col("pos"), F.lit(None).cast("string"))
    return raw(spark, sf_dir).withColumn("v", verdict).select("id", "v.decision", "v.reason_code", "v.suggested_action")


@query(f"""
WITH {RAW}, s AS (SELECT id, unnest(generate_series(1, len(glosses))) AS i, unnest(glosses) AS g FROM raw),
k AS (SELECT id, length(g) % 2 = 0 AS form, length(g) % 3 = 0 AS alt, length(g) % 5 = 0 OR length(g) < 90 AS derived FROM s)
SELECT id, CASE WHEN bool_and((form OR alt) AND derived) THEN CASE WHEN bool_or(form) THEN 'form_of' WHEN bool_or(alt) THEN 'alternative_of' END END AS dominant FROM k GROUP BY 1
""")
def relation_dominant(spark, sf_dir):
    """Records all of whose senses stand for other words (P2): a line is a sense, whose relations and gloss its length says."""
    some = lambda held: F.when(held, F.array(F.struct(F.lit("x").alias("word"), F.lit(None).cast("string").alias("lang_code")))).otherwise(F.array().cast("array<struct<word:string,lang_code:string>>"))
    none = F.array().cast("array<string>")

    def sense(g):
        n = F.char_length(g)
        glosses = F.when(n % 5 == 0, none).when(n < 90, F.array(F.concat(F.lit("Plural of "), g))).otherwise(F.array(F.lit("a thing")))
        return F.struct(glosses.alias("glosses"), none.alias("raw_glosses"), some(n % 2 == 0).alias("form_of"), some(n % 3 == 0).alias("alt_of"))

    return raw(spark, sf_dir).select("id", classify.dominant_relation(F.struct(F.transform("glosses", sense).alias("senses"))).alias("dominant"))


@query(f"""
WITH {RAW} SELECT coalesce(lang_code, '_') AS lang_code, coalesce(nullif(lower(word), ''), '_') AS normalized_word, CAST(count(*) AS BIGINT) AS n, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS raw_ids,
  coalesce(first(nullif(word, '') ORDER BY id) FILTER (WHERE word <> ''), '_') AS display
FROM raw GROUP BY 1, 2
""")
def group_entries(spark, sf_dir):
    """Rows by headword in order."""
    rows = raw(spark, sf_dir).select(F.coalesce("lang_code", F.lit("_")).alias("lang_code"), F.coalesce(F.nullif(F.lower("word"), F.lit("")), F.lit("_")).alias("normalized_word"), F.struct("id", F.nullif("word", F.lit("")).alias("word")).alias("row"))
    groups = rows.groupBy("lang_code", "normalized_word").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    return groups.select("lang_code", "normalized_word", F.size("rows").cast("long").alias("n"), F.array_join(F.transform("rows", lambda r: r["id"].cast("string")), ",").alias("raw_ids"), curate.first_known(F.col("rows"), "word").alias("display"))


@query(f"""
WITH {RAW}, h AS (SELECT id, sha1(from_hex('6ba7b8119dad11d180b400c04fd430c8') || encode(lang_code || '|' || lower(word))) AS d FROM raw)
SELECT id, d[1:8] || '-' || d[9:12] || '-5' || d[14:16] || '-' || '89ab'[CAST(('0x' || d[17]) AS INTEGER) % 4 + 1] || d[18:20] || '-' || d[21:32] AS entry_id FROM h
""")
def entry_ids(spark, sf_dir):
    """Version-5 UUIDs of headwords."""
    return raw(spark, sf_dir).select("id", ids.entry_id(F.col("lang_code"), F.lower("word")).alias("entry_id"))


@query(f"""
WITH {RAW}, k AS (SELECT lang_code, lower(word) AS w, coalesce(etymology_text, '__missing__') AS k, min(id) AS first_id, string_agg(DISTINCT pos, ',' ORDER BY pos) AS member_pos, CAST(count(*) AS BIGINT) AS n FROM raw GROUP BY 1, 2, 3)
SELECT lang_code, w AS normalized_word, 'et' || row_number() OVER (PARTITION BY lang_code, w ORDER BY first_id) AS etymology_id, nullif(k, '__missing__') AS etymology_text, member_pos, n FROM k
""")
def etymology_groups(spark, sf_dir):
    """Etymologies of a headword in order of first appearance."""
    rows = raw(spark, sf_dir).groupBy("lang_code", F.lower("word").alias("normalized_word")).agg(F.array_sort(F.collect_list(F.struct("id", "pos", "etymology_text"))).alias("rows"))
    keyed = rows.withColumn("keys", curate.etymology_keys(F.col("rows")))
    out = keyed.select("lang_code", "normalized_word", F.explode(curate.etymology_groups(F.col("rows"), F.col("keys"))).alias("g"))
    return out.select("lang_code", "normalized_word", "g.etymology_id", "g.etymology_text", F.array_join("g.member_pos", ",").alias("member_pos"), F.size("g.source_refs").cast("long").alias("n"))


@query(f"""
WITH {RAW}, s AS (SELECT lang_code, lower(word) AS w, pos, id, unnest(generate_series(1, len(glosses))) AS i, unnest(glosses) AS gloss FROM raw),
u AS (SELECT lang_code, w, pos, gloss, min(struct_pack(id := id, i := i)) AS f FROM s GROUP BY 1, 2, 3, 4),
n AS (SELECT *, row_number() OVER (PARTITION BY lang_code, w, pos ORDER BY f.id, f.i) AS r FROM u)
SELECT lang_code, w AS normalized_word, pos, CAST(count(*) AS BIGINT) AS n_senses, md5(string_agg('s' || r || '=' || gloss, '|' ORDER BY r)) AS senses_md5 FROM n GROUP BY 1, 2, 3
""")
def pos_groups(spark, sf_dir):
    """Senses of a headword by part of speech, each once, numbered in order."""
    groups = raw(spark, sf_dir).groupBy("lang_code", F.lower("word").alias("normalized_word"), "pos").agg(F.array_sort(F.collect_list(F.struct("id", "glosses"))).alias("rows"))
    senses = F.array_distinct(F.flatten(F.transform("rows", lambda r: r["glosses"])))
    senses = nested.renumbered(F.transform(senses, lambda g: F.struct(F.lit("").alias("sense_id"), g.alias("gloss"))))
    shown = groups.withColumn("senses", senses)
    text = F.array_join(F.transform("senses", lambda s: F.concat(s["sense_id"], F.lit("="), s["gloss"])), "|")
    return shown.select("lang_code", "normalized_word", "pos", F.size("senses").cast("long").alias("n_senses"), F.md5(text).alias("senses_md5"))


@query("""
SELECT l_orderkey, CAST(count(*) AS INTEGER) AS raw_record_count, string_agg(DISTINCT CAST(l_suppkey AS VARCHAR), ',' ORDER BY CAST(l_suppkey AS VARCHAR)) AS snapshots, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS runs
FROM lineitem GROUP BY 1
""")
def source_summary(spark, sf_dir):
    """Count and sorted distinct ids of the rows of a group."""
    ref = F.struct(F.col("l_suppkey").cast("string").alias("snapshot_id"), F.when(F.col("l_returnflag") != "", F.col("l_returnflag")).alias("run_id"))
    groups = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("id"), ref.alias("ref")))).alias("rows"))
    shown = groups.select("l_orderkey", curate.source_summary(F.col("rows")).alias("s"))
    return shown.select("l_orderkey", "s.raw_record_count", F.array_join("s.raw_snapshot_ids", ",").alias("snapshots"), F.array_join("s.raw_run_ids", ",").alias("runs"))


@query(f"""
WITH {TOKENS}, f AS (SELECT doc_id, token, min(pos) AS p FROM tokens GROUP BY 1, 2)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n, md5(string_agg(token, ' ' ORDER BY p)) AS kept_md5 FROM f GROUP BY 1
""")
def dedupe_first(spark, sf_dir):
    """Each token of a text once, in order of first appearance."""
    return table(spark, sf_dir, "documents").select("doc_id", nested.dedupe(F.split("text", " ")).alias("t")).select("doc_id", F.size("t").cast("long").alias("n"), F.md5(F.array_join("t", " ")).alias("kept_md5"))


@query("""
WITH r AS (SELECT l_suppkey, l_returnflag, l_orderkey, l_linenumber, l_partkey, row_number() OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey) AS n FROM lineitem)
SELECT l_suppkey, CAST(count(*) AS INTEGER) AS n, md5(string_agg(l_returnflag || l_orderkey || '-' || l_linenumber || '-' || l_partkey, ',' ORDER BY l_orderkey, l_linenumber, l_partkey, l_returnflag)) AS kept_md5 FROM r WHERE n <= 24 GROUP BY 1
""")
def cap_per_type(spark, sf_dir):
    """At most 24 of each type, order kept."""
    item = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    groups = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.array_sort(F.collect_list(item)).alias("items"))
    kept = groups.select("l_suppkey", nested.cap_per_key(F.col("items"), lambda x: x["l_returnflag"], nested.MAX_RELATIONS_PER_TYPE).alias("k"))
    shown = F.transform("k", lambda x: F.concat(x["l_returnflag"], F.concat_ws("-", x["l_orderkey"].cast("string"), x["l_linenumber"].cast("string"), x["l_partkey"].cast("string"))))
    return kept.select("l_suppkey", F.size("k").alias("n"), F.md5(F.array_join(shown, ",")).alias("kept_md5"))


@query("""
WITH f AS (SELECT doc_id, string_split(text, ' ') AS w FROM documents), u AS (SELECT doc_id, list_filter(list_transform(generate_series(1, len(w)), lambda i: CASE WHEN list_position(w, w[i]) = i THEN w[i] END), lambda x: x IS NOT NULL) AS d FROM f)
SELECT doc_id, CAST(least(len(d), 48) AS INTEGER) AS kept, len(d) > 48 AS trimmed, md5(array_to_string(d[1:48], ' ')) AS kept_md5 FROM u
""")
def trim_flag(spark, sf_dir):
    """The first 48 forms, flagged where more were there."""
    forms = F.transform(F.array_distinct(F.split("text", " ")), lambda t: F.struct(t.alias("form"), F.array().cast("array<string>").alias("form_flags")))
    kept, flags = nested.trim(forms, nested.MAX_FORMS, "trimmed_form_set", "form_flags")
    out = table(spark, sf_dir, "documents").select("doc_id", kept.alias("k"), flags.alias("f"))
    return out.select("doc_id", F.size("k").alias("kept"), (F.size("f") > 0).alias("trimmed"), F.md5(F.array_join(F.transform("k", lambda x: x["form"]), " ")).alias("kept_md5"))


@query("""
WITH s AS (SELECT doc_id, unnest(generate_series(1, len(l))) AS sense_index, unnest(l) AS gloss FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))
SELECT doc_id, CAST(sense_index AS INTEGER) AS sense_index FROM s WHERE length(gloss) < 20
""")
def missing_gloss(spark, sf_dir):
    """Places, from 1, of senses without a gloss; short lines stand for those."""
    none = F.array().cast("array<string>")
    senses = F.transform(F.split("text", "\n"), lambda g: F.struct(F.when(F.char_length(g) < 20, none).otherwise(F.array(g)).alias("glosses"), none.alias("raw_glosses")))
    found = nested.senses_without_gloss(F.struct(senses.alias("senses")))
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(found).alias("sense_index"))


@query(f"""
WITH {ENRICH}, l AS (SELECT DISTINCT entry_id FROM enrich WHERE status = 'succeeded' AND model LIKE 'v%'),
n AS (SELECT doc_id, lang, len(string_split(text, chr(10))) + len(string_split(text, ' ')) AS n FROM documents)
SELECT doc_id AS entry_id, CAST(n AS INTEGER) AS sense_count, (CASE WHEN lang = 'en' THEN 'word' ELSE 'phrase' END) || '|' || (CASE WHEN n <= 1 THEN '1' WHEN n <= 9 THEN '2-9' WHEN n <= 28 THEN '10-28' ELSE 'sharded' END) AS stratum
FROM n JOIN l ON entry_id = doc_id
""")
def review_population(spark, sf_dir):
    """Entries with a newest enrichment, their senses counted over all groups, and their stratum."""
    groups = F.array(F.struct(F.split("text", "\n").alias("senses")), F.struct(F.split("text", " ").alias("senses")))
    word = F.when(F.col("lang") == "en", "plainword").otherwise("two words")
    entries = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("entry_id"), word.alias("word"), F.array().cast("array<string>").alias("entry_flags"), groups.alias("pos_groups"))
    log = enrich(spark, sf_dir).withColumns({"prompt_version": F.col("model"), "response_payload": F.col("props")})
    return audit.review_population(entries, log, version_like="v%").select("entry_id", "sense_count", "stratum")


@query("SELECT doc_id, sha256(text) AS text_sha256, md5('s1|' || doc_id) AS sample_key, substr(sha1(doc_id || '|' || lang || '|' || source), 1, 16) AS order_key FROM documents")
def content_hash(spark, sf_dir):
    """Hashes of content and of keys."""
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("text_sha256"), ids.sample_key("s1", F.col("doc_id").cast("string")).alias("sample_key"), ids.order_key(F.col("doc_id"), F.col("lang"), F.col("source")).alias("order_key"))


@query("""
SELECT doc_id, sha256('{"doc_id": ' || doc_id || ', "lang": "' || lang || '", "nothing": null, "source": "' || source || '"}') AS canonical_sha256 FROM documents
""")
def canonical_hash(spark, sf_dir):
    """Hash of canonical JSON, keys sorted and nulls kept."""
    shown = table(spark, sf_dir, "documents").select("doc_id", F.struct("source", F.lit(None).cast("string").alias("nothing"), "lang", "doc_id").alias("x"))
    return with_canonical(shown, line=F.col("x")).select("doc_id", F.sha2("line", 256).alias("canonical_sha256"))


# --- sampling and selection

STRATA = """pop AS (SELECT doc_id, (CASE WHEN lang = 'en' THEN 'word' ELSE 'phrase' END) || '|' || (CASE WHEN n <= 1 THEN '1' WHEN n <= 9 THEN '2-9' WHEN n <= 28 THEN '10-28' ELSE 'sharded' END) AS stratum
  FROM (SELECT doc_id, lang, len(string_split(text, chr(10))) AS n FROM documents)),
c AS (SELECT stratum, count(*) AS n, least(25, count(*)) AS base FROM pop GROUP BY 1),
a AS (SELECT stratum, n, base + greatest(0, least(n - base, CAST(round_even(greatest(0, 300 - sum(base) OVER ()) * n / CAST(sum(n) OVER () AS DOUBLE), 0) AS BIGINT))) AS take FROM c)"""


def _population(spark, sf_dir):
    n = F.size(F.split("text", "\n"))
    word = F.when(F.col("lang") == "en", F.lit("plainword")).otherwise(F.lit("two words"))
    return table(spark, sf_dir, "documents").select("doc_id", sampling.stratum(word, F.array().cast("array<string>"), n).alias("stratum"))


@query(f"WITH {STRATA} SELECT stratum, CAST(n AS BIGINT) AS n, CAST(take AS BIGINT) AS take FROM a")
def stratum_alloc(spark, sf_dir):
    """Shares of a sample by stratum, rounded half to even over a floor."""
    return sampling.allocation(_population(spark, sf_dir), 300).select("stratum", "n", F.col("take").cast("long").alias("take"))


@query(f"""
WITH {STRATA}, p AS (SELECT pop.*, row_number() OVER (PARTITION BY stratum ORDER BY md5('review-v1|' || doc_id), doc_id) AS r FROM pop)
SELECT doc_id, stratum, CAST(n AS DOUBLE) / take AS sampling_weight FROM p JOIN a USING (stratum) WHERE r <= take
""")
def stratified_sample(spark, sf_dir):
    """The sample itself, with weights."""
    return sampling.stratified(_population(spark, sf_dir), 300, "review-v1", key="doc_id").select("doc_id", "stratum", "sampling_weight")


@query("SELECT doc_id, md5('7|' || doc_id) AS k FROM documents ORDER BY k LIMIT 50")
def seeded_sample(spark, sf_dir):
    """A random sample that can be repeated (W4): the least hashes of seed and key."""
    return sampling.random_sample(table(spark, sf_dir, "documents").select("doc_id"), 50, "7", "doc_id").select("doc_id", ids.sample_key("7", F.col("doc_id").cast("string")).alias("k"))


@query("""
WITH p AS (SELECT source, count(*) AS size FROM documents GROUP BY 1), o AS (SELECT source, row_number() OVER (ORDER BY size DESC, source) AS pool FROM p),
d AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5('rr|' || doc_id), doc_id) AS turn FROM documents)
SELECT doc_id, source FROM d JOIN o USING (source) ORDER BY turn, pool LIMIT 40
""")
def round_robin(spark, sf_dir):
    """Rows of each pool in turn."""
    return sampling.round_robin(table(spark, sf_dir, "documents").select("doc_id", "source"), "source", 40, ids.sample_key("rr", F.col("doc_id").cast("string")), F.col("doc_id"))


@query("""
WITH f AS (SELECT doc_id, len(string_split(text, chr(10))) AS lines, text LIKE '%@%' AS mail, text LIKE '%|%' AS tbl FROM documents)
SELECT doc_id, CASE WHEN lines <= 3 AND NOT mail AND NOT tbl THEN 'plain' ELSE concat_ws('+', CASE WHEN lines > 3 THEN 'lines' END, CASE WHEN mail THEN 'mail' END, CASE WHEN tbl THEN 'table' END) END AS signature,
  CAST(least(lines, 8) + CASE WHEN mail THEN 4 ELSE 0 END + CASE WHEN tbl THEN 4 ELSE 0 END AS INTEGER) AS score FROM f
""")
def feature_signature(spark, sf_dir):
    """Signature and score of features."""
    lines, mail, tbl = F.size(F.split("text", "\n")), F.contains("text", F.lit("@")), F.contains("text", F.lit("|"))
    return table(spark, sf_dir, "documents").select("doc_id", sampling.signature(lines=lines > 3, mail=mail, table=tbl).alias("signature"), sampling.score([lines], [mail, tbl]).alias("score"))


@query(f"""
WITH {TOKENS}, c AS (SELECT token, count(*) AS n, min(doc_id * 1000000 + pos) AS first_at FROM tokens GROUP BY 1)
SELECT token, CAST(n AS BIGINT) AS count FROM c ORDER BY n DESC, first_at LIMIT 25
""")
def top_frequencies(spark, sf_dir):
    """The most frequent values, ties by first appearance."""
    return sampling.most_common(tokens(spark, sf_dir).withColumn("at", F.col("doc_id") * 1000000 + F.col("pos")), "token", "at")


ZIPF = f"{TOKENS}, z AS (SELECT token, round(log10(count(*)), 4) AS zipf FROM (SELECT lower(token) AS token FROM tokens WHERE token <> '') GROUP BY 1)"


@query(f"""
WITH {ZIPF}, t AS (SELECT min(zipf) AS bar FROM (SELECT zipf FROM z ORDER BY zipf DESC, token LIMIT 200)),
w AS (SELECT DISTINCT regexp_extract(text, '[A-Za-z]+ [A-Za-z]+', 0) AS word FROM documents), p AS (SELECT word, unnest(string_split(lower(word), ' ')) AS token FROM w WHERE word <> ''),
s AS (SELECT word, count(*) AS n_tokens, CASE WHEN count(*) FILTER (WHERE zipf IS NULL) > 0 THEN 0.0 ELSE round(-log10(sum(pow(10.0, -zipf))), 6) END AS score FROM p LEFT JOIN z USING (token) GROUP BY 1)
SELECT word, round(score, 4) AS score FROM s, t WHERE score >= bar - 1.5
""")
def select_words(spark, sf_dir):
    """Headwords above the frequency of the 200th token, phrases above a bar of their own."""
    words = tokens(spark, sf_dir).filter("token != ''").groupBy(F.lower("token").alias("token")).agg(F.round(F.log10(F.count(F.lit(1))), 4).alias("zipf"))
    bar = selection.threshold(words, 200)
    heads = table(spark, sf_dir, "documents").select(F.regexp_extract("text", "[A-Za-z]+ [A-Za-z]+", 0).alias("word")).filter("word != ''").distinct()
    return selection.selected(heads, words, bar, bar - 1.5).select("word", F.round("score", 4).alias("score"))


# --- reviews

REVIEWS = "r AS (SELECT doc_id, lang AS stratum, CASE WHEN toxic = 1 THEN 'major_issues' WHEN quality = 1 THEN 'pass' ELSE 'minor_issues' END AS verdict, 1.0 + doc_id % 4 AS sampling_weight, CAST(doc_id % 5 + 1 AS INTEGER) AS accuracy FROM labels JOIN documents USING (doc_id))"


def _reviews(spark, sf_dir):
    both = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    return both.select(
        "doc_id", F.col("lang").alias("stratum"), F.when(F.col("toxic") == 1, "major_issues").when(F.col("quality") == 1, "pass").otherwise("minor_issues").alias("verdict"),
        (F.lit(1.0) + F.col("doc_id") % 4).alias("sampling_weight"), F.concat(F.lit('{"accuracy": '), (F.col("doc_id") % 5 + 1).cast("string"), F.lit("}")).alias("scores"),
    )


@query(f"WITH {REVIEWS} SELECT verdict, CAST(count(*) AS BIGINT) AS reviews, CAST(sum(sampling_weight) AS DOUBLE) AS weight, round(avg(accuracy), 2) AS avg_accuracy, round(CAST(sum(sampling_weight) AS DOUBLE) / sum(CAST(sum(sampling_weight) AS DOUBLE)) OVER (), 4) AS share FROM r GROUP BY 1")
def verdict_summary(spark, sf_dir):
    """Reviews by verdict with weighted shares."""
    return audit.verdict_summary(_reviews(spark, sf_dir), "accuracy")


@query(f"WITH {REVIEWS} SELECT stratum, CAST(count(*) AS BIGINT) AS reviews, CAST(count(*) FILTER (WHERE verdict = 'major_issues') AS BIGINT) AS major FROM r GROUP BY 1 ORDER BY 3 DESC, 1")
def stratum_report(spark, sf_dir):
    """Reviews and major issues by stratum (A10)."""
    return audit.stratum_report(_reviews(spark, sf_dir))


@query("SELECT kind, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(string_split(lower(text), ' ')) AS kind FROM conversations) GROUP BY 1 ORDER BY 2 DESC, 1")
def issue_histogram(spark, sf_dir):
    """Elements of nested lists by kind."""
    issues = F.to_json(F.transform(F.split(F.lower("text"), " "), lambda t: F.struct(t.alias("kind"))))
    return audit.issue_histogram(table(spark, sf_dir, "conversations").select(issues.alias("issues")))


@query(f"WITH {ENRICH} SELECT enrichment_id, entry_id, left('failed on ' || props, 200) AS error FROM enrich WHERE status = 'failed' ORDER BY enrichment_id DESC LIMIT 10")
def recent_failures(spark, sf_dir):
    """The newest failures."""
    return audit.recent_failures(enrich(spark, sf_dir).withColumn("error", F.concat(F.lit("failed on "), F.col("props"))))


@query("""
WITH c AS (SELECT conv_id, turn, text FROM conversations), f AS (
  SELECT 'short_explanation' AS "check" FROM c WHERE length(text) < 12 UNION ALL SELECT 'missing_example' FROM c UNION ALL SELECT 'hook_equals_summary' FROM c WHERE trim(text, ' ') <> '')
SELECT "check", CAST(count(*) AS BIGINT) AS n FROM f GROUP BY 1
""")
def audit_findings(spark, sf_dir):
    """Soft faults of responses by check, a turn standing for a response."""
    meaning = F.struct(F.lit("s1").alias("sense_id"), F.lit("common").alias("priority"), F.col("text").alias("learner_explanation"), F.lit(None).cast("string").alias("usage_note"), F.array().cast("array<string>").alias("examples"))
    group = F.struct(F.lit("noun|et1").alias("pos_group_id"), F.array(meaning).alias("meanings"))
    response = F.struct(F.col("text").alias("headword_summary"), F.col("text").alias("memory_hook"), F.array(group).alias("pos_groups"))
    found = table(spark, sf_dir, "conversations").withColumn("r", response).select(F.explode(audit.findings(F.col("r"), F.lit("{}"))).alias("f")).select("f.*")
    return audit.finding_counts(found)


@query(f"WITH {ENRICH} SELECT entry_id, CASE WHEN count(*) FILTER (WHERE status = 'failed') = 0 THEN CAST(CAST(sum(retries) AS BIGINT) AS VARCHAR) END AS retries FROM enrich GROUP BY 1")
def usage_sum_null(spark, sf_dir):
    """A sum that is null if any input is."""
    known = enrich(spark, sf_dir).withColumn("retries", F.when(F.col("status") != "failed", F.col("retries")))
    return latest.usage_sum(known, ["entry_id"], "retries").withColumn("retries", F.col("retries").cast("string"))


@query(f"""
WITH {ENRICH}, c AS (SELECT entry_id, model, count(*) AS n, min(enrichment_id) AS f FROM enrich GROUP BY 1, 2)
SELECT DISTINCT ON (entry_id) entry_id, model FROM c ORDER BY entry_id, n DESC, f
""")
def majority_model(spark, sf_dir):
    """The most frequent value, ties by first appearance."""
    return latest.majority(enrich(spark, sf_dir), ["entry_id"], "model", "enrichment_id")


# --- keyed writes


def _new_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    new = orders.filter("o_orderkey % 7 = 0").select("o_orderkey", "o_custkey", F.round(F.col("o_totalprice") + 1, 2).alias("o_totalprice"))
    return orders, new.unionByName(new.withColumn("o_orderkey", F.col("o_orderkey") + 100000000))


@query("""
WITH n AS (SELECT o_orderkey, o_custkey, round(o_totalprice + 1, 2) AS o_totalprice FROM orders WHERE o_orderkey % 7 = 0), u AS (SELECT * FROM n UNION ALL SELECT o_orderkey + 100000000, o_custkey, o_totalprice FROM n)
SELECT o_orderkey, o_custkey, o_totalprice FROM orders o WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.o_orderkey = o.o_orderkey) UNION ALL SELECT * FROM u
""")
def upsert_merge(spark, sf_dir):
    """Rows in place of those with their keys, besides the rest (K5, K3)."""
    return merge.upserted(*_new_orders(spark, sf_dir), ["o_orderkey"])


@query("""
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus = 'F')
UNION ALL SELECT o_orderkey, 1, -1.0 FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 2 = 0
""")
def replace_children(spark, sf_dir):
    """Children of some parents go, new ones come."""
    parents = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    new = parents.filter("l_orderkey % 2 = 0").select("l_orderkey", F.lit(1).alias("l_linenumber"), F.lit(-1.0).alias("l_quantity"))
    return merge.replaced(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), parents, new, ["l_orderkey"])


@query("SELECT c_custkey, c_name FROM customer c WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_nationkey = c.c_nationkey AND s.s_suppkey = c.c_custkey)")
def delete_using(spark, sf_dir):
    """Rows but those whose two keys are given (K7)."""
    gone = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("c_nationkey"), F.col("s_suppkey").alias("c_custkey"))
    return merge.deleted(table(spark, sf_dir, "customer"), gone, ["c_nationkey", "c_custkey"]).select("c_custkey", "c_name")


@query("SELECT n_nationkey, n_name FROM nation UNION ALL SELECT DISTINCT c_nationkey + 20, 'new' FROM customer WHERE c_nationkey + 20 NOT IN (SELECT n_nationkey FROM nation)")
def insert_if_absent(spark, sf_dir):
    """Rows whose keys aren't there yet (K9)."""
    new = table(spark, sf_dir, "customer").select((F.col("c_nationkey") + 20).alias("n_nationkey"), F.lit("new").alias("n_name"))
    return merge.inserted(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), new, ["n_nationkey"])


# --- generation, export, ingest


@query("""
WITH RECURSIVE s AS (SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i, CAST(o_orderkey % 9 + 1 AS INTEGER) AS n FROM orders),
p AS (SELECT o_custkey, i, n, 1 AS chunk, n AS held FROM s WHERE i = 1
  UNION ALL SELECT s.o_custkey, s.i, s.n, CASE WHEN p.held + s.n <= 12 THEN p.chunk ELSE p.chunk + 1 END, CASE WHEN p.held + s.n <= 12 THEN p.held + s.n ELSE s.n END FROM p JOIN s ON s.o_custkey = p.o_custkey AND s.i = p.i + 1)
SELECT o_custkey, string_agg(CAST(chunk AS VARCHAR), ',' ORDER BY i) AS chunks FROM p GROUP BY 1
""")
def chunk_plan(spark, sf_dir):
    """First fit in order under a budget."""
    groups = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", (F.col("o_orderkey") % 9 + 1).cast("int").alias("n")))).alias("rows"))
    return groups.select("o_custkey", F.array_join(packing.chunk_of_each(F.transform("rows", lambda r: r["n"]), 12).cast("array<string>"), ",").alias("chunks"))


@query("""
WITH f AS (SELECT p_partkey, unnest(string_split(lower(p_type), ' ')) AS tag, p_name FROM part)
SELECT p_partkey, p_name AS text, string_agg(DISTINCT tag, ',' ORDER BY tag) AS tags FROM f GROUP BY 1, 2 HAVING bool_or(tag IN ('plural','comparative','superlative','past','participle','present','third-person','singular')) OR p_partkey % 3 = 0
""")
def form_filter(spark, sf_dir):
    """Forms with a tag of inflection, tags sorted (P9). Every third part has one besides the words of its type."""
    words = F.split(F.lower("p_type"), " ")
    some = F.when(F.col("p_partkey") % 3 == 0, F.array_append(words, F.lit("plural"))).otherwise(words)
    forms = F.array(F.struct(F.col("p_name").alias("form"), some.alias("tags"), F.lit(None).cast("string").alias("roman")))
    picked = table(spark, sf_dir, "part").select("p_partkey", F.explode(export.picked_forms(forms)).alias("f"))
    return picked.select("p_partkey", "f.text", F.array_join(F.array_remove("f.tags", "plural"), ",").alias("tags"))


@query("""
WITH p AS (SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i, CASE WHEN o_orderkey % 4 <> 0 THEN '/' || o_orderkey || '/' END AS ipa,
  CASE o_orderkey % 5 WHEN 0 THEN 'US' WHEN 1 THEN 'UK' WHEN 2 THEN 'General-American' ELSE 'other' END AS tag, 't' || o_orderkey AS txt FROM orders),
k AS (SELECT o_custkey, first(ipa ORDER BY i) FILTER (WHERE ipa IS NOT NULL AND tag IN ('US', 'General-American')) AS us, first(ipa ORDER BY i) FILTER (WHERE ipa IS NOT NULL AND tag IN ('UK', 'Received-Pronunciation')) AS uk, first(coalesce(ipa, '') || '~' || txt ORDER BY i) AS other FROM p GROUP BY 1)
SELECT o_custkey, us, uk, CASE WHEN us IS NULL AND uk IS NULL THEN other END AS other FROM k
""")
def pron_pick(spark, sf_dir):
    """The first American and British ipa, or else the first of all (P10)."""
    key = F.col("o_orderkey")
    tag = F.when(key % 5 == 0, "US").when(key % 5 == 1, "UK").when(key % 5 == 2, "General-American").otherwise("other")
    sound = F.struct(key.alias("i"), F.when(key % 4 != 0, F.concat(F.lit("/"), key.cast("string"), F.lit("/"))).alias("ipa"), F.concat(F.lit("t"), key.cast("string")).alias("pronunciation_text"), F.array(tag).alias("tags"))
    groups = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(sound)).alias("sounds"))
    picked = groups.select("o_custkey", export.picked_pronunciations(F.col("sounds")).alias("p"))
    of = lambda name: F.get(F.filter("p", lambda x: F.array_contains(x["tags"], name)), 0)["ipa"]
    other = F.get(F.filter("p", lambda x: F.size(x["tags"]) == 0), 0)
    return picked.select("o_custkey", of("US").alias("us"), of("UK").alias("uk"), F.when(other.isNotNull(), F.concat(F.coalesce(other["ipa"], F.lit("")), F.lit("~"), other["text"])).alias("other"))


@query("""
SELECT event_id AS source_line, CASE WHEN event_id % 10 = 3 THEN 'invalid_json' WHEN event_id % 10 = 4 THEN 'non_object_json' ELSE 'record' END AS kind,
  CASE WHEN event_id % 10 NOT IN (3, 4) THEN nullif(trim(event_type), '') END AS word, CAST(NULL AS VARCHAR) AS pos FROM events WHERE event_id % 10 <> 5
""")
def ingest_split(spark, sf_dir):
    """Lines as records and anomalies; blank ones go, and a field that is no text is null."""
    good = F.concat(F.lit('{"word": "'), F.col("event_type"), F.lit(' ", "pos": 5}'))
    line = F.when(F.col("event_id") % 10 == 3, '{"word": ').when(F.col("event_id") % 10 == 4, "[1]").when(F.col("event_id") % 10 == 5, "  ").otherwise(good)
    lines = table(spark, sf_dir, "events").select(F.col("event_id").alias("source_line"), F.encode(line, "UTF-8").alias("raw"))
    return jsonl.scan(lines).select("source_line", "kind", "word", "pos")


def _curated(spark, sf_dir):
    """Raw rows whose payload is made of a document, curated."""
    senses = F.transform("glosses", lambda g: F.struct(F.array(g).alias("glosses")))
    payload = F.to_json(F.struct("word", F.col("lang_code").alias("lang"), "lang_code", "pos", "etymology_text", senses.alias("senses")))
    rows = raw(spark, sf_dir).select("id", F.lit("run").alias("run_id"), F.lit("snap").alias("snapshot_id"), F.col("id").alias("source_line"), "word", F.col("lang_code").alias("lang"), "lang_code", "pos", payload.alias("payload"))
    return curate.curate(rows)


KEPT = f"""{RAW}, kept AS (SELECT *, coalesce(etymology_text, '__missing__') AS ety FROM raw WHERE word <> '' AND pos IN ('noun','verb','adj','adv','name','suffix','proverb')),
lines AS (SELECT id, lang_code, lower(word) AS w, pos, ety, unnest(generate_series(1, len(glosses))) AS i, trim(unnest(glosses), chr(32) || chr(9) || chr(10) || chr(13)) AS gloss FROM kept),
groups AS (SELECT lang_code, w, pos, ety, count(DISTINCT gloss) FILTER (WHERE gloss <> '') AS n FROM lines GROUP BY 1, 2, 3, 4),
sized AS (SELECT lang_code, w, CAST(count(*) AS INTEGER) AS n_groups, CAST(sum(n) AS INTEGER) AS n_senses, CAST(count(*) FILTER (WHERE n > 0) AS INTEGER) AS with_senses, CAST(count(DISTINCT ety) AS INTEGER) AS n_etymologies,
  bool_and(pos = 'name') AS all_names, bool_or(pos = 'proverb') AS proverb, bool_or(pos = 'suffix') AS affix FROM groups GROUP BY 1, 2),
heads AS (SELECT lang_code, lower(word) AS w, first(word ORDER BY id) AS word, coalesce(string_agg(DISTINCT CASE pos WHEN 'name' THEN 'entry_type:proper_name' WHEN 'suffix' THEN 'entry_type:affix' WHEN 'proverb' THEN 'entry_type:proverb' END, ','
  ORDER BY CASE pos WHEN 'name' THEN 'entry_type:proper_name' WHEN 'suffix' THEN 'entry_type:affix' WHEN 'proverb' THEN 'entry_type:proverb' END), '') AS flags,
  sha1(from_hex('6ba7b8119dad11d180b400c04fd430c8') || encode(lang_code || '|' || lower(word))) AS d FROM kept GROUP BY lang_code, lower(word)),
ids AS (SELECT lang_code, w, word, flags, d[1:8] || '-' || d[9:12] || '-5' || d[14:16] || '-' || '89ab'[CAST(('0x' || d[17]) AS INTEGER) % 4 + 1] || d[18:20] || '-' || d[21:32] AS entry_id FROM heads)"""


@query(f"WITH {KEPT} SELECT entry_id, word, w AS normalized_word, lang_code, flags, n_groups AS groups, n_senses AS senses FROM ids JOIN sized USING (lang_code, w)")
def curated_entries(spark, sf_dir):
    """Curation end to end."""
    n = F.aggregate("pos_groups", F.lit(0), lambda a, g: a + F.size(g["senses"]))
    return _curated(spark, sf_dir).entries.select("entry_id", "word", "normalized_word", "lang_code", F.array_join("entry_flags", ",").alias("flags"), F.size("pos_groups").alias("groups"), n.alias("senses"))


@query(f"""
WITH {KEPT}
SELECT lang_code, nullif(lower(word), '') AS word, CASE WHEN word = '' THEN 'missing_lexical_identity' WHEN pos = 'conj' THEN 'unknown_pos' ELSE 'record_type_out_of_scope' END AS reason_code,
  CASE WHEN word = '' OR pos = 'conj' THEN 'high' WHEN pos = 'character' THEN 'low' ELSE 'medium' END AS severity,
  CASE WHEN word = '' THEN 'defer' WHEN pos = 'conj' THEN 'requires_rule_update' WHEN pos = 'character' THEN 'drop' ELSE 'convert_to_relation' END AS suggested_action, pos, CAST(NULL AS VARCHAR) AS sense_index
FROM raw WHERE word = '' OR pos IN ('romanization', 'character', 'conj')
UNION ALL SELECT lang_code, w, 'missing_gloss', 'medium', 'defer', pos, CAST(i AS VARCHAR) FROM lines WHERE gloss = ''
""")
def triage_items(spark, sf_dir):
    """Rows and senses set aside."""
    found = _curated(spark, sf_dir).triage
    return found.select("lang_code", "word", "reason_code", "severity", "suggested_action", "payload.pos", F.col("payload.sense_index").cast("string").alias("sense_index"))


NUMBERED = f"""{KEPT}, senses AS (SELECT lang_code, w, pos, ety, gloss, min(struct_pack(id := id, i := i)) AS f FROM lines WHERE gloss <> '' GROUP BY ALL),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang_code, w, pos, ety ORDER BY f.id, f.i) AS n FROM senses),
ety_at AS (SELECT lang_code, w, ety, 'et' || row_number() OVER (PARTITION BY lang_code, w ORDER BY min(id)) AS et FROM lines GROUP BY 1, 2, 3),
held AS (SELECT lang_code, w, pos, et, row_number() OVER (PARTITION BY lang_code, w ORDER BY pos, et) AS g, string_agg('s' || n || '=' || gloss, '|' ORDER BY n) AS shown
  FROM placed JOIN ety_at USING (lang_code, w, ety) GROUP BY 1, 2, 3, 4)"""


def _made(spark, sf_dir):
    """Entries through a stand-in generator, which repeats the gloss, into documents."""
    bundle = generate.Bundle("v1", "zh-Hans", "Chinese (Simplified)")
    entries = written(_curated(spark, sf_dir).entries, "catalog-entries")
    log = written(generate.enriched(entries, None, bundle, "run"), "catalog-log")
    return export.distribution(entries, log, [bundle]).documents


@query(f"""
WITH {NUMBERED}, all_of AS (SELECT lang_code, w, md5(string_agg(pos || ':' || et || ':' || shown, '#' ORDER BY pos, et)) AS groups_md5, count(*) AS n FROM held GROUP BY 1, 2)
SELECT entry_id, word AS headword, CASE WHEN proverb THEN 'proverb' WHEN affix THEN 'affix' WHEN all_names THEN 'proper_name' ELSE 'standard' END AS entry_type, groups_md5, CAST(n AS INTEGER) AS groups, n_etymologies AS etymologies
FROM ids JOIN sized USING (lang_code, w) JOIN all_of USING (lang_code, w)
""")
def distribution_docs(spark, sf_dir):
    """Entries through a stand-in generator into documents: groups in order with the senses joined by id."""
    d = _made(spark, sf_dir).select("document.*")
    sense = lambda m: F.concat(m["sense_id"], F.lit("="), m["short_gloss"])
    shown = F.transform("pos_groups", lambda g: F.concat_ws(":", g["pos"], g["etymology_id"], F.array_join(F.transform(g["meanings"], sense), "|")))
    return d.select("entry_id", "headword", "entry_type", F.md5(F.array_join(shown, "#")).alias("groups_md5"), F.size("pos_groups").alias("groups"), F.size("etymologies").alias("etymologies"))


@query(f"""
WITH {NUMBERED} SELECT entry_id, CAST(g AS INTEGER) AS pos_group_index, 's' || n AS sense_id, CAST(n AS INTEGER) AS meaning_index, CASE WHEN n_senses > 28 AND g = 1 AND n = 1 THEN 'core' ELSE 'common' END AS priority, gloss AS short_gloss
FROM sized JOIN placed USING (lang_code, w) JOIN ety_at USING (lang_code, w, ety) JOIN held USING (lang_code, w, pos, et) JOIN ids USING (lang_code, w)
""")
def shred_children(spark, sf_dir):
    """Documents as rows of tables, indexes from 1; of entries over the sharding threshold the overview's sense is core."""
    return export.shredded(_made(spark, sf_dir))["meanings"].select("entry_id", "pos_group_index", "sense_id", "meaning_index", "priority", "short_gloss")
