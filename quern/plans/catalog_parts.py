"""More registered queries: transforms of nested parts, validators, text functions, tables and files, each beside its SQL."""

from __future__ import annotations

import os
import tempfile
import uuid
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions import ids, text
from quern.operators import curate, export, generate, latest, merge, nested, packing, sampling, validate
from quern.plans import registry, stages
from quern.plans.catalog import ENRICH, KEPT, _curated, enrich, query, raw
from quern.schemas import RAW_EXAMPLE, RAW_RECORD, RAW_RELATION, RAW_SENSE, RAW_SOUND, array
from quern.session import shared_dir, table
from quern.sources import jsonl

# --- nested parts; a document stands for a raw record, its words or lines for the elements

WORDS = "words AS (SELECT doc_id, unnest(generate_series(0, len(w) - 1)) AS i, unnest(w) AS x FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents))"


def _of(kind, **fields: Column) -> Column:
    """A struct of the type given; fields left out are null."""
    return F.struct(*[fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in kind.fields])


def _words(spark, sf_dir):
    return table(spark, sf_dir, "documents").withColumn("w", F.split("text", " "))


def _relations(places: int) -> Column:
    """The words at even (0) or odd (1) places as raw relations."""
    some = F.filter(F.transform("w", lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda p: p["i"] % 2 == places)
    return F.transform(some, lambda p: _of(RAW_RELATION, word=p["x"]))


def _shown(relations: Column) -> Column:
    return F.md5(F.array_join(F.transform(relations, lambda r: F.concat_ws(":", r["relation_type"], r["target_word"], r["source_scope"])), ","))


@query(f"""
WITH {WORDS}, s AS (SELECT doc_id, i, CASE WHEN i % 3 = 0 THEN '/' || x || '/' END AS ipa, CASE WHEN i % 3 = 1 THEN x END AS txt, CASE WHEN i % 4 = 0 THEN 'u' || x END AS url FROM words WHERE i % 3 <> 2 OR i % 4 = 0),
u AS (SELECT doc_id, ipa, txt, url, min(i) AS f FROM s GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY f) AS n, count(*) OVER (PARTITION BY doc_id) AS total FROM u)
SELECT doc_id, CAST(count(*) AS INTEGER) AS n, any_value(total) > 8 AS trimmed, md5(string_agg(coalesce(ipa, '') || '~' || coalesce(txt, '') || '~' || coalesce(url, '') || '~' || CASE WHEN url IS NULL THEN '' ELSE 'mp3preferred_audio' END, ',' ORDER BY n)) AS kept_md5
FROM r WHERE n <= 8 GROUP BY 1
""")
def pronunciations(spark, sf_dir):
    """Sounds with any of ipa, text and audio, each once, at most 8, flagged."""
    audio = lambda i: i % 4 == 0
    sounds = F.transform("w", lambda x, i: _of(RAW_SOUND, ipa=F.when(i % 3 == 0, F.concat(F.lit("/"), x, F.lit("/"))), pronunciation_text=F.when(i % 3 == 1, x), audio_url=F.when(audio(i), F.concat(F.lit("u"), x)), ogg=F.lit(False), mp3=audio(i), wav=F.lit(False), tags=F.array()))
    made = _words(spark, sf_dir).select("doc_id", nested.pronunciations(F.struct(sounds.alias("sounds"))).alias("p"))
    known = lambda c: F.coalesce(c, F.lit(""))
    own = lambda p: F.concat_ws("~", known(p["ipa"]), known(p["pronunciation_text"]), known(p["audio_url"]), F.concat(known(p["audio_format"]), F.array_join(F.array_remove(p["pronunciation_flags"], "trimmed_audio_set"), "")))
    return made.select("doc_id", F.size("p.items").alias("n"), (F.size("p.flags") > 0).alias("trimmed"), F.md5(F.array_join(F.transform("p.items", own), ",")).alias("kept_md5"))


@query(f"""
WITH {WORDS}, r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, i % 2 ORDER BY i) AS n FROM words)
SELECT doc_id, CAST(count(*) AS INTEGER) AS n, md5(string_agg(CASE WHEN i % 2 = 0 THEN 'derived_term:' ELSE 'synonym:' END || x || ':entry', ',' ORDER BY i % 2, i)) AS kept_md5 FROM r WHERE n <= 24 GROUP BY 1
""")
def entry_relations(spark, sf_dir):
    """Top-level relations in the order of their fields, 24 of a type, repeats and all."""
    none = F.array().cast(array(RAW_RELATION))
    record = F.struct(_relations(0).alias("derived"), none.alias("related"), _relations(1).alias("synonyms"), none.alias("antonyms"))
    made = _words(spark, sf_dir).select("doc_id", nested.entry_relations(record).alias("r"))
    return made.select("doc_id", F.size("r").alias("n"), _shown(F.col("r")).alias("kept_md5"))


@query(f"""
WITH {WORDS}, u AS (SELECT doc_id, i % 2 AS k, x, min(i) AS f FROM words GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, k ORDER BY f) AS n FROM u)
SELECT doc_id, CAST(count(*) AS INTEGER) AS n, md5(string_agg(CASE k WHEN 0 THEN 'form_of:' ELSE 'alternative_of:' END || x || ':sense', ',' ORDER BY k, f)) AS kept_md5 FROM r WHERE n <= 24 GROUP BY 1
""")
def sense_relations(spark, sf_dir):
    """Relations of a sense, each once and then 24 of a type."""
    sense = F.struct(_relations(0).alias("form_of"), _relations(1).alias("alt_of"), F.array().cast(array(RAW_RELATION)).alias("compound_of"))
    made = _words(spark, sf_dir).select("doc_id", nested.sense_relations(sense).alias("r"))
    return made.select("doc_id", F.size("r").alias("n"), _shown(F.col("r")).alias("kept_md5"))


@query("""
WITH i AS (SELECT l_suppkey, l_returnflag AS t, l_partkey AS w, l_linestatus AS s, min(struct_pack(a := l_orderkey, b := l_linenumber)) AS f FROM lineitem GROUP BY 1, 2, 3, 4),
r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey, t ORDER BY f, w, s) AS n FROM i)
SELECT l_suppkey, CAST(count(*) AS INTEGER) AS n, md5(string_agg(t || ':' || w || ':' || s, ',' ORDER BY f, w, t, s)) AS kept_md5 FROM r WHERE n <= 24 GROUP BY 1
""")
def merged_relations(spark, sf_dir):
    """Relations of all groups put together, each once, then 24 of a type."""
    item = F.struct("l_orderkey", "l_linenumber", F.col("l_partkey").alias("w"), F.col("l_returnflag").alias("t"), F.col("l_linestatus").alias("s"))
    groups = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.array_sort(F.collect_list(item)).alias("items"))
    some = F.transform("items", lambda x: F.struct(x["t"].alias("relation_type"), x["w"].cast("string").alias("target_word"), F.lit(None).cast("string").alias("target_lang_code"), x["s"].alias("source_scope")))
    made = groups.select("l_suppkey", nested.dedupe_relations(some).alias("r"))
    return made.select("l_suppkey", F.size("r").alias("n"), _shown(F.col("r")).alias("kept_md5"))


@query("""
WITH l AS (SELECT doc_id, unnest(generate_series(0, len(g) - 1)) AS i, unnest(g) AS x FROM (SELECT doc_id, string_split(text, chr(10)) AS g FROM documents))
SELECT doc_id, CAST(count(*) FILTER (WHERE x <> '') AS INTEGER) AS n, md5(coalesce(string_agg(x || '~' || CASE WHEN i % 2 = 0 THEN 't' || i ELSE '' END || '~' || concat_ws('+', CASE WHEN i % 3 = 0 THEN 'quote' END, CASE WHEN i % 4 = 0 THEN 'machine_translation' END), '|' ORDER BY i) FILTER (WHERE x <> ''), '')) AS kept_md5
FROM l GROUP BY 1
""")
def sense_examples(spark, sf_dir):
    """Examples with a text, their translations and flags."""
    items = F.transform(F.split("text", "\n"), lambda x, i: _of(RAW_EXAMPLE, text=F.nullif(x, F.lit("")), translation=F.when(i % 2 == 0, F.concat(F.lit("t"), i.cast("string"))), has_english=i % 4 == 0, type=F.when(i % 3 == 0, F.lit("quote"))))
    made = table(spark, sf_dir, "documents").select("doc_id", nested.examples(items).alias("e"))
    own = lambda e: F.concat_ws("~", e["text"], F.coalesce(e["translation"], F.lit("")), F.array_join(e["example_flags"], "+"))
    return made.select("doc_id", F.size("e").alias("n"), F.md5(F.array_join(F.transform("e", own), "|")).alias("kept_md5"))


@query("""
SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'figurative' WHEN 1 THEN 'archaic,figurative' WHEN 2 THEN 'archaic' WHEN 3 THEN '' WHEN 4 THEN 'figurative' ELSE 'archaic' END AS flags FROM documents
""")
def sense_flags(spark, sf_dir):
    """Flags of a sense by its tags."""
    kinds = (("figurative",), ("figuratively", "obsolete"), ("archaic", "x"), ("x",), ("figurative", "figuratively"), ("obsolete", "archaic"))
    tags = F.get(F.array(*[F.array(*map(F.lit, k)) for k in kinds]), (F.col("doc_id") % 6).cast("int"))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(nested.sense_flags(tags), ",").alias("flags"))


@query("""
WITH r AS (SELECT p_partkey, p_name, ['derived_term', 'coordinate', 'synonym', 'form_of', 'descendant', 'antonym', 'related_term'][CAST(p_partkey % 7 AS INTEGER) + 1] AS t FROM part)
SELECT p_partkey, CASE WHEN t IN ('coordinate', 'form_of') THEN '' ELSE t || ':' || p_name || ',' END || 'synonym:always' AS relations FROM r
""")
def relation_whitelist(spark, sf_dir):
    """Relations of the types that documents carry."""
    kinds = F.array(*map(F.lit, ("derived_term", "coordinate", "synonym", "form_of", "descendant", "antonym", "related_term")))
    item = lambda kind, word: F.struct(kind.alias("relation_type"), word.alias("target_word"), F.lit(None).cast("string").alias("target_lang_code"))
    items = F.array(item(F.get(kinds, (F.col("p_partkey") % 7).cast("int")), F.col("p_name")), item(F.lit("synonym"), F.lit("always")))
    shown = F.transform(export.picked_relations(items), lambda r: F.concat_ws(":", r["type"], r["word"]))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(shown, ",").alias("relations"))


@query("""
WITH s AS (SELECT doc_id, unnest(generate_series(1, len(g))) AS i, unnest(g) AS x FROM (SELECT doc_id, string_split(text, chr(10)) AS g FROM documents))
SELECT doc_id, CAST(count(*) FILTER (WHERE x <> '' OR i % 2 = 0) AS INTEGER) AS n, md5(coalesce(string_agg('s' || i || '=' || CASE WHEN x <> '' THEN x ELSE 'raw' || i END || CASE WHEN i % 2 = 0 THEN '~raw' || i ELSE '' END, '|' ORDER BY i) FILTER (WHERE x <> '' OR i % 2 = 0), '')) AS senses_md5 FROM s GROUP BY 1
""")
def record_senses(spark, sf_dir):
    """Senses with a gloss, or else a raw gloss; ids are places among all senses."""
    none = F.array().cast("array<string>")
    senses = F.transform(F.split("text", "\n"), lambda x, i: _of(RAW_SENSE, glosses=F.when(x != "", F.array(x)).otherwise(none), raw_glosses=F.when(i % 2 == 1, F.array(F.concat(F.lit("raw"), (i + 1).cast("string")))).otherwise(none), **{f: none for f in ("tags", "topics")}, examples=F.array(), **{f: F.array() for f in ("form_of", "alt_of", "compound_of")}))
    made = table(spark, sf_dir, "documents").select("doc_id", nested.senses(_of(RAW_RECORD, senses=senses)).alias("s"))
    own = lambda s: F.concat(s["sense_id"], F.lit("="), s["gloss"], F.coalesce(F.concat(F.lit("~"), s["raw_gloss"]), F.lit("")))
    return made.select("doc_id", F.size("s").alias("n"), F.md5(F.array_join(F.transform("s", own), "|")).alias("senses_md5"))


@query("""
SELECT c_custkey, c_name || '|,x' || c_custkey || '|en' AS derived, c_name AS word, lower(c_name) AS folded, CASE WHEN c_custkey % 2 = 0 THEN 'g' ELSE 'h' END AS gloss, CAST(1 AS INTEGER) AS n_senses FROM customer
""")
def strict_records(spark, sf_dir):
    """Payloads read strictly: relations as objects or bare texts, glosses as a list or one text; what is no text is null."""
    name, key = F.col("c_name"), F.col("c_custkey").cast("string")
    gloss = F.when(F.col("c_custkey") % 2 == 0, F.lit('"glosses": [" ", " g "]')).otherwise(F.lit('"glosses": " h "'))
    payload = F.concat(F.lit('{"word": " '), name, F.lit(' ", "lang_code": 5, "derived": ["'), name, F.lit('", {"word": " x'), key, F.lit(' ", "lang_code": "en"}, {"word": 5}, 7, " "], "senses": [{'), gloss, F.lit("}]}"))
    read = jsonl.with_record(table(spark, sf_dir, "customer").select("c_custkey", payload.alias("payload")))
    shown = F.transform("record.derived", lambda r: F.concat(r["word"], F.lit("|"), F.coalesce(r["lang_code"], F.lit(""))))
    return read.select("c_custkey", F.array_join(shown, ",").alias("derived"), "record.word", F.col("record.word_folded").alias("folded"), nested.gloss(F.get("record.senses", 0)).alias("gloss"), F.size("record.senses").alias("n_senses"))


# --- text functions


@query(r"""
SELECT page_id, regexp_extract(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '([^/]*)$', 1) AS file_name, regexp_replace(url, '[^A-Za-z0-9._-]+', '_', 'g') AS suffix FROM pages
""")
def url_names(spark, sf_dir):
    """The last part of a URL's path; a text made fit for a version name."""
    return table(spark, sf_dir, "pages").select("page_id", F.coalesce(text.file_name(F.col("url")), F.lit("")).alias("file_name"), text.version_suffix(F.col("url")).alias("suffix"))


@query("""
SELECT p_partkey, lower(p_name) AS folded, CASE WHEN p_partkey % 3 = 0 THEN '_' ELSE p_brand END || '|' || CASE WHEN p_partkey % 4 = 0 THEN '_' ELSE 'et' || p_size END AS group_id,
  CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE p_brand END AS first_text, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_brand || ' ' END || p_name AS joined FROM part
""")
def text_keys(spark, sf_dir):
    """Case folding, group ids, the first text and texts joined; what is blank doesn't count."""
    blank = F.lit("\t 　\x1f")
    brand = F.when(F.col("p_partkey") % 3 == 0, blank).otherwise(F.concat(F.lit("\t"), "p_brand", F.lit("\x1d")))
    et = F.when(F.col("p_partkey") % 4 == 0, blank).otherwise(F.concat(F.lit("et"), F.col("p_size").cast("string")))
    texts = F.array(blank, brand, F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", text.casefold(F.concat(F.lit(" "), F.upper("p_name"))).alias("folded"), ids.group_id(brand, et).alias("group_id"), text.first_text(texts).alias("first_text"), text.joined_text(texts).alias("joined"))


@query("""
WITH l AS (SELECT doc_id, unnest(generate_series(1, len(g))) AS i, trim(unnest(g), chr(32) || chr(9) || chr(10) || chr(13)) AS x FROM (SELECT doc_id, string_split(text, chr(10)) AS g FROM documents)),
u AS (SELECT doc_id, x, min(i) AS f FROM l WHERE x <> '' GROUP BY 1, 2)
SELECT doc_id, CAST(count(x) AS INTEGER) AS n, md5(coalesce(string_agg(x, '|' ORDER BY f), '')) AS kept_md5 FROM documents LEFT JOIN u USING (doc_id) GROUP BY 1
""")
def text_lists(spark, sf_dir):
    """Texts of a list stripped, without blanks, each once."""
    made = table(spark, sf_dir, "documents").select("doc_id", text.text_list(F.split("text", "\n")).alias("t"))
    return made.select("doc_id", F.size("t").alias("n"), F.md5(F.array_join("t", "|")).alias("kept_md5"))


# --- validators; a customer's key says what is wrong with its payload

_HELD = "x AS (SELECT c_custkey AS k FROM customer)"


def _payloads(spark, sf_dir, validator, payload: Column, *more: Column):
    made = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), payload.alias("payload"), *[m.alias(f"m{i}") for i, m in enumerate(more)])
    return made.select("k", validate.validated(validator, F.col("payload"), *[F.col(f"m{i}") for i in range(len(more))]).alias("v")).select("k", "v.ok", "v.error", "v.normalized")


def _if(every: int, then: str, other: str) -> Column:
    return F.when(F.col("c_custkey") % every == 0, F.lit(then)).otherwise(F.lit(other))


TARGETS = '[{"pos_group_id": "noun|et1", "pos": "noun", "sense_ids": ["s1", "s2"]}]'
FIELDS = '"headword_summary": "a", "memory_hook": "b", "study_notes": null, "etymology_note": ["c", " d "]'


def _groups() -> Column:
    meaning = lambda sense, priority: F.concat(F.lit('{"sense_id": "'), sense, F.lit('", "priority": "'), priority, F.lit('", "short_gloss": " ", "learner_explanation": "e", "usage_note": null, "examples": null}'))
    return F.concat(
        F.lit('"pos_groups": [{"pos_group_id": "'), _if(7, "verb|et1", "noun|et1"), F.lit('", "pos": "n", "summary": "'), _if(5, "�", "s"), F.lit('", "usage_note": null, "meanings": ['),
        meaning(F.lit("s2"), _if(13, "top", " CORE ")), F.lit(", "), meaning(_if(11, "s2", "s1"), F.lit("rare")), F.lit("]}]"),
    )


FAULTS = """CASE WHEN k % 5 = 0 THEN '{0}: holds U+FFFD, the mark of damaged output' WHEN k % 7 = 0 THEN 'pos_groups: unexpected pos_group_id verb|et1'
  WHEN k % 13 = 0 THEN 'meaning s2: priority must be one of [''core'', ''common'', ''rare'']' WHEN k % 11 = 0 THEN 'group noun|et1 meanings: duplicate sense_id s2' END"""


@query(f"WITH {_HELD}, e AS (SELECT k, {FAULTS.replace('{0}', 'response')} AS error FROM x) SELECT k, error IS NULL AS ok, error, CASE WHEN error IS NULL THEN 's1 rare,s2 core;noun;[];c d' END AS shown FROM e")
def response_faults(spark, sf_dir):
    """Responses against their skeleton: faults, and what is put right (V1)."""
    found = _payloads(spark, sf_dir, validate.response, F.concat(F.lit("{" + FIELDS + ", "), _groups(), F.lit("}")), F.lit(TARGETS))
    at = lambda p: F.get_json_object("normalized", p)
    meaning = lambda i: F.concat_ws(" ", at(f"$.pos_groups[0].meanings[{i}].sense_id"), at(f"$.pos_groups[0].meanings[{i}].priority"))
    shown = F.concat_ws(";", F.concat_ws(",", meaning(0), meaning(1)), at("$.pos_groups[0].pos"), at("$.study_notes"), at("$.etymology_note"))
    return found.select("k", "ok", "error", F.when(F.col("ok"), shown).alias("shown"))


@query(f"WITH {_HELD}, e AS (SELECT k, {FAULTS.replace('{0}', 'chunk')} AS error FROM x) SELECT k, error IS NULL AS ok, error FROM e")
def chunk_faults(spark, sf_dir):
    """Chunks of a response (V3)."""
    return _payloads(spark, sf_dir, validate.chunk, F.concat(F.lit("{"), _groups(), F.lit("}")), F.lit(TARGETS)).select("k", "ok", "error")


@query(f"""
WITH {_HELD}, e AS (SELECT k, CASE WHEN k % 5 = 0 THEN 'core_senses: must be 1 to 5' WHEN k % 7 = 0 THEN 'core_senses: unknown sense noun|et1/s9' END AS error FROM x)
SELECT k, error IS NULL AS ok, error, CASE WHEN error IS NULL THEN '[{{"pos_group_id":"noun|et1","sense_id":"s1"}}]' END AS core FROM e
""")
def overview_faults(spark, sf_dir):
    """Overviews: core senses of the skeleton, each once, one to five (V2)."""
    pair = '{"pos_group_id": "noun|et1", "sense_id": " s1 "}'
    core = F.when(F.col("c_custkey") % 5 == 0, F.lit("[]")).otherwise(F.concat(F.lit(f"[{pair}, "), _if(7, pair.replace(" s1 ", "s9"), pair), F.lit("]")))
    found = _payloads(spark, sf_dir, validate.overview, F.concat(F.lit("{" + FIELDS + ', "core_senses": '), core, F.lit("}")), F.lit(TARGETS))
    return found.select("k", "ok", "error", F.get_json_object("normalized", "$.core_senses").alias("core"))


@query(f"""
WITH {_HELD}, e AS (SELECT k, CASE WHEN k % 19 = 0 THEN 'review: lacks [''issues'']' WHEN k % 7 IN (0, 6) THEN 'scores.accuracy: must be an integer from 1 to 5' WHEN k % 11 = 0 THEN 'priority_ok: must be a boolean'
  WHEN k % 13 = 0 THEN 'verdict: must be one of [''pass'', ''minor_issues'', ''major_issues'']' WHEN k % 17 = 0 THEN 'issues: need a note' END AS error FROM x)
SELECT k, error IS NULL AS ok, error, CASE WHEN error IS NULL THEN '{{"issues": [{{"kind": "other", "location": "x", "note": "n"}}], "priority_ok": true, "scores": {{"accuracy": ' || k % 7 || ', "chinese_quality": 1, "examples": 4, "explanations": 3, "usage_notes": 5}}, "verdict": "pass"}}' END AS normalized FROM e
""")
def review_faults(spark, sf_dir):
    """Reviews: integer scores, verdicts and issues (V5)."""
    payload = F.concat(
        F.lit('{"scores": {"accuracy": '), (F.col("c_custkey") % 7).cast("string"), F.lit(', "explanations": 3, "examples": 4, "usage_notes": 5, "chinese_quality": 1}, "priority_ok": '), _if(11, '"yes"', "true"), F.lit(', "verdict": "'), _if(13, "fine", " PASS "),
        F.lit('", "'), _if(19, "no", "issues"), F.lit('": [{"kind": "odd", "location": "x", "note": "'), _if(17, " ", "n"), F.lit('"}]}'),
    )
    return _payloads(spark, sf_dir, validate.review, payload)


@query(f"""
WITH {_HELD}, e AS (SELECT k, CASE WHEN k % 5 = 0 THEN 'document: must not carry [''model'']' WHEN k % 7 = 0 THEN 'schema_version: must be distribution_entry_v5' WHEN k % 11 = 0 THEN 'entry_type: must be one of [''standard'', ''proverb'', ''affix'', ''proper_name'']'
  WHEN k % 13 = 0 THEN 'pos_groups[1]: a pronunciation needs ipa or text' WHEN k % 17 = 0 THEN 'pos_groups[1]: duplicate sense_id' WHEN k % 19 = 0 THEN 'pos_groups[1]: relation type must be one of [''derived_term'', ''related_term'', ''synonym'', ''antonym'', ''descendant'']' END AS error FROM x)
SELECT k, error IS NULL AS ok, error FROM e
""")
def document_faults(spark, sf_dir):
    """Distribution documents: the first fault of each (V4)."""
    meaning = lambda sense: F.concat(F.lit('{"sense_id": "'), sense, F.lit('", "priority": "core", "short_gloss": null, "learner_explanation": "e", "usage_note": null, "labels": [], "topics": [], "examples": []}'))
    payload = F.concat(
        F.lit('{"'), _if(5, "model", "extra"), F.lit('": 1, "schema_version": "'), _if(7, "v4", validate.DOCUMENT_VERSION), F.lit('", "entry_type": "'), _if(11, "odd", "affix"),
        F.lit('", "entry_id": "i", "headword": "h", "normalized_headword": "h", "headword_language": {"code": "a", "name": "b"}, "definition_language": {"code": "a", "name": "b"}, "headword_summary": "s", "memory_hook": "m", "study_notes": [], "etymology_note": null, "etymologies": [], '
              '"pos_groups": [{"pos": "noun", "etymology_id": null, "proper_name": false, "summary": "s", "usage_note": null, "forms": [], "pronunciations": [{"ipa": '), _if(13, "null", '"x"'),
        F.lit(', "text": null, "tags": []}], "relations": [{"type": "'), _if(19, "form_of", "synonym"), F.lit('", "word": "w", "lang_code": null}], "meanings": ['), meaning(F.lit("s1")), F.lit(", "), meaning(_if(17, "s1", "s2")), F.lit("]}]}"),
    )
    return _payloads(spark, sf_dir, validate.document, payload).select("k", "ok", "error")


# --- generation, sampling, exports


@query("""
WITH RECURSIVE s AS (SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i, CAST(o_orderkey % 31 AS INTEGER) AS n FROM orders),
p AS (SELECT o_custkey, CAST(0 AS BIGINT) AS i, 0 AS first_chunk, 0 AS chunk, 0 AS held, FALSE AS open FROM s WHERE i = 1
  UNION ALL SELECT s.o_custkey, s.i, CASE WHEN s.n > 12 THEN p.chunk + 1 WHEN p.open AND p.held + s.n <= 12 THEN p.chunk ELSE p.chunk + 1 END,
    CASE WHEN s.n > 12 THEN p.chunk + CAST(ceil(s.n / 12.0) AS INTEGER) WHEN p.open AND p.held + s.n <= 12 THEN p.chunk ELSE p.chunk + 1 END, CASE WHEN s.n > 12 THEN 0 WHEN p.open AND p.held + s.n <= 12 THEN p.held + s.n ELSE s.n END, s.n <= 12
  FROM p JOIN s ON s.o_custkey = p.o_custkey AND s.i = p.i + 1)
SELECT p.o_custkey, CAST(max(p.chunk) AS INTEGER) AS chunks, string_agg(p.first_chunk || '-' || p.chunk, ',' ORDER BY p.i) AS plan FROM p WHERE p.i > 0 GROUP BY 1
""")
def chunk_slices(spark, sf_dir):
    """First fit in order, groups over the budget cut in slices of their own."""
    groups = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", (F.col("o_orderkey") % 31).cast("int").alias("n")))).alias("rows"))
    plan = groups.select("o_custkey", packing.chunk_plan(F.transform("rows", lambda r: r["n"]), 12).alias("p"), F.size("rows").alias("n"))
    of = lambda g: F.transform(F.filter("p", lambda x: x["group"] == g), lambda x: x["chunk"])
    shown = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda g: F.concat_ws("-", F.array_min(of(g)).cast("string"), F.array_max(of(g)).cast("string")))
    return plan.select("o_custkey", F.array_max(F.transform("p", lambda x: x["chunk"])).alias("chunks"), F.array_join(shown, ",").alias("plan"))


@query(f"""
WITH {KEPT}, ety_at AS (SELECT lang_code, w, ety, 'et' || row_number() OVER (PARTITION BY lang_code, w ORDER BY min(id)) AS et FROM lines GROUP BY 1, 2, 3),
t AS (SELECT lang_code, w, string_agg(pos || '|' || et || '=' || n, ',' ORDER BY pos, et) AS targets FROM groups JOIN ety_at USING (lang_code, w, ety) GROUP BY 1, 2)
SELECT entry_id, word AS headword, targets, 'v2_pt-BR' AS prompt_version, 'pt-BR' AS code FROM ids JOIN t USING (lang_code, w)
""")
def request_payloads(spark, sf_dir):
    """What a generator is asked: headword, language, targets by group with the number of senses."""
    made = generate.requests(_curated(spark, sf_dir).entries, generate.Bundle("v2", "pt-BR", "Portuguese"))
    targets = F.from_json("targets", "array<struct<pos_group_id:string,sense_ids:array<string>>>")
    at = lambda p: F.get_json_object("request_payload", p)
    return made.select("entry_id", at("$.entry.headword").alias("headword"), F.array_join(F.transform(targets, lambda t: F.concat_ws("=", t["pos_group_id"], F.size(t["sense_ids"]).cast("string"))), ",").alias("targets"), at("$.prompt_version").alias("prompt_version"), at("$.definition_language.code").alias("code"))


@query("""
WITH s AS (SELECT doc_id, source, lang, md5('p|' || doc_id) AS k FROM documents), t AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY k, doc_id) AS spot FROM s), top AS (SELECT * FROM t WHERE spot <= 8),
o AS (SELECT source, row_number() OVER (ORDER BY count(*) DESC, source) AS pool FROM top GROUP BY 1), a AS (SELECT doc_id FROM top JOIN o USING (source) ORDER BY spot, pool LIMIT 30),
b AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY k, doc_id) AS spot FROM s QUALIFY spot <= 20), r AS (SELECT doc_id, lang, k FROM b WHERE doc_id NOT IN (SELECT doc_id FROM a)),
q AS (SELECT lang, row_number() OVER (ORDER BY count(*) DESC, lang) AS pool FROM r GROUP BY 1), c AS (SELECT r.doc_id, row_number() OVER (ORDER BY n, pool) AS place FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY k, doc_id) AS n FROM r) r JOIN q USING (lang))
SELECT doc_id FROM a UNION ALL SELECT doc_id FROM c WHERE place <= 20
""")
def two_phases(spark, sf_dir):
    """In turn across sources, of each the first 8, then across languages among those not taken, 50 in all."""
    key = ids.sample_key("p", F.col("doc_id").cast("string"))
    return sampling.two_phase(table(spark, sf_dir, "documents").select("doc_id", "source", "lang"), "doc_id", "source", "lang", 50, 30, 8, 20, key, F.col("doc_id")).select("doc_id")


@query("""
SELECT '{"c_custkey": ' || c_custkey || ', "c_name": "' || c_name || '", "nothing": null, "tags": ["' || c_mktsegment || '", "x"]}' AS line FROM customer ORDER BY c_nationkey, c_custkey
""")
def ordered_lines(spark, sf_dir):
    """Canonical JSON, a row a line, in order."""
    document = F.struct("c_name", F.array("c_mktsegment", F.lit("x")).alias("tags"), F.lit(None).cast("string").alias("nothing"), "c_custkey")
    return export.lines(table(spark, sf_dir, "customer").withColumn("document", document), "document", ("c_nationkey", "c_custkey"))


@query(f"""
WITH {ENRICH}, l AS (SELECT DISTINCT ON (entry_id) entry_id, enrichment_id, model, input_hash FROM enrich WHERE status = 'succeeded' ORDER BY entry_id, created_at DESC, enrichment_id DESC)
SELECT CAST(c_custkey AS VARCHAR) AS entry_id, c_name AS word, CAST(enrichment_id AS VARCHAR) AS enrichment_id, model FROM customer LEFT JOIN l ON entry_id = c_custkey
""")
def audit_export(spark, sf_dir):
    """Entries with their newest response whole, also those without one."""
    entries = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entry_id"), F.col("c_name").alias("word"), F.lit("en").alias("lang_code"), F.lower("c_name").alias("normalized_word"))
    log = enrich(spark, sf_dir).withColumns({"prompt_version": F.lit("v1"), "response_payload": F.col("props"), "generation_metadata": F.lit("{}")})
    rows = export.audit_rows(entries, log, include_missing=True).select("document.*")
    return rows.select(F.col("entries.entry_id").cast("string").alias("entry_id"), "entries.word", F.col("definitions.enrichment_id").cast("string").alias("enrichment_id"), "definitions.model")


@query(f"""
WITH {ENRICH}, e AS (SELECT c_custkey AS entry_id, md5('{{"k": ' || (c_custkey % 100) || '}}') AS input_hash FROM customer)
SELECT DISTINCT ON (entry_id) entry_id, CAST(x.enrichment_id AS VARCHAR) AS enrichment_id FROM e JOIN (SELECT * FROM enrich WHERE status = 'succeeded') x USING (entry_id, input_hash) ORDER BY entry_id, created_at DESC, x.enrichment_id DESC
""")
def matched_export(spark, sf_dir):
    """Entries with the newest response to their present content; others go."""
    key = F.concat(F.lit('{"k": '), (F.col("c_custkey") % 100).cast("string"), F.lit("}"))
    entries = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entry_id"), F.md5(key).alias("input_hash"), F.lit(0).alias("preference"))
    return latest.preferred(entries, enrich(spark, sf_dir), how="inner").select("entry_id", F.col("enrichment_id").cast("string").alias("enrichment_id"))


@query(f"""
WITH {KEPT}, h AS (SELECT DISTINCT lang_code, lower(word) AS w FROM raw WHERE lang_code IN ('en', 'de') ORDER BY 1, 2 LIMIT 40) SELECT entry_id, word FROM ids SEMI JOIN h USING (lang_code, w)
""")
def limited_languages(spark, sf_dir):
    """Entries of some languages, and of those the first headwords."""
    senses = F.transform("glosses", lambda g: F.struct(F.array(g).alias("glosses")))
    payload = F.to_json(F.struct("word", F.col("lang_code").alias("lang"), "lang_code", "pos", "etymology_text", senses.alias("senses")))
    rows = raw(spark, sf_dir).select("id", F.lit("run").alias("run_id"), F.lit("snap").alias("snapshot_id"), F.col("id").alias("source_line"), "word", F.col("lang_code").alias("lang"), "lang_code", "pos", payload.alias("payload"))
    return curate.curate(rows, ["en", "de"], limit_groups=40).entries.select("entry_id", "word")


# --- tables and files, in the shared folder


def _folder(spark) -> str:
    return f"{shared_dir(spark)}/quern-catalog-{uuid.uuid4().hex}"


def _local_folder(spark) -> tempfile.TemporaryDirectory:
    """A folder on the driver's disk, within the shared one where that is on a disk: executors read what is written there."""
    shared = urlparse(shared_dir(spark))
    return tempfile.TemporaryDirectory(prefix="quern-catalog-", dir=shared.path if shared.scheme in ("", "file") else None)


def _joined(lines):
    """The lines of a partition in order, many in a row: the driver gets a row for each batch."""

    def join(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(["\n".join(batch.column("line").to_pylist())])], names=["line"])

    return lines.mapInArrow(join, "line string")


@query("""
SELECT n_nationkey, n_name FROM nation WHERE n_nationkey % 3 <> 0 UNION ALL SELECT n_nationkey, 'new ' || n_name FROM nation WHERE n_nationkey % 3 = 0 UNION ALL SELECT n_nationkey + 100, n_name FROM nation
""")
def store_commits(spark, sf_dir):
    """A table truncated, written, upserted and appended to, in commits of its store."""
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    kept = merge.VersionedTable(spark, f"{_folder(spark)}/nations", "n_nationkey int, n_name string")
    kept.append(nations)
    kept.truncate()
    kept.append(nations)
    kept.upsert(nations.filter("n_nationkey % 3 = 0").withColumn("n_name", F.concat(F.lit("new "), "n_name")), ["n_nationkey"])
    kept.append(nations.withColumn("n_nationkey", F.col("n_nationkey") + 100))
    return kept.read()


@query("""
SELECT row_number() OVER w AS source_line, CAST(sum(CASE WHEN event_id % 10 = 5 THEN 1 ELSE length(CAST(event_id AS VARCHAR)) + 12 + length(event_type) END) OVER w AS BIGINT) AS source_byte_offset FROM events WINDOW w AS (ORDER BY event_id)
""")
def line_offsets(spark, sf_dir):
    """Physical lines of a file from 1, and the byte after each."""
    path = _folder(spark)
    line = F.when(F.col("event_id") % 10 == 5, "").otherwise(F.concat(F.lit('{"'), F.col("event_id").cast("string"), F.lit('": "x'), "event_type", F.lit('"}é')))
    table(spark, sf_dir, "events").select("event_id", line.alias("line")).coalesce(1).sortWithinPartitions("event_id").select("line").write.text(path)
    return jsonl.numbered_lines(spark, path).select(F.col("source_line").cast("long").alias("source_line"), "source_byte_offset")


@query("""
SELECT 'entries.assemble' AS stage, 'succeeded' AS status, CAST(NULL AS VARCHAR) AS error, CAST((SELECT count(*) FROM orders) AS VARCHAR) AS n, 'orders' AS key
UNION ALL SELECT 'audit.export', 'failed', 'RuntimeError: x', CAST((SELECT count(*) FROM nation) AS VARCHAR), 'nation'
""")
def run_lifecycle(spark, sf_dir):
    """Runs that are started, checkpointed twice, and end well or not."""
    book = registry.Registry(spark, _folder(spark))
    for stage, name in (("entries.assemble", "orders"), ("audit.export", "nation")):
        run = book.start(stage, {"table": name})
        for n in (0, table(spark, sf_dir, name).count()):
            book.checkpoint(run, stage, name, {"rows": n})
        if name == "nation":
            book.fail(run, "RuntimeError: x")
        else:
            book.complete(run, {})
    found = book.table("checkpoints").read().join(book.table("runs").read(), "run_id")
    return found.select("stage", "status", "error", F.get_json_object("payload", "$.rows").alias("n"), F.col("checkpoint_key").alias("key"))


@query("""
SELECT event_id AS source_line, event_type AS word, 'record' AS kind FROM events WHERE event_id % 10 NOT IN (3, 4) UNION ALL SELECT event_id, NULL, CASE event_id % 10 WHEN 3 THEN 'invalid_json' ELSE 'non_object_json' END FROM events WHERE event_id % 10 IN (3, 4)
""")
def tracked_ingest(spark, sf_dir):
    """A file into raw rows and anomalies, chunk by chunk, with checkpoints."""
    line = F.when(F.col("event_id") % 10 == 3, '{"word": ').when(F.col("event_id") % 10 == 4, "[1]").otherwise(F.concat(F.lit('{"word": "'), "event_type", F.lit('"}')))
    events = table(spark, sf_dir, "events")
    first = events.agg(F.min("event_id")).first()[0]
    with _local_folder(spark) as folder:
        path = os.path.join(folder, "events.jsonl")
        with open(path, "w") as out:
            for r in _joined(events.select("event_id", line.alias("line")).orderBy("event_id").select("line")).toLocalIterator():
                out.write(r["line"] + "\n")
        book = registry.Registry(spark, _folder(spark))
        n = stages.ingest(book, path, chunk_lines=4000)
        assert n["last_line"] > 0
        good = book.table("raw").read().select("source_line", "word", F.lit("record").alias("kind"))
        bad = book.table("anomalies").read().select("source_line", F.lit(None).cast("string").alias("word"), F.col("anomaly_type").alias("kind"))
        return good.unionByName(bad).withColumn("source_line", F.col("source_line") + (first - 1))
