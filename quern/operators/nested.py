"""Transforms of nested arrays, as higher-order functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.schemas import EXAMPLE, FORM, PRONUNCIATION, RELATION, SENSE, array

#: Caps.
MAX_FORMS = 48
MAX_PRONUNCIATIONS = 8
MAX_RELATIONS_PER_TYPE = 24

Key = Callable[[Column], Column]


def empty(of) -> Column:
    return F.array().cast(f"array<{of.simpleString()}>")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once per row, not once per element."""
    return F.get(F.transform(F.array(value), body), 0)


def cap_per_key(items: Column, key: Key, cap: int) -> Column:
    """At most `cap` elements of each key, the first ones, order kept; nulls in keys are equal. By sorting on (key, place),
    where an element is one too many if the one `cap` places before has its key."""
    placed = lambda x, i: F.struct(F.struct(key(x).alias("k")).alias("k"), i.alias("i"))
    kept = lambda ts: F.filter(ts, lambda t, j: ~F.get(ts, j - cap)["k"].eqNullSafe(t["k"]))
    return let(items, lambda xs: let(F.sort_array(F.transform(xs, placed)), lambda ts: F.transform(F.sort_array(F.transform(kept(ts), lambda t: t["i"])), lambda i: F.get(xs, i))))


def dedupe(items: Column, key: Key | None = None) -> Column:
    """Of the elements with equal keys the first, order kept; without a key, of equal elements."""
    return F.array_distinct(items) if key is None else cap_per_key(items, key, 1)


def grouped(items: Column, key: Key) -> Column:
    """array<struct<key, own>> by key, which isn't null, elements in order: by one sort, whose runs are the groups."""
    placed = F.sort_array(F.transform(items, lambda x, i: F.struct(key(x).alias("k"), i.alias("i"), x.alias("x"))))  # i is unique, so x isn't compared

    def cut(ps: Column) -> Column:
        fresh = lambda j: (j == 0) | (F.get(ps, j)["k"] != F.get(ps, j - 1)["k"])
        starts = F.when(F.size(ps) > 0, F.filter(F.sequence(F.lit(0), F.size(ps) - 1), fresh)).otherwise(F.array().cast("array<int>"))

        def group(ss: Column) -> Column:
            own = lambda s, n: F.transform(F.slice(ps, s + 1, F.coalesce(F.get(ss, n + 1), F.size(ps)) - s), lambda p: p["x"])
            return F.transform(ss, lambda s, n: F.struct(F.get(ps, s)["k"].alias("key"), own(s, n).alias("own")))

        return let(starts, group)

    return let(placed, cut)


def trim(items: Column, cap: int, flag: str, flags_field: str) -> tuple[Column, Column]:
    """The first `cap` elements, each flagged if any went; and the flags for what holds them."""
    over = F.size(items) > cap
    with_flag = lambda x: x.withField(flags_field, F.array_sort(F.array_union(x[flags_field], F.array(F.lit(flag)))))
    return F.when(over, F.transform(F.slice(items, 1, cap), with_flag)).otherwise(items), F.when(over, F.array(F.lit(flag))).otherwise(F.array().cast("array<string>"))


def form_key(x: Column) -> Column:
    return F.struct(x["form"], x["tags"], x["roman"])


def pronunciation_key(x: Column) -> Column:
    return F.struct(x["ipa"], x["pronunciation_text"], x["audio_url"], x["tags"])


def sense_key(x: Column) -> Column:
    return F.struct(x["gloss"], x["tags"], x["qualifier"])


def relation_key(x: Column) -> Column:
    return F.struct(x["relation_type"], x["target_word"], x["target_lang_code"], x["source_scope"])


def dedupe_relations(items: Column) -> Column:
    """Each relation once, then at most so many of a type."""
    return cap_per_key(dedupe(items, relation_key), lambda x: x["relation_type"], MAX_RELATIONS_PER_TYPE)


def typed(value: Column, kind) -> Column:
    return value.cast(kind.simpleString())


def relations(items: Column, relation_type: str, scope: str) -> Column:
    """Typed relations of raw items that have a target."""
    no_flags = F.array().cast("array<string>")
    out = F.transform(F.filter(items, lambda x: x["word"].isNotNull()), lambda x: F.struct(
        F.lit(relation_type).alias("relation_type"), x["word"].alias("target_word"), x["lang_code"].alias("target_lang_code"),
        no_flags.alias("relation_flags"), F.lit(scope).alias("source_scope"),
    ))
    return F.coalesce(typed(out, array(RELATION)), empty(RELATION))


def entry_relations(record: Column) -> Column:
    """Top-level relations in field order; capped, not deduplicated."""
    fields = (("derived", "derived_term"), ("related", "related_term"), ("synonyms", "synonym"), ("antonyms", "antonym"))
    return cap_per_key(F.concat(*[relations(record[f], t, "entry") for f, t in fields]), lambda x: x["relation_type"], MAX_RELATIONS_PER_TYPE)


def sense_relations(sense: Column) -> Column:
    fields = (("form_of", "form_of"), ("alt_of", "alternative_of"), ("compound_of", "compound_of"))
    return dedupe_relations(F.concat(*[relations(sense[f], t, "sense") for f, t in fields]))


def forms(record: Column) -> Column:
    """struct(items, flags): forms with a text, each once, capped."""
    some = F.transform(F.filter(record["forms"], lambda x: x["form"].isNotNull()), lambda x: F.struct(
        x["form"].alias("form"), F.array_distinct(x["tags"]).alias("tags"), x["roman"].alias("roman"), F.array().cast("array<string>").alias("form_flags")
    ))
    some = F.coalesce(typed(some, array(FORM)), empty(FORM))
    return let(dedupe(some, form_key), lambda xs: F.struct(*[c.alias(n) for c, n in zip(trim(xs, MAX_FORMS, "trimmed_form_set", "form_flags"), ("items", "flags"), strict=True)]))


def pronunciations(record: Column) -> Column:
    """struct(items, flags): sounds with any of ipa, text and audio, each once, capped."""
    some = F.filter(record["sounds"], lambda x: F.coalesce(x["ipa"], x["pronunciation_text"], x["audio_url"]).isNotNull())
    some = F.transform(some, lambda x: F.struct(
        x["ipa"].alias("ipa"), x["pronunciation_text"].alias("pronunciation_text"), x["audio_url"].alias("audio_url"),
        F.when(x["ogg"], F.lit("ogg")).when(x["mp3"], F.lit("mp3")).when(x["wav"], F.lit("wav")).alias("audio_format"),
        F.array_distinct(x["tags"]).alias("tags"),
        F.when(x["audio_url"].isNotNull(), F.array(F.lit("preferred_audio"))).otherwise(F.array().cast("array<string>")).alias("pronunciation_flags"),
    ))
    some = F.coalesce(typed(some, array(PRONUNCIATION)), empty(PRONUNCIATION))
    return let(dedupe(some, pronunciation_key), lambda xs: F.struct(*[c.alias(n) for c, n in zip(trim(xs, MAX_PRONUNCIATIONS, "trimmed_audio_set", "pronunciation_flags"), ("items", "flags"), strict=True)]))


def examples(items: Column) -> Column:
    def flags(x: Column) -> Column:
        quote = F.when(x["type"] == "quote", F.lit("quote"))
        machine = F.when(x["translation"].isNotNull() & x["has_english"], F.lit("machine_translation"))
        return F.array_compact(F.array(quote, machine))

    some = F.transform(F.filter(items, lambda x: x["text"].isNotNull()), lambda x: F.struct(x["text"].alias("text"), x["translation"].alias("translation"), x["type"].alias("type"), x["ref"].alias("ref"), flags(x).alias("example_flags")))
    return F.coalesce(typed(some, array(EXAMPLE)), empty(EXAMPLE))


def sense_flags(tags: Column) -> Column:
    figurative = F.when(F.arrays_overlap(tags, F.array(F.lit("figuratively"), F.lit("figurative"))), F.lit("figurative"))
    archaic = F.when(F.arrays_overlap(tags, F.array(F.lit("archaic"), F.lit("obsolete"))), F.lit("archaic"))
    return F.array_sort(F.array_compact(F.array(figurative, archaic)))


def gloss(sense: Column) -> Column:
    return F.coalesce(F.get(sense["glosses"], 0), F.get(sense["raw_glosses"], 0))


def senses(record: Column) -> Column:
    """Senses with a gloss; the id is the place among all senses, those that are no objects included."""
    placed = F.transform(record["senses"], lambda s, i: F.struct(s.alias("s"), (i + 1).alias("i")))
    some = F.transform(F.filter(placed, lambda p: gloss(p["s"]).isNotNull()), lambda p: F.struct(
        F.concat(F.lit("s"), p["i"].cast("string")).alias("sense_id"), gloss(p["s"]).alias("gloss"), F.get(p["s"]["raw_glosses"], 0).alias("raw_gloss"),
        F.array_distinct(p["s"]["tags"]).alias("tags"), p["s"]["qualifier"].alias("qualifier"), F.array_distinct(p["s"]["topics"]).alias("topics"),
        examples(p["s"]["examples"]).alias("examples"), sense_relations(p["s"]).alias("relations"), sense_flags(p["s"]["tags"]).alias("sense_flags"),
    ))
    return F.coalesce(typed(some, array(SENSE)), empty(SENSE))


def senses_without_gloss(record: Column) -> Column:
    """Places (from 1) of senses that are objects without a gloss."""
    placed = F.transform(record["senses"], lambda s, i: F.struct(s.alias("s"), (i + 1).alias("i")))
    return F.transform(F.filter(placed, lambda p: p["s"].isNotNull() & gloss(p["s"]).isNull()), lambda p: p["i"])


def renumbered(items: Column) -> Column:
    """Senses with ids s1..sn in order."""
    return F.transform(items, lambda x, i: x.withField("sense_id", F.concat(F.lit("s"), (i + 1).cast("string"))))
