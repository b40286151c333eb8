"""Mixing sources to target weights (operator 6), in DataFrame operations only.

Sources get targets by weight, water-filled under a cap of `max_repeat` times their size. Each source is cut into blocks
of about `docs_per_block` documents by a keyed hash; in a keyed permutation of its blocks the source draws whole epochs,
then blocks until its quota of words is full, the last one document by document. The drawn blocks are split among the
output shards by a tree: at each node exactly half of the blocks, whichever source they are of, go left by a keyed
permutation, so the counts by source in each half are a multivariate hypergeometric sample and quotas stay exact. Places in
a permutation are counted by ranges of its keys first (2**16 of them), then within a range, so no task holds a whole
permutation. shuffled() draws the mix: each shard's copies in the order of a keyed hash, in slices of bounded size.

Null texts have size 0; a null source is a source of its own, ordered last; rows with a null id or repeated rows count as
documents of their own; rows equal in id, text and source are interchangeable, and shuffled() takes the other columns of one of
them. An empty table gives no rows. Other columns are ignored by mix(), whatever their names. Everything is keyed by `seed`, so
reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.session import written

WORD = r"[^\x20\x09-\x0D]+"


def _key(seed: str, *parts: Column) -> Column:
    """60 bits of a keyed hash, as a long."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """id, source, skey (null-safe key of the source), size in words and tkey, a hash of the text."""
    source = docs[source_col].cast("string")
    return docs.select(
        docs[id_col].alias("id"),
        source.alias("source"),
        F.coalesce(F.concat(F.lit("s"), source), F.lit("n")).alias("skey"),
        F.coalesce(F.regexp_count(docs[text_col], F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.substring(F.md5(F.coalesce(docs[text_col].cast("string"), F.lit(""))), 1, 16).alias("tkey"),
    )


def targets(sized: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_repeat: int = 3, docs_per_block: int = 500) -> DataFrame:
    """Per source: its rank, size and target, with whole epochs, the rest in words and its number of blocks.

    The level at which targets fill up is the first, by cap over weight, that reaches its own cap no more; the
    windows without a partition hold one row per source."""
    by_source = sized.groupBy("skey", "source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    ranked = by_source.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("sid") % len(weights) + 1))
    ranked = ranked.withColumn("cap", F.col("source_size") * max_repeat).withColumn("ratio", F.col("cap") / F.col("w"))
    everything, before = Window.partitionBy(F.lit(0)), Window.orderBy("ratio", "sid").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / (
        F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    )
    filled = ranked.withColumn("level", level).withColumn("pos", F.row_number().over(Window.orderBy("ratio", "sid")))
    first = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("pos", "level"))).over(everything)["level"]
    target = F.least(F.col("cap").cast("double"), F.coalesce(first, F.lit(0.0)) * F.col("w"))
    quota = F.round("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.expr("quota div source_size")).otherwise(F.lit(0)).cast("long")
    return (
        filled.withColumn("target", target)
        .withColumn("quota", quota)
        .withColumn("whole", whole)
        .select(
            "skey", "source", "sid", "source_size", "target", "whole",
            (F.col("quota") - F.col("whole") * F.col("source_size")).alias("rest"),
            F.expr(f"(n + {docs_per_block - 1}) div {docs_per_block}").alias("n_blocks"),
        )
    )


def placed(df: DataFrame, part: list[str], ties: list[str], value: Column, before: str, total: str) -> DataFrame:
    """Adds the sum of `value` over the rows before each in the order of (__key, ties) within `part`, and that over all of
    them, and drops __key. `df` is read twice: it should be a written table."""
    ranged = df.withColumn("__range", F.shiftright("__key", 44))
    sums = ranged.groupBy(*part, "__range").agg(F.sum(value).alias("__sum"))
    whole = Window.partitionBy(*part)
    lower = F.coalesce(F.sum("__sum").over(whole.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select(*part, "__range", lower.alias("__lower"), F.sum("__sum").over(whole).alias(total))
    inner = Window.partitionBy(*part, "__range").orderBy("__key", *ties).rowsBetween(Window.unboundedPreceding, -1)
    both = ranged.withColumn("__inner", F.coalesce(F.sum(value).over(inner), F.lit(0))).join(sums, [*part, "__range"])
    return both.withColumn(before, F.col("__lower") + F.col("__inner")).drop("__key", "__range", "__lower", "__inner")


def blocks(keyed: DataFrame, seed: str, shards: int) -> DataFrame:
    """Per (source, block): words before it in its source's permutation, and the shard of each of its draws."""
    by_block = keyed.groupBy("sid", "block", "whole", "rest").agg(F.sum("size").alias("block_size"))
    by_block = written(by_block.withColumn("__key", _key(seed, F.lit("block"), F.col("sid"), F.col("block"))), "blocks")
    ordered = placed(by_block, ["sid"], ["block"], F.col("block_size"), "before", "words")
    ordered = written(ordered.withColumn("n_draws", F.col("whole") + F.when(F.col("before") < F.col("rest"), 1).otherwise(0)), "ordered")
    draws = ordered.filter("n_draws > 0").select("sid", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_draws") - 1)).alias("epoch"))
    draws = draws.withColumn("shard", F.lit(0))
    for level in range(shards.bit_length() - 1):
        draws = written(draws.withColumn("__key", _key(seed, F.lit("split"), F.lit(level), F.col("sid"), F.col("block"), F.col("epoch"))), "draws")
        split = placed(draws, ["shard"], ["sid", "block", "epoch"], F.lit(1), "at", "all")
        right = (F.col("at") >= F.ceil(F.col("all") / 2)).cast("int")
        draws = split.select("sid", "block", "epoch", (F.col("shard") * 2 + right).alias("shard"))
    dealt = draws.groupBy("sid", "block").agg(F.transform(F.array_sort(F.collect_list(F.struct("epoch", "shard"))), lambda x: x["shard"]).alias("dealt"))
    return ordered.select("sid", "block", "before").join(dealt, ["sid", "block"], "left")


def drawn(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: tuple[float, ...], max_repeat: int, docs_per_block: int, shards: int, seed: str) -> DataFrame:
    """One row per document: what mix() gives, with id, tkey, skey and `inside`, its words' place in its block."""
    if shards < 1 or shards & (shards - 1):
        raise ValueError("shards must be a power of 2")
    sized = written(sizes(docs, id_col, text_col, source_col), "sizes")
    plan = targets(sized, weights, max_repeat, docs_per_block)
    keyed = sized.join(plan.drop("source"), "skey").withColumn("key", _key(seed, F.lit("doc"), F.col("id"), F.col("size"), F.col("tkey")))
    keyed = keyed.withColumn("block", F.col("key") % F.col("n_blocks"))
    inside = Window.partitionBy("sid", "block").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    keyed = keyed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    dealt = keyed.join(blocks(keyed, seed, shards), ["sid", "block"])
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before") - F.col("inside")))
    copies = F.col("whole") + F.when(part > 0, 1).otherwise(0)
    return dealt.select(
        "id", "tkey", "skey", "inside", "size", "source_size", "target",
        (F.col("size") * F.col("whole") + part).cast("long").alias("taken"),
        F.when(F.col("size") > 0, F.slice(F.col("dealt"), F.lit(1), copies.cast("int"))).otherwise(F.array().cast("array<int>")).alias("dealt"),
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *, weights: tuple[float, ...] = (5, 2, 1),
        max_repeat: int = 3, docs_per_block: int = 500, shards: int = 16, seed: str = "mix-1") -> DataFrame:
    """One row per document: id, size, source_size, target, taken (words, repeats counted) and shards: the output shard
    of each copy taken, by epoch; the last may be a part of the document (taken says how much). `shards` is a power of 2."""
    out = drawn(docs, id_col, text_col, source_col, weights, max_repeat, docs_per_block, shards, seed)
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", "taken", F.coalesce(F.concat_ws(",", F.col("dealt").cast("array<string>")), F.lit("")).alias("shards"))


def shuffled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *, weights: tuple[float, ...] = (5, 2, 1),
             max_repeat: int = 3, docs_per_block: int = 500, shards: int = 16, seed: str = "mix-1", copies_per_slice: int = 20_000) -> DataFrame:
    """The mix itself: a row of `docs` for each copy taken, with size, source_size, target and taken as by mix(), the copy's
    shard, epoch and words taken of it, and `place`, by which a shard's copies are shuffled; columns of these names give way.
    A shard is dealt out in as many slices of the places as it needs; within one, copies stand in order."""
    mixed = written(drawn(docs, id_col, text_col, source_col, weights, max_repeat, docs_per_block, shards, seed), "mixed")
    made = ("size", "source_size", "target", "taken", "shard", "epoch", "words", "place")
    copies = mixed.select("id", "tkey", "skey", "inside", "size", "source_size", "target", "taken", F.posexplode("dealt").alias("epoch", "shard"))
    place = _key(seed, F.lit("place"), F.col("shard"), F.col("epoch"), F.col("id"), F.col("tkey"), F.col("inside"))
    copies = copies.withColumn("words", F.least(F.col("size"), F.col("taken") - F.col("epoch") * F.col("size"))).withColumn("place", place).drop("inside")
    n = mixed.agg(F.sum(F.size("dealt"))).first()[0] or 0
    slices = n // (shards * copies_per_slice) + 1

    keys = docs.select(docs[id_col].alias("id"), F.substring(F.md5(F.coalesce(docs[text_col].cast("string"), F.lit(""))), 1, 16).alias("tkey"),
                       F.coalesce(F.concat(F.lit("s"), docs[source_col].cast("string")), F.lit("n")).alias("skey"), F.struct(*[docs[c] for c in docs.columns if c not in made]).alias("row"))
    once = keys.groupBy("id", "tkey", "skey").agg(F.first("row").alias("row"))
    both = once.join(copies, once["id"].eqNullSafe(copies["id"]) & (once["tkey"] == copies["tkey"]) & (once["skey"] == copies["skey"]))
    out = both.select("row.*", *made).withColumn("__slice", F.floor(F.col("place") / (2.0**60 / slices)).cast("int"))
    return out.repartition("shard", "__slice").sortWithinPartitions("shard", "__slice", "place").drop("__slice")
