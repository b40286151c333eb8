"""Deterministic sampling: stratified with weights, round robin across pools, and the fixture sampler."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import ids

#: Fixed values.
MIN_STRATUM_SAMPLE = 25
ABBREVIATION = r"^[A-Z0-9./&'-]{2,6}$"


def entry_kind(word: Column, flags: Column) -> Column:
    has = lambda f: F.array_contains(flags, f"entry_type:{f}")
    return (
        F.when(has("proper_name"), "proper_name")
        .when(has("affix") | has("proverb"), "affix_or_proverb")
        .when(F.contains(word, F.lit(" ")), "phrase")
        .when(word.rlike(ABBREVIATION), "abbreviation")
        .otherwise("word")
    )


def size_band(n: Column) -> Column:
    return F.when(n <= 1, "1").when(n <= 9, "2-9").when(n <= 28, "10-28").otherwise("sharded")


def stratum(word: Column, flags: Column, n_senses: Column) -> Column:
    return F.concat_ws("|", entry_kind(word, flags), size_band(n_senses))


def allocation(population: DataFrame, size: int, floor: int = MIN_STRATUM_SAMPLE, by: str = "stratum") -> DataFrame:
    """(stratum, n, take): a floor for each, then the rest in proportion, rounded half to even."""
    counts = population.groupBy(by).agg(F.count(F.lit(1)).alias("n")).withColumn("base", F.least(F.lit(floor), F.col("n")))
    every = Window.partitionBy(F.lit(0))  # a row per stratum
    left = F.greatest(F.lit(0), F.lit(size) - F.sum("base").over(every))
    share = F.bround(left * F.col("n") / F.sum("n").over(every)).cast("long")
    take = F.col("base") + F.greatest(F.lit(0), F.least(F.col("n") - F.col("base"), share))
    return counts.withColumn("take", take).select(by, "n", "take")


def stratified(population: DataFrame, size: int, seed: str, key: str = "entry_id", by: str = "stratum", floor: int = MIN_STRATUM_SAMPLE) -> DataFrame:
    """Of each stratum the rows with the least md5 of seed|key, with sampling_weight; independent of input order."""
    picked = F.row_number().over(Window.partitionBy(by).orderBy(ids.sample_key(seed, F.col(key).cast("string")), key))
    shares = allocation(population, size, floor, by).select(by, F.col("n").alias("__n"), F.col("take").alias("__take"))
    out = population.join(shares, by).withColumn("__at", picked)
    return out.filter("__at <= __take").withColumn("sampling_weight", F.col("__n") / F.col("__take")).drop("__at", "__n", "__take")


def random_sample(df: DataFrame, n: int, seed: str | None = None, key: str = "entry_id") -> DataFrame:
    """`n` rows in random order; with a seed those whose seed|key has the least md5, so the same whenever it is drawn."""
    order = (F.rand(),) if seed is None else (ids.sample_key(str(seed), F.col(key).cast("string")), F.col(key))
    return df.orderBy(*order).limit(n)


def top_per_key(df: DataFrame, key: str, k: int, *order: Column) -> DataFrame:
    return df.withColumn("__at", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter(F.col("__at") <= k).drop("__at")


def round_robin(df: DataFrame, pool: str, quota: int, *order: Column) -> DataFrame:
    """`quota` rows, one of each pool in turn: pools by size, then name; rows of a pool by `order`."""
    pools = df.groupBy(pool).agg(F.count(F.lit(1)).alias("__size"))
    pools = pools.withColumn("__pool", F.row_number().over(Window.orderBy(F.desc("__size"), pool)))  # a row per pool
    placed = df.withColumn("__at", F.row_number().over(Window.partitionBy(pool).orderBy(*order)))
    return placed.join(pools, pool).orderBy("__at", "__pool").limit(quota).drop("__at", "__pool", "__size")


def two_phase(df: DataFrame, key: str, signature: str, bucket: str, limit: int, quota: int, per_signature: int, per_bucket: int, *order: Column) -> DataFrame:
    """`quota` rows in turn across signatures, then up to `limit` in all across buckets among the rows not taken."""
    first = round_robin(top_per_key(df, signature, per_signature, *order), signature, min(quota, limit), *order)
    rest = top_per_key(df, bucket, per_bucket, *order).join(first.select(key), key, "left_anti")
    second = round_robin(rest, bucket, limit, *order)
    ranked = first.withColumn("__phase", F.lit(1)).unionByName(second.withColumn("__phase", F.lit(2)))
    return ranked.orderBy("__phase").limit(limit).drop("__phase")


def signature(**parts: Column) -> Column:
    """The names of the parts that hold, in order, joined by +; `plain` without any."""
    return F.coalesce(F.nullif(F.concat_ws("+", *[F.when(c, F.lit(n)) for n, c in parts.items()]), F.lit("")), F.lit("plain"))


def score(sizes: list[Column], bonuses: list[Column]) -> Column:
    """Sizes up to 8 each, and 4 for each bonus that holds."""
    zero = F.lit(0)
    return sum((F.least(F.coalesce(s, zero), F.lit(8)) for s in sizes), zero) + sum((F.when(b, 4).otherwise(0) for b in bonuses), zero)


def record_features(record: Column, n_translations: Column, n_categories: Column) -> tuple[Column, Column]:
    """Feature signature and score of a raw record."""
    some = lambda f: F.size(record[f]) > 0
    has_examples = F.exists(record["senses"], lambda s: F.size(s["examples"]) > 0)
    etymology = record["etymology_text"].isNotNull()
    sig = signature(senses=some("senses"), examples=has_examples, forms=some("forms"), derived=some("derived"), related=some("related"),
                    translations=n_translations > 0, sounds=some("sounds"), etymology=etymology, categories=n_categories > 0)
    sizes = [F.size(record[f]) for f in ("senses", "forms", "derived", "related", "sounds")]
    return sig, score([*sizes, n_translations, n_categories], [etymology, has_examples])


def most_common(df: DataFrame, value: str, position: str, n: int = 25) -> DataFrame:
    """Values by count; ties in order of first appearance."""
    counted = df.groupBy(value).agg(F.count(F.lit(1)).alias("count"), F.min(position).alias("__first"))
    return counted.orderBy(F.desc("count"), "__first").limit(n).drop("__first")
