"""A small, varied set of records out of a large dump."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.ids import order_key
from quern.operators import sampling
from quern.sources import jsonl

#: Fixed values.
LIMIT, PER_BUCKET, POOL, QUOTA = 1000, 8, 64, 240


def candidates(scanned: DataFrame) -> DataFrame:
    """Records with bucket (language and part of speech), feature signature, score and sampling key."""
    read = jsonl.with_record(scanned, "json_text")
    n_of = lambda field: F.coalesce(F.size(F.from_json(F.get_json_object("json_text", f"$.{field}"), "array<string>")), F.lit(0))
    read = read.withColumns({"n_translations": n_of("translations"), "n_categories": n_of("categories")})
    signature, score = sampling.record_features(F.col("record"), F.col("n_translations"), F.col("n_categories"))
    bucket = F.concat(F.coalesce("lang_code", F.lit("_")), F.lit("::"), F.coalesce("pos", F.lit("_")))
    out = read.select("source_line", "json_text", "word", "lang_code", "pos", bucket.alias("bucket"), signature.alias("signature"), score.alias("score"))
    return out.withColumn("sample_key", order_key(F.col("source_line"), F.col("word"), F.col("lang_code"), F.col("pos"), F.col("signature")))


def build(spark: SparkSession, path: str, *, limit: int = LIMIT, per_bucket: int = PER_BUCKET, pool: int = POOL, quota: int = QUOTA) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The records chosen, in file order, and summaries of the dump by bucket and signature. A line that is no JSON object
    is an error."""
    scanned = jsonl.scan_file(spark, path)
    bad = scanned.filter("kind IN ('invalid_json', 'invalid_utf8')").agg(F.min(F.struct("source_line", "detail"))).first()[0]
    if bad:
        raise ValueError(f"{path}:{bad[0]}: {bad[1]}")
    some = candidates(jsonl.records(scanned))
    order = (F.col("sample_key"), F.desc("score"), F.col("source_line"))
    chosen = sampling.two_phase(some, "source_line", "signature", "bucket", limit, quota, pool, per_bucket, *order)
    summaries = {by: sampling.most_common(some, by, "source_line") for by in ("bucket", "signature")}
    return chosen.orderBy("source_line"), summaries
