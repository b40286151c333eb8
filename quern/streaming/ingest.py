"""An extra: incremental ingest of a folder of JSONL files by Structured Streaming, as far as there is data.

Files are tracked by the stream's checkpoint, so a file is read once; a batch is written in one commit. Lines have no
numbers here, as batches hold lines of several files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.sources.jsonl import scan


def ingest_available(spark: SparkSession, folder: str, raw: str, anomalies: str, checkpoint: str) -> None:
    """Appends records and anomalies of files that are new to two Parquet folders, then returns."""
    lines = spark.readStream.option("lineSep", "\n").text(folder).select(F.lit(None).cast("long").alias("source_line"), F.col("value").cast("binary").alias("raw"))

    def store(batch: DataFrame, batch_id: int) -> None:
        found = scan(batch).drop("source_line").withColumn("batch_id", F.lit(batch_id))
        for path, rows in ((raw, found.filter("kind = 'record'").drop("kind", "detail")), (anomalies, found.filter("kind != 'record'"))):
            rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")  # a batch that is run again replaces itself

    lines.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
