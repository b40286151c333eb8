"""A corpus pipeline of five stages. Each takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a
DataFrame; all but the last return the columns of documents. Stages are written as Parquet and read again in between.

Null texts pass every filter but are no document to copy from and no copy; empty texts stay up to the mix, which draws
documents with words only; rows with null ids stay unless
a filter rejects them; rows that repeat are judged alike, but of near copies that all have null ids one row stays. Extra columns are kept by the filters. Empty tables give empty
tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import decontaminate, jaccard_join, line_dedup, mixing, toxicity
from quern.session import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labelled rows of `docs` outside the held-out fold."""
    return toxicity.clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of lines that an earlier document has go; a document that loses all its lines goes with them."""
    found = line_dedup.applied(docs).filter("n_removed = 0 OR n_removed < n_lines")
    chars = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", chars).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least id stays, by row: ids may be null or repeat."""
    return jaccard_join.kept(docs, jaccard_join.join(docs, keyed=True))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of what is left, drawn and shuffled: a row for each copy taken, with its document's columns, size, its source's
    size and target, the words taken of the document and of the copy, output shard and place in it."""
    return mixing.shuffled(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: Classifier, patience alignment and MinHash can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each but the last written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
