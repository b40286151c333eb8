"""Toxicity (operator 4): a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are whether a text, lower-cased, holds each n-gram of `sizes` characters, hashed to 2**BITS slots. On a bounded sample
of labelled rows (`max_train`, the only bound; by keyed hash of the id) executors count the rows of each class that hold a
slot; the `n_features` slots with the largest chi-squared are kept, each scaled by its log-count ratio, and a logistic
regression is fitted on them. Whole texts are scored, in pieces that overlap by n - 1 characters where they are very long.

Null texts read as empty; a text without n-grams gets the score of the intercept. Labels that are null are ignored, several
labels of one id count by their majority (ties: toxic), labelled rows with repeated ids are trained on as often as they
occur, and a null id is held out. Without labels of both classes every score is 1 if all are 1, or else 0. An empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.session import written

BITS = 20
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def slots(text: str, sizes: tuple[int, ...], piece: int = 1 << 18) -> Iterator[np.ndarray]:
    """The slots of all n-grams of a text, by piece."""
    low, most = text.lower(), max(sizes)
    for start in range(0, max(len(low), 1), piece):
        points = np.frombuffer(low[start : start + piece + most - 1].encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        rolled, found = points, []
        for n in range(1, most + 1):
            if len(points) < n:
                break
            if n > 1:
                rolled = rolled[:-1] * np.uint64(0x100000001B3) + points[n - 1 :]
            if n in sizes:
                found.append(((rolled * np.uint64(_MIX[n % len(_MIX)])) >> np.uint64(64 - BITS)).astype(np.int32))
        if found:
            yield np.concatenate(found)


@dataclass
class Model:
    weights: np.ndarray  # by slot, already times the ratio
    intercept: float
    sizes: tuple[int, ...]

    def score(self, text: str | None) -> float:
        used: np.ndarray | None = None
        for found in slots(text or "", self.sizes):
            held = np.unique(found[self.weights[found] != 0])
            used = held if used is None else np.union1d(used, held)
        z = self.intercept + (float(self.weights[used].sum()) if used is not None else 0.0)
        return float(1 / (1 + np.exp(-np.clip(z, -700, 700))))


def fold(id_col: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo the folds; a null id is in fold 0."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % folds


def _counts(batches: Iterator[pa.RecordBatch], sizes: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
    """Per task: by slot, the rows of each class that hold it; at slot -1 the rows of each class."""
    held, rows = np.zeros((2, 1 << BITS), dtype=np.int32), [0, 0]
    for batch in batches:
        for text, label in zip(batch.column("text"), batch.column("label").to_pylist(), strict=True):
            rows[label] += 1
            if parts := list(slots(text.as_py() or "", sizes)):
                held[label][np.unique(np.concatenate(parts))] += 1
    if any(rows):
        at = np.flatnonzero(held.any(axis=0))
        columns = [np.concatenate(([-1], at)), *(np.concatenate(([n], h[at])) for n, h in zip(rows, held, strict=True))]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int32)) for c in columns], names=["slot", "n0", "n1"])


def _kept(batches: Iterator[pa.RecordBatch], sizes: tuple[int, ...], ratio) -> Iterator[pa.RecordBatch]:
    """Per row: its label and which of the kept slots it holds."""
    ratio = ratio.value
    for batch in batches:
        out = []
        for text in batch.column("text"):
            parts = [found[ratio[found] != 0] for found in slots(text.as_py() or "", sizes)]
            out.append(np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.int32))
        yield pa.RecordBatch.from_pydict({"label": batch.column("label"), "slots": pa.array(out, pa.list_(pa.int32()))})


def logistic(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, labels: np.ndarray, n_cols: int, penalty: float, steps: int = 1500) -> tuple[np.ndarray, float]:
    """Weights and intercept by accelerated full-batch gradient steps; the matrix is given by row, column and value."""
    n, y = len(labels), labels.astype(float)
    share = min(max(y.mean(), 1e-6), 1 - 1e-6)
    w, b = np.zeros(n_cols), float(np.log(share / (1 - share)))
    # step size from a bound of the largest curvature: max row norm times max column norm
    row_sum = np.bincount(rows, np.abs(values), n).max(initial=0)
    col_sum = np.bincount(cols, np.abs(values), n_cols).max(initial=0)
    rate = 1 / (0.25 * (row_sum * col_sum / n + 1) + penalty)
    at_w, at_b, last_w, last_b = w, b, w, b
    for step in range(1, steps + 1):
        z = at_b + np.bincount(rows, values * at_w[cols], n)
        error = (1 / (1 + np.exp(-np.clip(z, -700, 700))) - y) / n
        w = at_w - rate * (np.bincount(cols, values * error[rows], n_cols) + penalty * at_w)
        b = at_b - min(rate * n, 4.0) * error.sum()
        ahead = (step - 1) / (step + 2)
        at_w, at_b = w + ahead * (w - last_w), b + ahead * (b - last_b)
        last_w, last_b = w, b
    return w, b


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", *, sizes: tuple[int, ...] = (3, 4, 5, 6),
          max_train: int = 12000, n_features: int = 2048, min_rows: int = 3, smooth: float = 1.0, penalty: float = 1e-4, seed: str = "tox-1") -> Model:
    """Fits the model on labelled texts of folds 1 to 4, at most `max_train` of them, one for each id: of rows that share one the
    text with the least hash. Features are the `n_features` slots that tell most by chi-squared among those that at least
    `min_rows` of these texts have."""
    spark = docs.sparkSession
    marked = labels.select(labels[id_col].alias("id"), labels[label_col].cast("int").alias("label")).filter("id IS NOT NULL AND label IS NOT NULL")
    marked = marked.groupBy("id").agg((F.avg("label") >= 0.5).cast("int").alias("label")).filter(fold(F.col("id")) != 0)
    sample = marked.orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(max_train)  # bounded, so it can be broadcast
    texts = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    found = texts.join(F.broadcast(sample), "id").groupBy("id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("x"))
    chosen = written(found.select("label", "x.text"), "sample")  # the documents are scanned once for it
    counted = chosen.mapInArrow(lambda b: _counts(b, sizes), "slot int, n0 int, n1 int").groupBy("slot").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    counted = written(counted, "slots")
    totals = counted.agg(*[F.coalesce(F.sum(F.when((F.col("slot") < 0) == outside, F.col(n))), F.lit(0)) for outside in (True, False) for n in ("n0", "n1")]).first()
    rows, held, nothing = totals[:2], totals[2:], np.zeros(1 << BITS, dtype=np.float32)
    if min(rows) == 0:
        return Model(nothing, 700.0 if rows[1] else -700.0, sizes)
    n = F.col("n0") + F.col("n1")
    ratio = F.log((F.col("n1") + smooth) / (held[1] + smooth * 2**BITS)) - F.log((F.col("n0") + smooth) / (held[0] + smooth * 2**BITS))
    chi = sum(F.pow(F.col(c) - n * (r / sum(rows)), 2) / (n * (r / sum(rows))) for c, r in zip(("n0", "n1"), rows, strict=True))
    top = counted.filter((F.col("slot") >= 0) & (n >= min_rows)).select("slot", ratio.alias("ratio"), chi.alias("chi")).filter("chi > 0").orderBy(F.desc("chi"), "slot").limit(n_features).collect()
    best = np.sort(np.array([r["slot"] for r in top], dtype=np.int64))
    kept = nothing.copy()
    kept[[r["slot"] for r in top]] = [r["ratio"] or 1e-6 for r in top]
    shared = spark.sparkContext.broadcast(kept)
    found = chosen.mapInArrow(lambda b: _kept(b, sizes, shared), "label int, slots array<int>").toPandas()
    lengths = found["slots"].map(len).to_numpy()
    row_of = np.repeat(np.arange(len(found)), lengths)
    slot_of = np.concatenate([np.asarray(x, dtype=np.int64) for x in found["slots"]]) if lengths.sum() else np.zeros(0, np.int64)
    col_of = np.searchsorted(best, slot_of)
    w, b = logistic(row_of, col_of, kept[slot_of].astype(float), found["label"].to_numpy(), len(best), penalty)
    weights = nothing.copy()
    weights[best] = (w * kept[best]).astype(np.float32)
    return Model(weights, b, sizes)


def _scored(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    model = model.value
    for batch in batches:
        scores = [model.score(x.as_py()) for x in batch.column("text")]
        keep = {name: batch.column(name) for name in batch.schema.names if name != "text"}
        yield pa.RecordBatch.from_pydict({**keep, "score": pa.array(scores, pa.float64())})


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, score and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    schema = texts.drop("text").withColumn("score", F.lit(0.0)).schema
    out = texts.mapInArrow(lambda b: _scored(b, shared), schema)
    return out.select(F.col("id").alias(id_col), (fold(F.col("id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of `docs` that score below the threshold, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    own = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*own)
    text = own[docs.columns.index(text_col)]
    renamed = plain.withColumnRenamed(text, "text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            yield batch.filter(pa.array([model.score(x.as_py()) < threshold for x in batch.column("text")], pa.bool_()))

    return renamed.mapInArrow(keep, renamed.schema).toDF(*docs.columns)
