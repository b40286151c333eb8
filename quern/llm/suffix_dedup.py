"""Suffix-array dedup (operator 1): sparse suffix arrays over words.

Texts that are equal take part once; those of `min_words` words or more are spans as a whole. Suffixes are retained at
minimisers: of each `window` consecutive runs of `gram` words, where the run with the least hash begins. A passage of
`min_words` words that occurs twice has a retained suffix among its first `window` words, at the same place in both
occurrences, and from there at least stem = min_words - window + 1 words to go. So:

1. suffixes are grouped by the hash of their first `stem` words; those alone in their group go;
2. of the others, what follows the stem is sorted within the group, as a suffix array would, and what precedes the suffix is
   sorted read backwards; with each neighbour the common length is taken, 2 * window words at most. The longest common
   extension with any member of the group is one with a neighbour, so this is exact. Rows are dealt by ranges of the sorted
   order, ties by text, so a group may have any size; the first and last row of each range are compared afterwards;
3. a stem extended to one side has one partner, so one of `min_words` words or more is a repeat. What extensions to both
   sides reach together may have two partners: there each passage of `min_words` words about the stem, in all texts that
   have the stem, is hashed and stays if its hash occurs twice.

Hence a word is in a span if and only if it lies in a passage of `min_words` words that occurs at least twice, in one document
or in several; passages that touch are one span. Words are runs of non-space as they stand.

Null and empty texts and texts of fewer than `min_words` words have no spans. Rows with null or repeated ids are occurrences
of their own; a row that occurs twice is a repeat as a whole. An empty table gives no rows. Other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.shingles import WordHashes, mixed, runs
from quern.session import dropped, written

_BASES = (0x2545F4914F6CDD1D, 0x9E3779B97F4A7C15)


class Runs:
    """Hashes of runs of words from prefix sums weighted by powers of an odd base; powers are kept and grow as needed."""

    def __init__(self, base: int = _BASES[0]):
        self.base, self.inverse_base = base, pow(base, -1, 2**64)
        self._grow(1 << 12)

    def _grow(self, n: int) -> None:
        powers = lambda b: np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n, b, np.uint64))), dtype=np.uint64)
        self.powers, self.inverse = powers(self.base), powers(self.inverse_base)

    def __call__(self, hashes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
        """Hashes of the runs of `size` words that begin at `at`."""
        if len(hashes) >= len(self.powers):
            self._grow(2 * len(hashes))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * self.powers[: len(hashes)], dtype=np.uint64)))
        return mixed((sums[at + size] - sums[at]) * self.inverse[at])


def sliding(values: np.ndarray, size: int, best) -> np.ndarray:
    """`best` (a ufunc: minimum or maximum) of each `size` consecutive values, by doubling."""
    span = 1
    while span * 2 <= size:
        values = best(values[:-span], values[span:])
        span *= 2
    return best(values[: len(values) - (size - span)], values[size - span :]) if size > span else values


def minimisers(hashes: np.ndarray, gram: int, window: int) -> np.ndarray:
    """Where a run of `gram` words begins that is least in some `window` consecutive ones; equal runs all count."""
    grams = runs(hashes, gram) if len(hashes) >= gram else hashes[:0]
    if len(grams) < window:
        return np.zeros(0, np.int64)
    least = sliding(grams, window, np.minimum)
    edge = np.zeros(window - 1, np.uint64)
    return np.flatnonzero(grams == sliding(np.concatenate((edge, least, edge)), window, np.maximum))


def _anchors(hashes: np.ndarray, gram: int, window: int, stem: int) -> np.ndarray:
    at = minimisers(hashes, gram, window)
    return at[at + stem <= len(hashes)]


def _stems(batches: Iterator[pa.RecordBatch], gram: int, window: int, stem: int) -> Iterator[pa.RecordBatch]:
    """(key of the stem, text, whether the text has it more than once) for the stems of the suffixes retained."""
    words, run_hashes = WordHashes(), Runs()
    for batch in batches:
        keys, many, rows = [np.zeros(0, np.uint64)], [np.zeros(0, bool)], []
        for x, row in zip(batch.column("text"), batch.column("ra").to_pylist(), strict=True):
            hashes = words((x.as_py() or "").split())
            key, n = np.unique(run_hashes(hashes, _anchors(hashes, gram, window, stem), stem), return_counts=True)
            keys.append(key)
            many.append(n > 1)
            rows.append((row, len(key)))
        ra = np.repeat(np.array([r for r, _ in rows], np.int64), np.array([n for _, n in rows], np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(ra), pa.array(np.concatenate(many))], names=["key", "ra", "many"])


_SENT = {"key": pa.int64(), "left": pa.binary(), "lsize": pa.int8(), "right": pa.binary(), "rsize": pa.int8(), "ra": pa.int64(), "rb": pa.int64(), "start": pa.int32(), "end": pa.int32()}


def _contexts(batches: Iterator[pa.RecordBatch], gram: int, window: int, stem: int, min_words: int) -> Iterator[pa.RecordBatch]:
    """For each suffix that isn't alone: 32 bits of each of the words before its stem, backwards, and of those after it; start
    and end are its stem's. What a text has twice with both contexts goes once, and what that covers goes as a span (without
    a key), as does all of a text that has copies."""
    words, first_key, second_key = WordHashes(), Runs(_BASES[0]), Runs(_BASES[1])
    reach = 2 * window
    for batch in batches:
        held: list[pa.RecordBatch] = []
        n_held = 0
        columns = (batch.column("text"), batch.column("ra").to_pylist(), batch.column("rb").to_pylist(), batch.column("copies").to_pylist(), batch.column("keys"))
        for x, ra, rb, copies, wanted in zip(*columns, strict=True):
            hashes = words((x.as_py() or "").split())
            n, spans = len(hashes), []
            if copies > 1 and n >= min_words:
                spans.append((0, n))
            at = _anchors(hashes, gram, window, stem)
            keys = np.array(wanted.as_py() or [], np.int64)
            at = at[np.isin(first_key(hashes, at, stem).view(np.int64), keys)]
            short = np.concatenate((np.zeros(reach, np.uint32), (hashes >> np.uint64(32)).astype(np.uint32), np.zeros(reach, np.uint32)))
            key = second_key(hashes, at, stem).view(np.int64)
            left = np.ascontiguousarray(short[at[:, None] + (reach - 1 - np.arange(reach))[None, :]])
            right = np.ascontiguousarray(short[at[:, None] + (reach + stem + np.arange(reach))[None, :]])
            lsize, rsize = np.minimum(at, reach), np.minimum(n - at - stem, reach)
            whole = np.concatenate((key.view(np.uint32).reshape(-1, 2), left, right, lsize[:, None].astype(np.uint32), rsize[:, None].astype(np.uint32)), axis=1)
            _, once, group, times = np.unique(whole, axis=0, return_index=True, return_inverse=True, return_counts=True)
            again = times[group.reshape(-1)] > 1
            spans += zip((at - lsize)[again].tolist(), (at + stem + rsize)[again].tolist(), strict=True)
            spans = joined([(a, b) for a, b in spans if b - a >= min_words])
            m, k = len(once), len(spans)

            def column(t: pa.DataType, values, blank=None) -> pa.Array:  # of the suffixes, then of the spans
                return pa.concat_arrays([pa.array(values, t) if isinstance(values, np.ndarray) else values, pa.array([blank] * k, t) if not isinstance(blank, list) else pa.array(blank, t)])

            def packed(context: np.ndarray, m=m, once=once) -> pa.Array:
                return pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * reach), m, [None, pa.py_buffer(context[once].tobytes())]).cast(pa.binary())

            arrays = [
                column(pa.int64(), key[once]), column(pa.binary(), packed(left)), column(pa.int8(), lsize[once]), column(pa.binary(), packed(right)), column(pa.int8(), rsize[once]),
                column(pa.int64(), np.full(m, ra), ra), column(pa.int64(), np.full(m, rb), rb), column(pa.int32(), at[once], [a for a, _ in spans]), column(pa.int32(), at[once] + stem, [b for _, b in spans]),
            ]
            held.append(pa.RecordBatch.from_arrays(arrays, names=list(_SENT)))
            n_held += held[-1].num_rows
            if n_held > 25_000:
                yield pa.Table.from_batches(held).combine_chunks().to_batches(max_chunksize=n_held)[0]
                held, n_held = [], 0
        if n_held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches(max_chunksize=n_held)[0]


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that touch or overlap put together."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_MET = "side byte, key long, context binary, size byte, ra long, rb long, start int, best int"


def _neighbours(batches: Iterator[pa.RecordBatch], reach: int, borders: bool) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (side, key, context): each suffix with its longest common length with a neighbour of the same key. The
    last row of a batch waits for the next. With `borders` the first and the last row of all follow, with their contexts."""
    names = ("side", "key", "size", "ra", "rb", "start")
    wait: dict[str, np.ndarray] | None = None
    first: dict[str, np.ndarray] | None = None
    open_best, n_rows = 0, 0

    def emit(rows: dict[str, np.ndarray], best: np.ndarray | None) -> pa.RecordBatch:
        n = len(rows["ra"])
        context = pa.nulls(n, pa.binary()) if best is not None else pa.array([c.tobytes() for c in rows["context"]], pa.binary())
        best = pa.nulls(n, pa.int32()) if best is None else pa.array(best.astype(np.int32))
        kinds = (np.int8, np.int64, np.int8, np.int64, np.int64, np.int32)
        side, key, size, ra, rb, start = (pa.array(rows[k].astype(t)) for k, t in zip(names, kinds, strict=True))
        return pa.RecordBatch.from_arrays([side, key, context, size, ra, rb, start, best], names=["side", "key", "context", "size", "ra", "rb", "start", "best"])

    for batch in batches:
        if not batch.num_rows:
            continue
        now = {k: batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in names}
        now["context"] = np.frombuffer(b"".join(batch.column("context").to_pylist()), np.uint32).reshape(-1, reach)
        n_rows += batch.num_rows
        first = first or {k: v[:1].copy() for k, v in now.items()}
        if wait is not None:
            now = {k: np.concatenate((wait[k], now[k])) for k in now}
        n = len(now["ra"])
        same = (now["key"][1:] == now["key"][:-1]) & (now["side"][1:] == now["side"][:-1])
        differ = now["context"][1:] != now["context"][:-1]
        common = np.where(differ.any(axis=1), differ.argmax(axis=1), reach) if n > 1 else np.zeros(0, np.int64)
        common = np.where(same, np.minimum(np.minimum(common, now["size"][1:]), now["size"][:-1]), 0)
        best = np.zeros(n, np.int64)
        best[:-1] = common
        best[1:] = np.maximum(best[1:], common)
        if wait is not None:
            best[0] = max(best[0], open_best)
        yield emit({k: v[:-1] for k, v in now.items()}, best[:-1])
        wait, open_best = {k: v[-1:].copy() for k, v in now.items()}, int(best[-1])
    if wait is not None:
        yield emit(wait, np.array([open_best]))
        if borders:
            yield emit(first, None)
            if n_rows > 1:
                yield emit(wait, None)


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_STEMS = pa.list_(pa.struct([("key", pa.int64()), ("at", pa.int32()), ("l", pa.int32()), ("r", pa.int32())]))


def _settled(batches: Iterator[pa.RecordBatch], stem: int, min_words: int) -> Iterator[pa.RecordBatch]:
    """Per text: the spans that have one partner, the stems that reach `min_words` words to both sides together, and the keys of
    those whose reach holds words outside the spans."""
    for batch in batches:
        out: list[tuple] = []
        for ra, rb, found in zip(batch.column("ra").to_pylist(), batch.column("rb").to_pylist(), batch.column("found"), strict=True):
            sides: tuple[dict, dict] = ({}, {})
            spans, keys = [], {}
            for x in found.as_py():
                if x["side"] == 2:
                    spans.append((x["start"], x["start"] + x["best"]))
                else:
                    keys[x["start"]] = x["key"]
                    sides[x["side"]][x["start"]] = max(x["best"], sides[x["side"]].get(x["start"], 0))
            reaches = [(a, sides[0].get(a, 0), sides[1].get(a, 0)) for a in sorted(keys)]
            spans += [(a - n, a + stem) for a, n, _ in reaches if n + stem >= min_words] + [(a, a + stem + n) for a, _, n in reaches if n + stem >= min_words]
            spans = joined(spans)
            wide = [(a, n, m) for a, n, m in reaches if n + stem + m >= min_words]
            edges, at = set(), 0
            for a, n, m in wide:
                while at < len(spans) and spans[at][1] < a + stem:
                    at += 1
                if not any(s <= a - n and a + stem + m <= e for s, e in spans[max(at - 1, 0) : at + 2]):
                    edges.add(keys[a])
            if spans or wide:
                out.append((ra, rb, [{"start": a, "end": b} for a, b in spans], [{"key": keys[a], "at": a, "l": n, "r": m} for a, n, m in wide], sorted(edges)))
        columns = list(zip(*out, strict=True)) or [[]] * 5
        kinds = (pa.int64(), pa.int64(), _SPANS, _STEMS, pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["ra", "rb", "spans", "stems", "edges"])


def _windows(batches: Iterator[pa.RecordBatch], window: int, min_words: int) -> Iterator[pa.RecordBatch]:
    """128 bits of each passage of `min_words` words that begins up to `window` - 1 words before a stem asked for."""
    words, one, two = WordHashes(), Runs(_BASES[0]), Runs(_BASES[1])
    for batch in batches:
        for x, ra, rb, stems in zip(batch.column("text"), batch.column("ra").to_pylist(), batch.column("rb").to_pylist(), batch.column("stems"), strict=True):
            starts = {s["at"] - o for s in stems.as_py() for o in range(max(0, window - 1 - s["r"]), min(window - 1, s["l"]) + 1)}
            at = np.array(sorted(starts), np.int64)
            hashes = words((x.as_py() or "").split())
            arrays = [pa.array(h(hashes, at, min_words).view(np.int64)) for h in (one, two)] + [pa.array(np.full(len(at), r, np.int64)) for r in (ra, rb)] + [pa.array(at.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, names=["w", "v", "ra", "rb", "start"])


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for ra, rb, found in zip(batch.column("ra").to_pylist(), batch.column("rb").to_pylist(), batch.column("found").to_pylist(), strict=True):
            out += [(ra, rb, a, b) for a, b in joined([(x["start"], x["end"]) for x in found])]
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], names=["ra", "rb", "start_word", "end_word"])


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_words: int = 50, gram: int = 8, window: int = 16) -> DataFrame:
    """One row per span: id, start_word and end_word (exclusive), n_words. Documents without repeats have none."""
    stem, reach = min_words - window + 1, 2 * window
    if stem < gram:
        raise ValueError("min_words must be at least window + gram - 1")
    texts = docs.filter(docs[text_col].isNotNull()).select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    texts = texts.withColumn("ra", F.xxhash64("text")).withColumn("rb", F.xxhash64("text", F.lit(1)))  # 128 bits name a text
    stems = written(texts.select("text", "ra").mapInArrow(lambda b: _stems(b, gram, window, stem), "key long, ra long, many boolean"), "stems")
    often = stems.groupBy("key").agg(F.min("ra").alias("least"), F.max("ra").alias("most"), F.max("many").alias("many")).filter("least != most OR many").select("key")
    often = written(often, "often")  # a plain table, so that a join with it can split a frequent stem over tasks
    met = stems.join(often, "key").groupBy("ra").agg(F.collect_set("key").alias("keys"))
    # copies meet in one row before they are shuffled
    once = texts.groupBy("ra", "rb").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    met = met.join(texts.select("ra", "rb").distinct(), "ra")
    sent = once.join(met, ["ra", "rb"], "left").filter("copies > 1 OR keys IS NOT NULL").select("text", "ra", "rb", "copies", "keys")
    sent = written(sent, "sent")
    contexts = "key long, left binary, lsize byte, right binary, rsize byte, ra long, rb long, start int, end int"
    contexts = written(sent.mapInArrow(lambda b: _contexts(b, gram, window, stem, min_words), contexts), "contexts")
    dropped(stems, often)

    sides = F.array(*[F.struct(F.lit(k).cast("byte").alias("side"), F.col(c).alias("context"), F.col(f"{c[0]}size").alias("size")) for k, c in enumerate(("left", "right"))])
    rows = contexts.filter("key IS NOT NULL").select("key", "ra", "rb", "start", F.explode(sides).alias("x")).select("x.side", "key", "x.context", "x.size", "ra", "rb", "start")
    order = ("side", "key", "context", "ra", "rb", "start")
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    lengths = written(dealt.mapInArrow(lambda b: _neighbours(b, reach, True), _MET), "lengths")
    # two rows of each range, in one task
    edge = lengths.filter("best IS NULL").select("side", "key", "context", "size", "ra", "rb", "start").repartition(1).sortWithinPartitions(*order)
    edge = edge.mapInArrow(lambda b: _neighbours(b, reach, False), _MET)
    pieces = lengths.filter("best IS NOT NULL").unionByName(edge).select("ra", "rb", F.struct("start", "key", F.col("side").cast("int").alias("side"), "best").alias("x"))
    again = contexts.filter("key IS NULL").select("ra", "rb", F.struct("start", "key", F.lit(2).alias("side"), (F.col("end") - F.col("start")).alias("best")).alias("x"))
    found = pieces.unionByName(again).groupBy("ra", "rb").agg(F.collect_list("x").alias("found"))
    settled = "ra long, rb long, spans array<struct<start:int,end:int>>, stems array<struct<key:long,at:int,l:int,r:int>>, edges array<long>"
    settled = written(found.mapInArrow(lambda b: _settled(b, stem, min_words), settled), "settled")

    keys = written(settled.select(F.explode("edges").alias("key")).distinct(), "edges")
    asked = settled.select("ra", "rb", F.explode("stems").alias("s")).withColumn("key", F.col("s.key")).join(keys, "key")
    asked = asked.groupBy("ra", "rb").agg(F.collect_list("s").alias("stems")).join(sent.select("ra", "rb", "text"), ["ra", "rb"])
    windows = written(asked.select("ra", "rb", "text", "stems").mapInArrow(lambda b: _windows(b, window, min_words), "w long, v long, ra long, rb long, start int"), "windows")
    twice = written(windows.groupBy("w", "v").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("w", "v"), "twice")
    more = windows.join(twice, ["w", "v"]).select("ra", "rb", F.struct("start", (F.col("start") + min_words).alias("end")).alias("x"))
    every = settled.select("ra", "rb", F.explode("spans").alias("x")).unionByName(more).groupBy("ra", "rb").agg(F.collect_list("x").alias("found"))
    spans = every.mapInArrow(_spans, "ra long, rb long, start_word int, end_word int")
    out = texts.select("id", "ra", "rb").join(spans, ["ra", "rb"])
    return out.select(F.col("id").alias(id_col), "start_word", "end_word", (F.col("end_word") - F.col("start_word")).alias("n_words"))
