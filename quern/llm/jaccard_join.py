"""N-gram Jaccard join (operator 3): MinHash banding, verified on whole shingle sets.

A shingle is `width` consecutive words (split at white space, lower-cased); a text of fewer words, but not none, is one
shingle. Documents with the same shingle set are a class of copies and take part once. For a row count, bands are as many as
give a pair at the threshold the target recall. Classes meet in the buckets of their band keys; buckets with the same
members are searched once. A pair is verified in its first common band only, on the full sets. A bucket is cut into chunks of
about `chunk_shingles` shingles and `chunk_classes` classes at most; the pairs within a chunk are counted, not emitted. Where a
bucket has several chunks, its least class leads: each chunk gets the leader's set too and sends on, for its pairs with other
chunks, only in what its sets differ from the leader's. As |A and B| = |L| - |L less A| - |L less B| + |(A differs from L) and
(B differs from L)|, that says the overlap exactly. So whole sets go to each bucket once, whatever its size; the differences,
which are small among near copies, go once for each other chunk. Each unit gives the links of each class, weighted by copies,
and a spanning forest of the links it found.

Null and empty texts and texts of white space have no shingles, no links and are classes of their own. Repeated rows and rows
with null ids count as documents; the class id is the least id that is not null (null where all are). An empty table gives no
rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.components import components
from quern.llm.shingles import MinHash, WordHashes, bands_for, shingle_set
from quern.session import written


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def class_key(shingles: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


def _signed(batches: Iterator[pa.RecordBatch], width: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    """The columns given but the text, class key, number of shingles and band keys of each text."""
    hashes, signer = WordHashes(), MinHash(bands, rows)
    for batch in batches:
        keys, sizes, signed = [], [], []
        for x in batch.column("text"):
            found = shingle_set(x.as_py(), width, hashes)
            keys.append(class_key(found))
            sizes.append(len(found))
            signed.append(signer.keys(found) if len(found) else None)
        own = {c: batch.column(c) for c in batch.schema.names if c != "text"}
        yield pa.RecordBatch.from_pydict(own | {"ckey": pa.array(keys, pa.binary()), "n": pa.array(sizes, pa.int32()), "bands": pa.array(signed, pa.list_(pa.int64()))})


_ROW = {"band": pa.int32(), "key": pa.int64(), "chunks": pa.int32(), "chunk": pa.int32(), "leads": pa.bool_(), "ckey": pa.binary(), "size": pa.int64(), "bands": pa.list_(pa.int64()), "shingles": pa.binary()}
_CROSS = {"band": pa.int32(), "key": pa.int64(), "i": pa.int32(), "j": pa.int32(), "chunk": pa.int32(), "ckey": pa.binary(), "size": pa.int64(), "bands": pa.list_(pa.int64()), "n": pa.int64(), "gone": pa.int64(), "lead": pa.int64(), "delta": pa.binary()}
_FOUND = {"a": pa.binary(), "b": pa.binary(), "links": pa.int64()}


def _packed(rows: list[dict], schema: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: pa.array([r.get(k) for r in rows], t) for k, t in schema.items()})


def _in_batches(rows: Iterator[dict], schema: dict[str, pa.DataType], data: str, limit: int = 32 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 100 + len(row.get(data) or b"")
        if size > limit:
            yield _packed(held, schema)
            held, size = [], 0
    if held:
        yield _packed(held, schema)


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The shingle set of a class for each of its buckets, and for each chunk of those that it leads. Rows that repeat a
    class follow each other and count once."""
    hashes = WordHashes()

    def rows() -> Iterator[dict]:
        last = None
        for batch in batches:
            for row in range(batch.num_rows):
                ckey = batch.column("ckey")[row].as_py()
                if ckey == last:
                    continue
                last = ckey
                data = shingle_set(batch.column("text")[row].as_py(), width, hashes).tobytes()
                own = {"ckey": ckey, "size": batch.column("size")[row].as_py(), "bands": batch.column("bands")[row].as_py(), "shingles": data}
                for unit in batch.column("units")[row].as_py():
                    yield own | unit | {"leads": False}
                    if unit["leads"] and unit["chunks"] > 1:
                        yield from (own | unit | {"chunk": c} for c in range(unit["chunks"]))

    return _in_batches(rows(), _ROW, "shingles")


def overlaps(sets: list[np.ndarray], mask: np.ndarray, left: np.ndarray, right: np.ndarray, columns: int = 4096) -> np.ndarray:
    """Sizes of the intersections of sets[left] with sets[right], at least where `mask` holds."""
    out = np.zeros(mask.shape, dtype=np.int64)
    if np.count_nonzero(mask) <= 48:
        for a, b in zip(*np.nonzero(mask), strict=True):
            out[a, b] = len(np.intersect1d(sets[left[a]], sets[right[b]], assume_unique=True))
        return out
    used, spot = np.unique(np.concatenate((left, right)), return_inverse=True)
    values = np.concatenate([sets[k] for k in used])
    owner = np.repeat(np.arange(len(used)), [len(sets[k]) for k in used])
    _, column, times = np.unique(values, return_inverse=True, return_counts=True)
    shared = times[column] > 1
    owner, column = owner[shared], column[shared]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    column = np.concatenate(([0], np.cumsum(column[1:] != column[:-1]))) if len(column) else column
    in_left, in_right = spot[: len(left)], spot[len(left) :]
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, columns):
        at = slice(*np.searchsorted(column, (start, start + columns)))
        held = np.zeros((len(used), columns), dtype=np.float32)
        held[owner[at], column[at] - start] = 1
        out += (held[in_left] @ held[in_right].T).astype(np.int64)
    return out


def links_of(sets: list[np.ndarray], n: np.ndarray, less: np.ndarray, bands: np.ndarray, band: int, left: np.ndarray, right: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The linked pairs of left with right, or within left where both are the same, as two arrays of positions. `n` are the
    sizes of the full sets; the overlap of a pair is that of `sets` less `less` of both."""
    mask = n[left][:, None] >= threshold * n[right][None, :] - 1e-9
    mask &= n[right][None, :] >= threshold * n[left][:, None] - 1e-9
    if left is right:
        mask &= left[:, None] < right[None, :]
    for b in range(band):
        mask &= bands[left, b][:, None] != bands[right, b][None, :]
    if not mask.any():
        return left[:0], left[:0]
    both = overlaps(sets, mask, left, right) - less[left][:, None] - less[right][None, :]
    linked = mask & (both >= threshold / (1 + threshold) * (n[left][:, None] + n[right][None, :]) - 1e-9)
    a, b = np.nonzero(linked)
    return left[a], right[b]


def forest(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links that span the components of (a, b): each member to its component's first."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        x, y = find(x), find(y)
        if x != y:
            root[max(x, y)] = min(x, y)
    return [(x, find(x)) for x in range(n) if find(x) != x]


def _links(rows: list[dict], a: np.ndarray, b: np.ndarray) -> Iterator[dict]:
    """(class, links found) and (class, class) links of a spanning forest."""
    sizes = np.array([r["size"] for r in rows])
    count = np.bincount(a, sizes[b], len(rows)) + np.bincount(b, sizes[a], len(rows))
    yield from ({"a": rows[k]["ckey"], "links": int(count[k])} for k in np.flatnonzero(count))
    yield from ({"a": rows[x]["ckey"], "b": rows[y]["ckey"], "links": 0} for x, y in forest(len(rows), a, b))


def _units(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[list[dict]]:
    """Rows that follow each other with equal `names`."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and any(row[k] != held[-1][k] for k in names):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _verified(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Links within each chunk, and what its sets differ in from the leader's, for each other chunk of the bucket."""

    def rows() -> Iterator[dict]:
        for unit in _units(batches, ("band", "key", "chunk")):
            leader = np.frombuffer(unit[0]["shingles"], np.uint64) if unit[0]["leads"] else None
            held = list({r["ckey"]: r for r in unit if not r["leads"]}.values())
            sets = [np.frombuffer(r["shingles"], np.uint64) for r in held]
            every, n = np.arange(len(held)), np.array([len(s) for s in sets])
            if len(held) > 1:
                yield from _links(held, *links_of(sets, n, np.zeros(len(held)), np.array([r["bands"] for r in held]), unit[0]["band"], every, every, threshold))
            if leader is None:
                continue
            for r, own in zip(held, sets, strict=True):
                delta = np.setxor1d(own, leader, assume_unique=True)
                gone = (len(delta) - len(own) + len(leader)) // 2
                sent = {k: r[k] for k in ("band", "key", "chunk", "ckey", "size", "bands")} | {"n": len(own), "gone": gone, "lead": len(leader), "delta": delta.tobytes()}
                yield from (sent | {"i": min(c, r["chunk"]), "j": max(c, r["chunk"])} for c in range(r["chunks"]) if c != r["chunk"])

    return _in_batches(rows(), _FOUND | _CROSS, "delta")


def _crossed(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Links between two chunks of a bucket."""

    def rows() -> Iterator[dict]:
        for unit in _units(batches, ("band", "key", "i", "j")):
            sets, less = [np.frombuffer(r["delta"], np.uint64) for r in unit], np.array([r["gone"] - r["lead"] / 2 for r in unit])
            left, right = (np.array([k for k, r in enumerate(unit) if r["chunk"] == unit[0][side]], np.int64) for side in "ij")
            if len(left) and len(right):
                yield from _links(unit, *links_of(sets, np.array([r["n"] for r in unit]), less, np.array([r["bands"] for r in unit]), unit[0]["band"], left, right, threshold))

    return _in_batches(rows(), _FOUND, "a")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, width: int = 5, threshold: float = 0.8, recall: float = 0.999, rows: int = 5,
         chunk_shingles: int = 400_000, chunk_classes: int = 1000, keyed: bool = False) -> DataFrame:
    """One row per document: id, class_id (least id among all that links connect), copy_id (least id among copies),
    n_copies, and n_links: documents whose similarity to this one is at least `threshold`, copies included. With `keyed`
    also tkey (hash of the text) and root (key of all that links connect; null without shingles)."""
    bands = bands_for(threshold, recall, rows)
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text")).withColumn("tkey", text_key(F.col("text")))
    schema = texts.select("id", "tkey", F.lit(None).cast("binary").alias("ckey"), F.lit(0).alias("n"), F.lit(None).cast("array<long>").alias("bands")).schema
    signed = written(texts.mapInArrow(lambda b: _signed(b, width, bands, rows), schema), "signed")
    row = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "tkey")).alias("row")
    classes = signed.filter("ckey IS NOT NULL").groupBy("ckey").agg(F.min("id").alias("rep"), row, F.count(F.lit(1)).alias("size"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    classes = written(classes, "classes")

    met = classes.select("ckey", "n", F.posexplode("bands").alias("band", "key"))
    buckets = met.groupBy("band", "key").agg(
        F.count(F.lit(1)).alias("members"), F.sum(F.col("n").cast("long")).alias("shingles"), F.min("ckey").alias("least"),
        F.bit_xor(F.xxhash64("ckey")).alias("h1"), F.bit_xor(F.xxhash64("ckey", F.lit(1))).alias("h2"),
    ).filter("members > 1")
    buckets = buckets.groupBy("members", "shingles", "h1", "h2", "least").agg(F.min(F.struct("band", "key")).alias("first")).select("first.*", "shingles", "members", "least")
    chunks = F.greatest(F.ceil(F.col("shingles") / chunk_shingles), F.ceil(F.col("members") / chunk_classes)).cast("int")
    buckets = written(buckets.select("band", "key", "least", chunks.alias("chunks")), "buckets")  # written, so that the join can split a large one
    chunk = F.pmod(F.xxhash64("ckey", F.lit(2)), F.col("chunks")).cast("int")
    unit = F.struct("band", "key", "chunks", chunk.alias("chunk"), (F.col("ckey") == F.col("least")).alias("leads"))
    wanted = met.join(buckets, ["band", "key"]).groupBy("ckey").agg(F.collect_list(unit).alias("units"))
    wanted = wanted.join(classes.select("ckey", "row", "size", "bands"), "ckey").select("*", F.col("row.id").alias("rid"), F.col("row.tkey").alias("rkey"))

    sent = texts.join(wanted, texts["id"].eqNullSafe(wanted["rid"]) & (texts["tkey"] == wanted["rkey"])).select("text", "ckey", "size", "bands", "units")
    shingled = sent.mapInArrow(lambda b: _sets(b, width), "band int, key long, chunks int, chunk int, leads boolean, ckey binary, size long, bands array<long>, shingles binary")
    dealt = shingled.repartition("band", "key", "chunk").sortWithinPartitions("band", "key", "chunk", F.desc("leads"))
    links, cross = "a binary, b binary, links long", "band int, key long, i int, j int, chunk int, ckey binary, size long, bands array<long>, n long, gone long, lead long, delta binary"
    first = written(dealt.mapInArrow(lambda b: _verified(b, threshold), f"{links}, {cross}"), "found")
    apart = first.filter("delta IS NOT NULL").drop("a", "b", "links").repartition("band", "key", "i", "j").sortWithinPartitions("band", "key", "i", "j")
    second = written(apart.mapInArrow(lambda b: _crossed(b, threshold), links), "crossed")
    found = first.filter("delta IS NULL").select("a", "b", "links").unionByName(second)

    counts = found.filter("b IS NULL").groupBy(F.col("a").alias("ckey")).agg(F.sum("links").alias("links"))
    roots = components(found.filter("b IS NOT NULL").select("a", "b"))
    known = classes.select("ckey", "rep", "size").join(counts, "ckey", "left").join(roots.withColumnRenamed("node", "ckey"), "ckey", "left")
    known = known.withColumn("root", F.coalesce("root", "ckey"))
    least = known.groupBy("root").agg(F.min("rep").alias("class_id"))
    known = known.join(least, "root").select("ckey", "root", "class_id", F.col("rep").alias("copy_id"), "size", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"))
    out = signed.select("id", "ckey", "tkey").join(known, "ckey", "left")
    alone = F.col("ckey").isNull()
    return out.select(
        F.col("id").alias(id_col),
        F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("id")).otherwise(F.col("copy_id")).alias("copy_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("n_copies"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        *(["tkey", "root"] if keyed else []),
    )


def kept(docs: DataFrame, joined: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay when one document of each class does: the one of least id (nulls last), then least
    hash of the text. Rows that repeat it in id and text stay with it; without an id, one such row does. Rows in no class
    (null texts and those without words) stay. All columns of `docs` stay. `joined` is join() of `docs`, keyed; where it
    isn't, the join is made anew, as ids don't say which row is meant."""
    if "root" not in joined.columns:
        joined = join(docs, id_col, text_col, keyed=True)
    order = F.struct(F.col(id_col).isNull().alias("last"), F.col(id_col).alias("id"), "tkey")
    classed = written(joined.filter("root IS NOT NULL").select("root", order.alias("row")), "classed")
    sizes = classed.groupBy("root").agg(F.min("row").alias("stays"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    sizes = written(sizes, "sizes")
    gone = classed.join(sizes, "root").filter("row != stays").select(F.col("row.id").alias("__id"), F.col("row.tkey").alias("__tkey")).distinct()
    key = text_key(docs[text_col].cast("string"))
    left = docs.join(gone, docs[id_col].eqNullSafe(gone["__id"]) & (key == gone["__tkey"]), "left_anti")
    # what stays of a class without an id, once
    named = left.withColumn("__key", text_key(left[text_col].cast("string")))
    twice = sizes.filter("stays.last").select(F.col("stays.tkey").alias("__twice"))
    mine = named.join(twice, named[id_col].isNull() & (F.col("__key") == F.col("__twice")), "left")
    rest = mine.filter("__twice IS NULL").select(*docs.columns)
    once = mine.filter("__twice IS NOT NULL").groupBy("__key").agg(F.first(F.struct(*docs.columns)).alias("row")).select("row.*")
    return rest.unionByName(once)
