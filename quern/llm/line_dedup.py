"""Line dedup (operator 2): patience alignment of documents that share lines, common blocks deleted from the later one.

Documents are ordered by id (nulls last), texts that are equal are one document whose later copies are common blocks as a
whole. A line is what stands between line feeds; lines of white space are blank, take no part and don't separate blocks. A
block is a run of lines that patience diff aligns, over all lines that two texts share, with nothing but blank lines between
them in either document; blocks of `min_words` words or more are deleted from the later document. The result is that of all
pairs of texts:

- A text's outline is its lines that other texts hold too, in runs. An outline without a run of `min_words` words has no
  block with any text. Texts of equal outline align alike: each but the first loses its long runs to the first, and only the
  first can take anything from others or give it.
- A window is a shortest run of `min_words` words, from each line on and up to each line; every line of a block lies in a
  window of the block. So texts without a common window have no block. A window in up to `rare` outlines pairs each two
  of them; a more frequent one pairs each later holder with the first. Rare lines (in up to `rare` texts) pair each two
  holders. Texts that share no rare line align by their outlines of other lines alone, so each is also paired with the
  first of equal such outline, and what is left of a frequent window (it crosses other blocks, or its lines repeat) is
  aligned with the first of each such outline that holds it. Pairs grow with the square of the different outlines only there.

A line always stays in the first text that holds it.

Null texts stay null and are no document; empty texts stay empty. Rows with equal id and text are one document and all stay;
of rows with equal id and different texts the text that sorts later by hash is the later one. An empty table gives no rows.
Other columns are ignored by dedup() and kept by applied(), whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from hashlib import md5

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.session import written


def rising(values: Sequence[int]) -> list[int]:
    """Positions of a longest increasing subsequence."""
    tops: list[int] = []
    ends: list[int] = []
    before = [-1] * len(values)
    for at, v in enumerate(values):
        k = bisect_left(tops, v)
        before[at] = ends[k - 1] if k else -1
        tops[k : k + 1] = [v]
        ends[k : k + 1] = [at]
    out, at = [], ends[-1] if ends else -1
    while at >= 0:
        out.append(at)
        at = before[at]
    return out[::-1]


def patience(a: Sequence, b: Sequence) -> list[tuple[int, int]]:
    """Aligned positions of two sequences: equal ends, then elements that are unique in both, and so on in the gaps."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        at_b = {x: j for j, x in enumerate(b[b0:b1], b0) if in_b[x] == 1}
        unique = [(i, at_b[x]) for i, x in enumerate(a[a0:a1], a0) if in_a[x] == 1 and x in at_b]
        anchors = [unique[k] for k in rising([j for _, j in unique])]
        if not anchors:
            continue
        out += anchors
        for (i, j), (k, m) in zip([(a0 - 1, b0 - 1), *anchors], [*anchors, (a1, b1)], strict=True):
            if i + 1 < k and j + 1 < m:
                todo.append((i + 1, k, j + 1, m))
    return sorted(out)


def common_blocks(earlier: list[tuple[int, bytes]], later: list[tuple[int, bytes]], words: dict[bytes, int], min_words: int) -> list[int]:
    """Positions of `later` in aligned blocks of enough words. Each document: (position among its lines that aren't blank,
    line) of the lines shared, in order."""
    out: list[int] = []
    block: list[int] = []
    size, last = 0, (-2, -2)
    for i, j in patience([h for _, h in earlier], [h for _, h in later]):
        now = (earlier[i][0], later[j][0])
        if now != (last[0] + 1, last[1] + 1):
            out += block if size >= min_words else []
            block, size = [], 0
        block.append(now[1])
        size += words[later[j][1]]
        last = now
    return out + (block if size >= min_words else [])


def runs(outline: Sequence[dict], min_words: int) -> Iterator[list[dict]]:
    """Runs of neighbouring lines that have enough words."""
    run: list[dict] = []
    for x in (*outline, None):
        if run and (x is None or x["pos"] != run[-1]["pos"] + 1):
            if sum(y["words"] for y in run) >= min_words:
                yield run
            run = []
        run.append(x)


def windows(run: Sequence[dict], min_words: int) -> set[tuple[int, int]]:
    """(start, end) of the shortest stretches of enough words from each line on and up to each line."""
    out, start, end, size = set(), 0, 0, 0
    for start in range(len(run)):
        while end < len(run) and size < min_words:
            size, end = size + run[end]["words"], end + 1
        if size >= min_words:
            out.add((start, end))
        size -= run[start]["words"]
    start = size = 0
    for end, x in enumerate(run, 1):
        size += x["words"]
        while size - run[start]["words"] >= min_words:
            size, start = size - run[start]["words"], start + 1
        if size >= min_words:
            out.add((start, end))
    return out


def outline_key(outline: Sequence[dict]) -> bytes:
    """Says which lines follow each other and which of them are neighbours, not where they are."""
    near = (b"\1" if k and y["pos"] == outline[k - 1]["pos"] + 1 else b"\0" for k, y in enumerate(outline))
    return md5(b"".join(n + y["h"] for n, y in zip(near, outline, strict=True))).digest()


def _outlined(batches: Iterator[pa.RecordBatch], rare: int, min_words: int) -> Iterator[pa.RecordBatch]:
    """Outlines with a long run: their key, that of their lines which aren't rare, and the positions in long runs."""
    for batch in batches:
        keep, keys, others, longs = [], [], [], []
        for row, x in enumerate(batch.column("outline")):
            outline = x.as_py()
            if long := [y["pos"] for run in runs(outline, min_words) for y in run]:
                keep.append(row)
                keys.append(outline_key(outline))
                others.append(outline_key([y for y in outline if y["df"] > rare]))
                longs.append(long)
        held = batch.take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays([*held.columns, pa.array(keys, pa.binary()), pa.array(others, pa.binary()), pa.array(longs, pa.list_(pa.int32()))], names=[*held.schema.names, "okey", "fkey", "long"])


def _windowed(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """(tkey, hash of a window, the positions at which it stands)."""
    for batch in batches:
        tkeys, hashes, ats = [], [], []
        for row in batch.to_pylist():
            at: dict[bytes, list[int]] = {}
            for run in runs(row["outline"], min_words):
                for start, end in windows(run, min_words):
                    at.setdefault(md5(b"".join(x["h"] for x in run[start:end])).digest(), []).extend(x["pos"] for x in run[start:end])
            tkeys += [row["tkey"]] * len(at)
            hashes += at
            ats += [sorted(set(x)) for x in at.values()]
        yield pa.RecordBatch.from_pydict({"tkey": pa.array(tkeys, pa.binary()), "w": pa.array(hashes, pa.binary()), "at": pa.array(ats, pa.list_(pa.int32()))})


def _aligned(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        gone: dict[bytes, set[int]] = {}
        for row in range(batch.num_rows):  # a row at a time, as outlines can be long
            of_a, of_b = batch.column("of_a")[row].as_py(), batch.column("of_b")[row].as_py()
            words = {x["h"]: x["words"] for x in of_a}
            shared = words.keys() & {x["h"] for x in of_b}
            sides = [[(x["pos"], x["h"]) for x in side if x["h"] in shared] for side in (of_a, of_b)]
            if found := common_blocks(*sides, words, min_words):
                gone.setdefault(batch.column("b")[row].as_py(), set()).update(found)
        yield pa.RecordBatch.from_pydict({"tkey": pa.array(list(gone), pa.binary()), "gone": pa.array([sorted(x) for x in gone.values()], pa.list_(pa.int32()))})


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def lines(text: Column) -> Column:
    """The lines that aren't blank: (index among all, hash, words)."""
    every = F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("index"), F.unhex(F.md5(x)).alias("h"), F.regexp_count(x, F.lit(r"\S+")).alias("words")))
    return F.filter(every, lambda x: x["words"] > 0)


def repeats(docs: DataFrame, id_col: str, text_col: str, *, rare: int, min_words: int) -> DataFrame:
    """Per distinct text: tkey, rep (least id), whole (enough words to be a block itself) and gone: positions, among the
    lines that aren't blank, to delete; for texts that occur once and lose nothing there is no row."""
    texts = docs.filter(docs[text_col].isNotNull()).select(docs[id_col].alias("id"), text_key(docs[text_col]).alias("tkey"), lines(docs[text_col]).alias("lines"))
    one = texts.groupBy("tkey").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("lines").alias("lines"))
    one = written(one, "texts")
    # most lines occur once; they go before anything else about them is shuffled
    often = one.select(F.explode(F.array_distinct(F.transform("lines", lambda x: x["h"]))).alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    often = written(often, "often")  # a plain table, so that a join with it can split a frequent line over tasks
    held = one.select("tkey", "rep", F.posexplode("lines").alias("pos", "line")).select("tkey", "rep", "pos", "line.h", "line.words").join(often, "h")
    outlines = held.groupBy("tkey").agg(F.first("rep").alias("rep"), F.array_sort(F.collect_list(F.struct("pos", "h", "words", "df"))).alias("outline"))
    schema = outlines.withColumn("okey", F.lit(None).cast("binary")).withColumn("fkey", F.lit(None).cast("binary")).withColumn("long", F.lit(None).cast("array<int>")).schema
    outlines = written(outlines.mapInArrow(lambda b: _outlined(b, rare, min_words), schema), "outlines")

    order = F.struct(F.col("rep").isNull().alias("last"), "rep", "tkey")
    leads = written(outlines.groupBy("okey").agg(F.min(order).alias("lead")), "leads")
    led = outlines.join(leads, "okey")
    follow = led.filter("tkey != lead.tkey").select("tkey", F.col("long").alias("gone"))
    firsts = written(led.filter("tkey = lead.tkey").select("tkey", "fkey", order.alias("x"), "outline"), "firsts")

    found = firsts.select("tkey", "outline").mapInArrow(lambda b: _windowed(b, min_words), "tkey binary, w binary, at array<int>")
    found = written(found.join(firsts.select("tkey", "x"), "tkey"), "windows")
    common = found.groupBy("w").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lead")).filter("n > 1")
    found = written(found.join(written(common, "common"), "w"), "held")

    def each_two(held: DataFrame, by: str) -> DataFrame:  # at most `rare` rows for each
        pairs = F.flatten(F.transform("all", lambda x, i: F.transform(F.slice("all", i + 2, F.size("all")), lambda y: F.struct(x["tkey"].alias("a"), y["tkey"].alias("b")))))
        return held.groupBy(by).agg(F.array_sort(F.collect_set("x")).alias("all")).select(F.explode(pairs).alias("p")).select("p.a", "p.b")

    linked = firsts.select("x", F.explode("outline").alias("line")).filter(F.col("line.df") <= rare).select("x", "line.h")
    linked = written(each_two(linked, "h").distinct(), "linked")
    kinds = firsts.groupBy("fkey").agg(F.min("x").alias("lead"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    alike = firsts.select("tkey", "fkey").join(kinds, "fkey").filter("tkey != lead.tkey").select(F.col("lead.tkey").alias("a"), F.col("tkey").alias("b"))
    alike = written(alike, "alike")
    many = found.filter((F.col("n") > rare) & (F.col("x.tkey") != F.col("lead.tkey")))
    met = each_two(found.filter(F.col("n") <= rare), "w").unionByName(many.select(F.col("lead.tkey").alias("a"), F.col("tkey").alias("b")))
    met = written(met.unionByName(linked).unionByName(alike).distinct(), "pairs")

    def aligned(pairs: DataFrame) -> DataFrame:
        of_a, of_b = (firsts.select(F.col("tkey").alias(side), F.col("outline").alias(f"of_{side}")) for side in "ab")
        both = pairs.join(of_a, "a").join(of_b, "b").select("b", "of_a", "of_b")
        return both.mapInArrow(lambda b: _aligned(b, min_words), "tkey binary, gone array<int>")

    def merged(gone: DataFrame) -> DataFrame:
        return gone.groupBy("tkey").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("gone"))

    gone = written(merged(aligned(met)), "aligned")
    rest = many.join(gone, "tkey", "left").filter(F.size(F.array_except("at", F.coalesce("gone", F.array().cast("array<int>")))) > 0)
    rest = written(rest.select("w", "tkey", "x"), "rest")
    if not rest.isEmpty():
        others = found.join(alike.select(F.col("b").alias("tkey")), "tkey", "left_anti").select("w", F.col("tkey").alias("a"), F.col("x").alias("y"))
        left = written(rest.join(others, "w").filter("y < x").select("a", F.col("tkey").alias("b")).distinct(), "left")
        # where the first of an outline shares rare lines with the text, the others of the outline stand for themselves
        near = left.join(linked, ["a", "b"]).join(alike.select("a", F.col("b").alias("c")), "a").select(F.col("c").alias("a"), "b")
        place = [firsts.select(F.col("tkey").alias(side), F.col("x").alias(f"x_{side}")) for side in "ab"]
        near = near.join(place[0], "a").join(place[1], "b").filter("x_a < x_b").select("a", "b")
        gone = gone.unionByName(aligned(left.unionByName(near).distinct().join(met, ["a", "b"], "left_anti")))
    gone = merged(gone.unionByName(follow))
    whole = F.aggregate("lines", F.lit(0), lambda n, x: n + x["words"]) >= min_words
    out = one.join(gone, "tkey", "left").filter("copies > 1 OR gone IS NOT NULL")
    index = F.transform("gone", lambda p: F.get(F.col("lines"), p)["index"])
    return written(out.select("tkey", "rep", whole.alias("whole"), F.coalesce(index, F.array().cast("array<int>")).alias("gone")), "gone")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, rare: int = 4, min_words: int = 8) -> DataFrame:
    """One row per document: id, text without the blocks deleted, n_lines (not blank) and n_removed of them."""
    return applied(docs.select(docs[id_col], docs[text_col]), id_col, text_col, rare=rare, min_words=min_words)


def applied(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, rare: int = 4, min_words: int = 8) -> DataFrame:
    """`docs` with the text deduplicated and n_lines and n_removed added (in place of columns of these names)."""
    found = repeats(docs, id_col, text_col, rare=rare, min_words=min_words)
    found = found.select(F.col("tkey").alias("__tkey"), F.col("rep").alias("__rep"), F.col("whole").alias("__whole"), F.col("gone").alias("__gone"))
    own = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    both = docs.select(*own).withColumn("__key", text_key(docs[text_col])).join(found, F.col("__key") == F.col("__tkey"), "left")
    every = F.split(text_col, "\n")
    copy = F.coalesce(F.col("__whole") & ~F.col(id_col).eqNullSafe(F.col("__rep")), F.lit(False))
    some = F.coalesce(F.size("__gone") > 0, F.lit(False))
    kept = F.array_except(F.sequence(F.lit(0), F.size(every) - 1), F.col("__gone"))
    text = F.when(copy, F.lit("")).when(some, F.array_join(F.transform(F.array(every), lambda e: F.transform(kept, lambda i: F.get(e, i)))[0], "\n")).otherwise(F.col(text_col))
    n_lines = F.coalesce(F.size(F.filter(every, lambda x: x.rlike(r"\S"))), F.lit(0)).cast("long")
    n_removed = F.when(copy, F.col("n_lines")).when(some, F.size("__gone").cast("long")).otherwise(F.lit(0).cast("long"))
    both = both.withColumn("n_lines", n_lines).withColumn("n_removed", n_removed)
    return both.select(*[text.alias(c) if c == text_col else F.col(c) for c in own], "n_lines", "n_removed")
