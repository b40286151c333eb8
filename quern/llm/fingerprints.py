"""Document fingerprints (operator 9): threshold-scaled sketches, in DataFrame operations only.

A shingle is `width` consecutive words (runs of non-space, lower-cased); a text of fewer words, but not none, is one shingle.
A text's sketch is the set of its 64-bit shingle hashes below `fraction` of their range, whatever the text's length, and its
`floor` least ones where fewer than that are below: so a sketch knows all hashes of its text up to its `reach` (the limit, or
its last hash; everything where it has fewer than `floor`). Sketches merge: that of a union follows from the parts'. Two are
compared up to the lesser of their reaches, where both are whole, so containment between very unequal documents can be
estimated. With m hashes of the smaller one there, the standard error of a containment c is sqrt(c (1 - c) / m): about 0.1 at
most where `floor` = 24 count, 0.06 for 2,000 words, 0.03 for 10,000. Texts of fewer than `floor` shingles are compared
exactly with each other.

Null texts count as empty; a text without words has an empty sketch. Two empty sketches are alike (1.0) if the texts are
equal and unlike (0.0) otherwise. Rows with a null id come last in the order of documents;
rows with equal ids are ordered by the hash of the text, and rows equal in both are interchangeable. Ids are integers. An empty table gives
no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.session import written

FRACTION, FLOOR = 1 / 32, 24


def limit_of(fraction: float) -> int:
    return int(-(2**63) + fraction * 2**64)


def sketch(text: Column, width: int = 5, fraction: float = FRACTION, floor: int = FLOOR) -> Column:
    """The sorted low shingle hashes of a text."""
    words = F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")

    def hashes(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(w) - width, F.lit(0)))
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))

    # arrays of one element pass the words and the hashes on, so that they are made once for each text
    every = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, hashes(w)).otherwise(F.array().cast("array<long>")))
    return F.transform(every, lambda h: _low(h, fraction, floor))[0]


def _low(hashes: Column, fraction: float, floor: int) -> Column:
    """Of some hashes those that a sketch of all keeps."""
    low = F.array(F.array_distinct(F.filter(hashes, lambda h: h < F.lit(limit_of(fraction)).cast("long"))))
    least = lambda: F.slice(F.sort_array(F.array_distinct(hashes)), 1, floor)
    return F.transform(low, lambda x: F.when(F.size(x) >= floor, F.sort_array(x)).otherwise(least()))[0]


def reach(hashes: Column, fraction: float = FRACTION, floor: int = FLOOR) -> Column:
    """Up to where a sketch has all hashes of its text."""
    last = F.greatest(F.lit(limit_of(fraction) - 1).cast("long"), F.get(hashes, F.size(hashes) - 1))
    return F.when(F.size(hashes) < floor, F.lit(2**63 - 1).cast("long")).otherwise(last)


def containment(a: Column, b: Column, fraction: float = FRACTION, floor: int = FLOOR) -> Column:
    """Share of the smaller sketch that the other holds, as far as both reach: an estimate of the containment of the smaller text."""
    both = F.least(*[reach(x, fraction, floor) for x in (a, b)])
    cut = F.array(F.struct(*[F.filter(x, lambda h: h <= both).alias(n) for n, x in (("a", a), ("b", b))]))

    def share(x: Column) -> Column:
        least = F.least(F.size(x["a"]), F.size(x["b"]))
        return F.when(least > 0, F.size(F.array_intersect(x["a"], x["b"])) / least).otherwise(F.lit(0.0))

    return F.transform(cut, share)[0]


def printed(hashes: Column) -> Column:
    """A sketch as text: 16 hexadecimal digits for each hash, in order."""
    return F.array_join(F.transform(hashes, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def union(*sketches: Column, fraction: float = FRACTION, floor: int = FLOOR) -> Column:
    """The sketch of documents put together."""
    return _low(F.concat(*sketches), fraction, floor)


def _longs(values: list, kind: str = "long") -> Column:
    """A literal array, however long."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>") if values else F.array().cast(f"array<{kind}>")


def _rank(value: Column, bounds: list[int], step: int = 128) -> Column:
    """How many of the sorted bounds are at or below a value, which isn't below the first, less one: by every step-squared-th, then
    more finely."""

    def finer(at: Column, wide: int, some: list[int]) -> Column:
        # an array of one element passes the position on
        of = lambda k: k + F.size(F.filter(F.slice(_longs(some), k + 1, F.lit(step)), lambda b: b <= value)) - 1
        return F.transform(F.array(F.floor(at / wide).cast("int")), of)[0] * wide

    coarse = _longs(bounds[:: step * step])
    at = (F.size(F.filter(coarse, lambda b: b <= value)) - 1) * step * step
    return finer(finer(at, step, bounds[::step]), 1, bounds)


def with_next(docs: DataFrame, order: Column, tie: Column, carry: list[str], more: dict[str, Column] | None = None, rows_per_bucket: int = 500, most: int = 1_000_000) -> DataFrame:
    """Each row with `next`, the struct of `carry` of the row that follows by (order, tie), nulls last; after the last: the
    first. `more` are columns made of those of `carry`, once for each row; they are carried too.

    Rows are dealt into buckets between quantiles of `order`, about n / `rows_per_bucket` of them (`most` at most, so beyond
    5e8 rows buckets grow). A value that fills several, and null, is cut further by ranges of `tie`, a 64-bit hash: only
    rows equal in both can't be told apart. The least key of each bucket (a row a bucket) says which row also goes, as a
    ghost, to the bucket before it, and to the last one from the first."""
    more = more or {}
    keyed = docs.withColumn("__o", order.cast("long")).withColumn("__t", tie)
    n, n_null = keyed.agg(F.count(F.lit(1)), F.count_if(F.col("__o").isNull())).first()
    n_buckets = min(most, (n - n_null) // rows_per_bucket + 1)
    steps = _longs([k / n_buckets for k in range(n_buckets)], "double")
    quantiles, least = keyed.agg(F.percentile_approx("__o", steps, 2 * n_buckets + 10_000), F.min("__o")).first()
    found = Counter(quantiles or [])
    bounds = sorted({*found, least} - {None})
    parts = [max(found[b], 1) for b in bounds] + [min(most, n_null // rows_per_bucket + 1)]  # of null: the last
    first = [0]
    for c in parts:
        first.append(first[-1] + c + (c > 1))  # those of the bound itself, then the others up to the next
    at = F.when(F.col("__o").isNull(), F.lit(len(bounds))).otherwise(_rank(F.col("__o"), bounds)) if bounds else F.lit(0)
    by_tie = lambda c: F.least(F.floor((F.col("__t") / F.lit(2.0**64) + 0.5) * c), c - 1)
    whole = F.col("__o").isNull() | (F.col("__o") == F.get(_longs([*bounds, 0]), F.col("__at")))
    n_parts = F.get(_longs(parts), F.col("__at"))
    bucket = F.get(_longs(first), F.col("__at")) + F.when(n_parts == 1, F.lit(0)).when(whole, by_tie(n_parts)).otherwise(n_parts)
    keyed = keyed.withColumn("__at", at.cast("int")).withColumn("__b", bucket.cast("long")).drop("__at")

    key = F.struct(F.col("__o").isNull().alias("last"), "__o", "__t")
    firsts = written(keyed.groupBy("__b").agg(F.min(key).alias("f")), "firsts")
    by_bucket = Window.orderBy("__b")
    following = F.coalesce(F.lead("f").over(by_bucket), F.first("f").over(by_bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    after = written(firsts.select(F.col("__b").alias("__to"), following.alias("f")), "after")
    after = after.select("__to", F.col("f.__o").alias("__fo"), F.col("f.__t").alias("__ft"))
    after = F.broadcast(after) if first[-1] <= 100_000 else after  # 40 bytes a bucket
    met = keyed.join(after, F.col("__o").eqNullSafe(F.col("__fo")) & (F.col("__t") == F.col("__ft")))
    ghosts = met.groupBy("__to").agg(F.first(F.struct(*carry)).alias("x")).select(F.col("__to").alias("__b"), "x.*", F.lit(1).alias("__g"))

    every = keyed.withColumn("__g", F.lit(0)).unionByName(ghosts, allowMissingColumns=True).withColumns(more)
    by = Window.partitionBy("__b").orderBy("__g", F.col("__o").asc_nulls_last(), "__t")
    return every.withColumn("next", F.lead(F.struct(*carry, *more)).over(by)).filter("__g = 0").drop("__o", "__t", "__b", "__g")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, width: int = 5, fraction: float = FRACTION, floor: int = FLOOR) -> DataFrame:
    """One row per document: its fingerprint, that of its text edited by half with the next document's, and how alike its
    own is to the edited text's and to the next document's (containment of the smaller sketch)."""
    own = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    paired = with_next(own, F.col("id").cast("long"), F.xxhash64("text"), ["text"], {"hashes": sketch(F.col("text"), width, fraction, floor)})
    n = F.char_length("text")
    half = F.expr("char_length(text) div 2").cast("int")
    edited = F.concat(F.left("text", n - half), F.left(F.col("next.text"), half))
    paired = paired.withColumn("edited", edited).withColumn("edited_hashes", sketch(F.col("edited"), width, fraction, floor))

    def alike(a: Column, b: Column, same: Column) -> Column:
        return F.when((F.size(a) == 0) & (F.size(b) == 0), same.cast("double")).otherwise(containment(a, b, fraction, floor))

    return paired.select(
        F.col("id").alias(id_col),
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        printed(F.col("hashes")).alias("fingerprint"),
        printed(F.col("edited_hashes")).alias("edited_fingerprint"),
        alike(F.col("hashes"), F.col("edited_hashes"), F.col("text") == F.col("edited")).alias("near_edited"),
        alike(F.col("hashes"), F.col("next.hashes"), F.col("text") == F.col("next.text")).alias("near_next"),
    )
