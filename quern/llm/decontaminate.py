"""Benchmark decontamination (operator 8): Wu-Manber search for many word windows at once.

Words are runs of ASCII digits and letters and of any characters beyond ASCII, after lower-casing A-Z. A window is `width`
consecutive words of an item; an item of fewer words, but not none, is one window. The search reads symbols that are words:
windows of one length m share a table that gives, for each block of two words, how far the search may move on when a
document has that block there (m - 1 where no window has it); where the move is 0, a bucket by the block at the window's end
lists windows, which are compared with the document word by word. Each length of window has its own table.

Null texts have no words. Items without words have no windows; a null item_id reads as the empty string and items that
share an id are one. Documents with null or repeated ids are rows of their own. Empty tables: no documents give no rows, no
items leave every document clean. Other columns are ignored, whatever their names.

The items are the query set. Their distinct pieces (up to `PIECE` windows of one item; they overlap by what a window needs)
are dealt by hash into blocks of about `block_chars` characters of item text; the table of one block at a time is made on the
driver and broadcast, so its size is bounded whatever the benchmark's. One block is one narrow pass over the documents. More
blocks are one job each over the documents: its hits, once for each distinct text, are written to the shared folder and its table goes
before the next is made; in the end the hits of all blocks are put together by text.
"""

from __future__ import annotations

import math
import re
import string
from array import array
from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.session import dropped, written

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same before A-Z are lower-cased.
ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Most windows of one piece of an item.
PIECE = 1000
_SPANS = pa.list_(pa.list_(pa.int32()))


def words_of(text: str | None, find=re.compile(WORDS).findall) -> list[str]:
    """The words of a text; lower() of bytes turns only A-Z."""
    return find(text.encode().lower().decode()) if text else []


class Windows:
    """The windows of a set of items (id, text or words), ready to be searched for."""

    def __init__(self, items: list[tuple[str, str | list[str] | None]], width: int = 10):
        self.ids: dict[str, int] = {}
        numbers: dict[str, int] = {}
        by_length: dict[int, dict[bytes, set[int]]] = defaultdict(lambda: defaultdict(set))
        for item, given in items:
            words = given if isinstance(given, list) else words_of(given)
            symbols = array("I", [self.ids.setdefault(w, len(self.ids) + 1) for w in words])
            m, number = min(width, len(symbols)), numbers.setdefault(item, len(numbers))
            for i in range(len(symbols) - m + 1 if m else 0):
                by_length[m][symbols[i : i + m].tobytes()].add(number)
        self.items = list(numbers)
        self.tables = [(m, *self._table(m, windows)) for m, windows in sorted(by_length.items())]

    def _table(self, m: int, windows: dict[bytes, set[int]]):
        """Moves, and windows with the numbers of their items by block; a block is two words, or one where windows are a single
        word. A bucket of one window is that window, others are tables."""
        base, moves, buckets = len(self.ids) + 1, {}, {}
        for window, numbers in windows.items():
            symbols = array("I", window)
            found = min(numbers) if len(numbers) == 1 else tuple(sorted(numbers))
            for i in range(1, m):
                block = symbols[i - 1] * base + symbols[i]
                moves[block] = min(moves.get(block, m), m - 1 - i)
            end = symbols[0] if m == 1 else symbols[-2] * base + symbols[-1]
            held = buckets.get(end)
            if held is None:
                buckets[end] = (window, found)
            elif isinstance(held, dict):
                held[window] = found
            else:
                buckets[end] = {held[0]: held[1], window: found}
        return moves, buckets

    def search(self, symbols: Sequence[int]) -> Iterator[tuple[int, int, frozenset[str]]]:
        """(start, end, items) of every occurrence of every window; symbols: 0 for words that no item has."""
        symbols = array("I", symbols)
        n, base = len(symbols), len(self.ids) + 1
        for m, moves, buckets in self.tables:
            at, most, move_of = m - 1, m - 1, moves.get
            while at < n:
                if m > 1:
                    block = symbols[at - 1] * base + symbols[at]
                    move = move_of(block, most)
                    if move:
                        at += move
                        continue
                else:
                    block = symbols[at]
                held = buckets.get(block)
                if held is not None:
                    window = symbols[at - m + 1 : at + 1].tobytes()
                    found = held.get(window) if isinstance(held, dict) else held[1] if held[0] == window else None
                    if found is not None:
                        yield at - m + 1, at + 1, frozenset(self.items[k] for k in (found if isinstance(found, tuple) else (found,)))
                at += 1


def scan(batches: Iterator[pa.RecordBatch], tables, key: str, keep_text: bool) -> Iterator[pa.RecordBatch]:
    """Per row: `key`, the text (if kept), number of words, joined spans of hits and the items met."""
    windows = tables.value
    get = windows.ids.get
    for batch in batches:
        spans, found, counts = [], [], []
        for row in batch.column("text"):
            words = words_of(row.as_py())
            hits, items = [], set()
            for start, end, some in windows.search([get(w, 0) for w in words]):
                hits.append((start, end))
                items |= some
            spans.append([list(x) for x in joined(hits)])
            found.append(sorted(items))
            counts.append(len(words))
        out = {key: batch.column(key)} | ({"text": batch.column("text")} if keep_text else {})
        out |= {"n_words": pa.array(counts, pa.int64()), "spans": pa.array(spans, _SPANS), "items": pa.array(found, pa.list_(pa.string()))}
        yield pa.RecordBatch.from_pydict(out)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = [[list(x) for x in joined([tuple(s) for s in row])] for row in batch.column("spans").to_pylist()]
        yield pa.RecordBatch.from_pydict({"tkey": batch.column("tkey"), "spans": pa.array(spans, _SPANS), "items": batch.column("items")})


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that touch or overlap put together."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def pieces(items: DataFrame, item_col: str, text_col: str, width: int) -> DataFrame:
    """(item, words) of the items, long ones in pieces that hold all their windows together."""
    plain = F.translate(items[text_col].cast("string"), string.ascii_uppercase, string.ascii_lowercase)
    asked = items.select(F.coalesce(items[item_col].cast("string"), F.lit("")).alias("item"), F.regexp_extract_all(plain, F.lit(WORDS), F.lit(0)).alias("all")).filter("size(all) > 0")
    starts = F.sequence(F.lit(0), F.greatest(F.size("all") - width, F.lit(0)), F.lit(PIECE))
    cut = asked.select("item", "all", F.explode(starts).alias("at"))
    return cut.select("item", F.slice("all", F.col("at") + 1, F.lit(PIECE + width - 1)).alias("words")).distinct()


def find_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", *,
               width: int = 10, block_chars: int = 2_000_000, keep_text: bool = False) -> DataFrame:
    """One row per document: id, text (if kept), n_words, spans (word positions hit, joined) and items (ids met, sorted)."""
    context = docs.sparkSession.sparkContext
    asked = written(pieces(items, item_col, item_text_col, width), "asked")
    chars = asked.agg(F.sum(F.aggregate("words", F.lit(0), lambda n, w: n + F.char_length(w) + 1))).first()[0] or 0
    n_blocks = max(1, math.ceil(chars / block_chars))
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    hits = "n_words long, spans array<array<int>>, items array<string>"

    def table(block: int):
        part = asked.filter(F.pmod(F.xxhash64("item", "words"), F.lit(n_blocks)) == block).collect()
        return context.broadcast(Windows([(r["item"], r["words"]) for r in part], width))

    if n_blocks == 1:
        tables = table(0)
        schema = rows.select("id", *(["text"] if keep_text else []), F.lit(0).cast("long").alias("n_words"), F.lit(None).cast("array<array<int>>").alias("spans"), F.lit(None).cast("array<string>").alias("items")).schema
        return rows.mapInArrow(lambda b: scan(b, tables, "id", keep_text), schema)
    keyed = rows.withColumn("tkey", F.unhex(F.md5("text")))
    found = []
    for block in range(n_blocks):
        tables = table(block)
        met = keyed.select("tkey", "text").mapInArrow(lambda b, tables=tables: scan(b, tables, "tkey", False), f"tkey binary, {hits}").filter("size(spans) > 0")
        found.append(written(met.groupBy("tkey").agg(F.first("spans").alias("spans"), F.first("items").alias("items")), "hits"))
        tables.destroy()
    every = reduce(DataFrame.unionByName, found).groupBy("tkey")
    every = every.agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    every = written(every.mapInArrow(_merged, "tkey binary, spans array<array<int>>, items array<string>"), "met")
    dropped(*found)
    n_words = F.coalesce(F.regexp_count("text", F.lit(ANY_CASE)), F.lit(0)).cast("long").alias("n_words")
    counted = keyed.select("id", "tkey", n_words, *(["text"] if keep_text else []))  # texts don't move unless they are asked for
    none = F.coalesce("spans", F.array().cast("array<array<int>>")).alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
    return counted.join(every, "tkey", "left").select("id", *(["text"] if keep_text else []), "n_words", *none)


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", *, width: int = 10, block_chars: int = 2_000_000) -> DataFrame:
    """One row per document: its words, the words inside any window of an item, and which items those are of."""
    found = find_items(docs, items, id_col, text_col, item_col, item_text_col, width=width, block_chars=block_chars)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s[1] - s[0]))
    return found.select(
        F.col("id").alias(id_col),
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", *, width: int = 10) -> DataFrame:
    """The rows of `docs` that hold no window of an item, with all their columns."""
    own = [f"c{i}" for i in range(len(docs.columns))]
    text = own[docs.columns.index(text_col)]
    rest = [c for c in own if c != text]
    packed = docs.toDF(*own).select(F.struct(F.lit(0).alias("none"), *rest).alias("id"), F.col(text).alias("text"))
    kept = find_items(packed, items, "id", "text", item_col, item_text_col, width=width, keep_text=True).filter(F.size("spans") == 0)
    return kept.select(*[F.col("text").alias(c) if c == text else F.col(f"id.{c}") for c in own]).toDF(*docs.columns)
