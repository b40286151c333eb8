"""Canonical JSON of nested columns, and hashes of it."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dumps(value, compact: bool = False) -> str:
    """Sorted keys, characters as they are; with a space after separators unless compact."""
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":") if compact else None)


def _without_nulls(value, at: str):
    """Objects in lists under the key `at` lose their null fields."""
    if isinstance(value, dict):
        return {k: [{a: b for a, b in x.items() if b is not None} for x in v] if k == at and isinstance(v, list) else _without_nulls(v, at) for k, v in value.items()}
    return [_without_nulls(x, at) for x in value] if isinstance(value, list) else value


def canonical(text: str | None, compact: bool = False, drop_nulls_in: str | None = None) -> str | None:
    """JSON text in canonical form."""
    if text is None:
        return None
    value = json.loads(text)
    return dumps(_without_nulls(value, drop_nulls_in) if drop_nulls_in else value, compact)


#: About so many bytes of a batch are turned into Python objects at once; a larger row is alone.
PIECE = 2 << 20


def pieces(batches: Iterator[pa.RecordBatch], most: int = PIECE) -> Iterator[pa.RecordBatch]:
    """The rows of batches in order, in batches of about `most` bytes: those that Spark makes are bounded by their number of
    rows, and rows differ a thousandfold. A batch is halved as long as it is over."""
    for batch in batches:
        parts = [batch]
        while parts:
            part = parts.pop()
            if part.num_rows > 1 and part.nbytes > most:
                half = part.num_rows // 2
                parts += [part.slice(half), part.slice(0, half)]
            else:
                yield part


def with_canonical(df: DataFrame, *, compact: bool = False, drop_nulls_in: str | None = None, **columns: Column) -> DataFrame:
    """`df` with canonical JSON of nested columns under new names. Nulls count, but for those in objects of `drop_nulls_in`.

    Select what is needed before: all columns pass through Arrow. A map of batches and no UDF, as the planner leaves a UDF
    over some higher-order functions where it can't be run."""
    named = list(columns)
    packed = df.withColumns({n: F.to_json(c, {"ignoreNullFields": "false"}) for n, c in columns.items()})

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            arrays = [pa.array([canonical(x, compact, drop_nulls_in) for x in a.to_pylist()], pa.string()) if n in named else a for n, a in zip(batch.schema.names, batch.columns, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

    return packed.mapInArrow(pack, packed.schema)
