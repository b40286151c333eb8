"""First-fit packing in order: whole groups while a budget lasts, larger groups sliced."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def chunk_of_each(sizes: Column, budget: int) -> Column:
    """For each size the number of its chunk, from 1: a chunk is closed when the next size doesn't fit."""
    if budget <= 0:
        raise ValueError("budget must be positive")
    start = F.struct(F.lit(0).alias("chunk"), F.lit(0).alias("held"), F.array().cast("array<int>").alias("out"))

    def step(acc: Column, size: Column) -> Column:
        fits = (acc["chunk"] > 0) & (acc["held"] + size <= budget)
        chunk = acc["chunk"] + F.when(fits, 0).otherwise(1)
        return F.struct(chunk.alias("chunk"), F.when(fits, acc["held"] + size).otherwise(size).alias("held"), F.array_append(acc["out"], chunk).alias("out"))

    return F.aggregate(sizes, start, step, lambda acc: acc["out"])


def chunk_plan(sizes: Column, budget: int) -> Column:
    """array<struct<chunk, group, first, n>>: which elements of which group (from 0) each chunk holds. A group over the
    budget is cut in slices, each alone in a chunk; groups of size 0 ride along."""
    if budget <= 0:
        raise ValueError("budget must be positive")
    part = "array<struct<chunk:int,group:int,first:int,n:int>>"
    start = F.struct(F.lit(0).alias("chunk"), F.lit(0).alias("held"), F.lit(False).alias("open"), F.lit(0).alias("at"), F.array().cast(part).alias("out"))

    def state(acc, chunk, held, is_open, added) -> Column:
        return F.struct(chunk.alias("chunk"), held.alias("held"), is_open.alias("open"), (acc["at"] + 1).alias("at"), F.concat(acc["out"], added.cast(part)).alias("out"))

    def piece(chunk, group, first, n) -> Column:
        return F.struct(chunk.alias("chunk"), group.alias("group"), first.alias("first"), n.alias("n"))

    def step(acc: Column, size: Column) -> Column:
        fits = acc["open"] & (acc["held"] + size <= budget)
        chunk = acc["chunk"] + F.when(fits, 0).otherwise(1)
        whole = state(acc, chunk, F.when(fits, acc["held"] + size).otherwise(size), F.lit(True), F.array(piece(chunk, acc["at"], F.lit(0), size)))
        slices = F.transform(F.sequence(F.lit(0), F.floor((size - 1) / budget).cast("int")), lambda k: piece(acc["chunk"] + 1 + k, acc["at"], k * budget, F.least(F.lit(budget), size - k * budget)))
        cut = state(acc, acc["chunk"] + F.ceil(size / budget).cast("int"), F.lit(0), F.lit(False), slices)
        return F.when(size <= budget, whole).otherwise(cut)

    return F.aggregate(sizes, start, step, lambda acc: acc["out"])
