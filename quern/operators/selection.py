"""Headword selection by token frequency."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Which headwords of a language are taken, as runs record it."""

    lang: str
    version: str
    min_zipf: float
    phrase_min_zipf: float | None = None

    def metadata(self) -> dict:
        return asdict(self) | {"method": "token_frequency", "phrases": "own bar" if self.phrase_min_zipf is not None else "same bar"}

    def apply(self, heads: DataFrame, frequencies: DataFrame) -> DataFrame:
        """(lang_code, normalized_word) of the heads taken, for curate()."""
        own = heads.filter(F.col("lang_code") == self.lang).select("lang_code", "normalized_word").distinct()
        return selected(own, frequencies, self.min_zipf, self.phrase_min_zipf, "normalized_word").select("lang_code", "normalized_word")


def threshold(frequencies: DataFrame, top_n: int, token: str = "token", score: str = "zipf") -> float:
    """The frequency of the top_n-th token."""
    if top_n <= 0:
        raise ValueError("top_n must be positive")
    found = frequencies.orderBy(F.desc(score), token).limit(top_n).agg(F.count(F.lit(1)), F.min(score)).first()
    if found[0] < top_n:
        raise ValueError(f"only {found[0]} tokens, {top_n} wanted")
    return float(found[1])


def tokens_of(word: Column) -> Column:
    return F.filter(F.split(F.lower(word), r"\s+"), lambda t: t != "")


def scored(words: DataFrame, frequencies: DataFrame, word: str = "word", token: str = "token", score: str = "zipf") -> DataFrame:
    """Words with `n_tokens` and `score`. A phrase of tokens with frequencies f scores 1 / sum(1 / f), on the logarithmic
    scale again; an unknown token makes it 0. This stands in for a phrase model that needs data which is not at hand."""
    each = words.select(F.col(word).alias("__w")).distinct().select("__w", F.explode(tokens_of(F.col("__w"))).alias(token))
    rates = each.join(frequencies.select(token, F.col(score).alias("__z")), token, "left")
    rates = rates.groupBy("__w").agg(F.count(F.lit(1)).alias("n_tokens"), F.count_if(F.col("__z").isNull()).alias("__none"), F.sum(F.pow(F.lit(10.0), -F.col("__z"))).alias("__inverse"))
    value = F.when(F.col("__none") > 0, F.lit(0.0)).otherwise(F.round(-F.log10("__inverse"), 6))
    rates = rates.select("__w", "n_tokens", value.alias("score"))
    return words.join(rates, words[word] == rates["__w"], "left").drop("__w").fillna({"n_tokens": 0, "score": 0.0})


def selected(words: DataFrame, frequencies: DataFrame, min_zipf: float, phrase_min_zipf: float | None = None, word: str = "word") -> DataFrame:
    """Words that are frequent enough; phrases have a bar of their own, if one is given."""
    bar = F.when((F.col("n_tokens") > 1) & F.lit(phrase_min_zipf is not None), F.lit(phrase_min_zipf or 0.0)).otherwise(F.lit(min_zipf))
    out = scored(words, frequencies, word)
    return out.filter((F.col("n_tokens") > 0) & (F.col("score") >= bar))
