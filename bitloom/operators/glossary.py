"""Glossary lookup, membership, upsert and word-by-word fallback translation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bitloom import config
from bitloom.functions import text as tx

DEALS = 16


def glossary_frame(spark: SparkSession, entries: dict[str, str] = config.GLOSSARY_EN_NL) -> DataFrame:
    rows = [(k.lower(), v) for k, v in entries.items()]
    return spark.createDataFrame(rows, "term string, translation string")


def _spread_join(df: DataFrame, key: Column, side: DataFrame, how: str) -> DataFrame:
    """Join on ``term``; adaptive execution picks the join and splits a frequent word's partition."""
    return df.withColumn("term", key).join(side, "term", how)


def lookup(df: DataFrame, glossary: DataFrame, word: str = "word", spread: str | None = None) -> DataFrame:
    """Adds ``translation`` (null when absent), without regard to case.

    ``spread``, for a glossary too large to broadcast, names a column that differs among the rows of a word:
    by it they are dealt to DEALS keys, and the terms repeated for each. The terms are hashed then, no row sorted.
    """
    term = F.lower(F.col(word))
    if spread is None:
        return _spread_join(df, term, glossary, "left").drop("term")
    side = glossary.withColumn("term_deal", F.explode(F.sequence(F.lit(0), F.lit(DEALS - 1)))).hint("shuffle_hash")
    dealt = df.withColumn("term_deal", F.pmod(F.xxhash64(spread), F.lit(DEALS)).cast("int")).withColumn("term", term)
    return dealt.join(side, ["term", "term_deal"], "left").drop("term", "term_deal")


def known_words(df: DataFrame, glossary: DataFrame, word: str = "word") -> DataFrame:
    return _spread_join(df, F.lower(F.col(word)), glossary.select("term"), "left_semi").drop("term")


def unknown_words(df: DataFrame, glossary: DataFrame, word: str = "word") -> DataFrame:
    return _spread_join(df, F.lower(F.col(word)), glossary.select("term"), "left_anti").drop("term")


def word_occurrences(df: DataFrame, text: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per word with its position."""
    return df.select(*keys, F.posexplode(tx.words(F.col(text))).alias("pos", "word"))


def word_frequencies(df: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) of the lower-cased words, counted before the exchange."""
    found = df.select(F.explode(tx.words(F.lower(F.col(text)))).alias("word"))
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def upsert(glossary: DataFrame, new_terms: DataFrame, order: str | None = None) -> DataFrame:
    """New terms replace old ones with the same lower-cased key. Of several, the last by ``order`` wins,
    without one or among equals the greatest translation."""
    def folded(terms: DataFrame, *by: str) -> DataFrame:
        last = F.max_by("translation", F.struct(*by, "translation"))
        return terms.withColumn("term", F.lower("term")).groupBy("term").agg(last.alias("translation"))

    latest = folded(new_terms, *([order] if order else []))
    return folded(glossary).join(latest.select("term"), "term", "left_anti").unionByName(latest)


def fallback_translation(text: Column, entries: dict[str, str] = config.FALLBACK_WORDS) -> Column:
    """Known words replaced, the others kept, everything lower-cased and joined by spaces."""
    table = F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])
    translate = lambda w: F.coalesce(F.try_element_at(table, w), w)
    return F.array_join(F.transform(tx.words(F.lower(text)), translate), " ")
