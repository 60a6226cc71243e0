"""Dataset statistics over pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitloom import config
from bitloom.functions import text as tx


def length_stats(df: DataFrame) -> DataFrame:
    """Row count, mean and largest word count per side; zeros on an empty table."""
    counted = df.select(F.size(tx.words(F.col("source"))).alias("s"),
                        F.size(tx.words(F.col("target"))).alias("t"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return counted.agg(
        F.count(F.lit(1)).alias("num_samples"),
        zero(F.avg("s")).alias("avg_source_length"), zero(F.avg("t")).alias("avg_target_length"),
        zero(F.max("s")).alias("max_source_length"), zero(F.max("t")).alias("max_target_length"))


def distinct_words(df: DataFrame) -> DataFrame:
    """(side, word) for every distinct lower-cased word; repeats collapse before the exchange."""
    side = lambda name: F.struct(
        F.lit(name).alias("side"), F.array_distinct(tx.words(F.lower(F.col(name)))).alias("words"))
    return (df.select(F.inline(F.array(side("source"), side("target"))))
            .select("side", F.explode("words").alias("word")).distinct())


def vocab_size(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct lower-cased words per side in one row."""
    pick = lambda s: F.when(F.col("side") == s, F.col("word"))
    if approximate:
        side = lambda name: F.struct(F.lit(name).alias("side"),
                                     tx.words(F.lower(F.col(name))).alias("words"))
        words = df.select(F.inline(F.array(side("source"), side("target"))))
        words = words.select("side", F.explode("words").alias("word"))
        size = lambda s: F.approx_count_distinct(pick(s))
    else:
        words, size = distinct_words(df), lambda s: F.count(pick(s))
    return words.agg(size("source").alias("vocab_size_source"), size("target").alias("vocab_size_target"))


def placeholder_inventory(df: DataFrame) -> DataFrame:
    """Distinct source placeholders with the number of their occurrences."""
    found = df.select(F.explode(tx.placeholders(F.col("source"))).alias("pattern"))
    return found.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))


def domain_terms(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Distinct lower-cased source words that contain a domain stem; with ``limit`` the first ones in text order."""
    found = df.select(F.explode(F.array_distinct(tx.words(F.lower(F.col("source"))))).alias("word"))
    hit = tx.contains_any(F.col("word"), config.DOMAIN_STEMS)
    terms = found.where(hit).distinct()
    return terms.orderBy("word").limit(limit) if limit else terms


def _tagged(kind: str, values) -> F.Column:
    return F.struct(F.lit(kind).alias("kind"), values.alias("values"))


def dataset_stats(df: DataFrame) -> DataFrame:
    """All statistics of a pair table in one row, from one scan.

    Every row gives tagged values: its distinct words per side, its distinct placeholders and its two
    word counts (as one value). Equal (kind, value) are counted in one aggregation, and everything else
    follows from these counts.
    """
    sides = df.select(
        tx.words(F.col("source")).alias("s"), tx.words(F.col("target")).alias("t"),
        tx.words(F.lower(F.col("source"))).alias("sl"), tx.words(F.lower(F.col("target"))).alias("tl"),
        tx.placeholders(F.col("source")).alias("p"))
    size = F.concat_ws(" ", *[F.coalesce(F.size(c), F.lit(-1)).cast("string") for c in "st"])  # -1: no text
    tagged = sides.select(F.inline(F.array(
        _tagged("source", F.array_distinct("sl")), _tagged("target", F.array_distinct("tl")),
        _tagged("pattern", F.array_distinct("p")), _tagged("sizes", F.array(size)))))
    counts = tagged.select("kind", F.explode("values").alias("value")).groupBy("kind", "value").agg(
        F.count(F.lit(1)).alias("n"))
    of = lambda kind: F.col("kind") == kind
    side = {c: F.when(of("sizes"), F.nullif(F.split("value", " ")[i].cast("long"), F.lit(-1)))
            for i, c in enumerate(("source", "target"))}
    rows = F.sum(F.when(of("sizes"), F.col("n")))
    zero = lambda c: F.coalesce(c, F.lit(0))
    mean = lambda c: zero(F.sum(side[c] * F.col("n")) / F.sum(F.when(side[c].isNotNull(), F.col("n"))))
    term = F.when(of("source") & tx.contains_any(F.col("value"), config.DOMAIN_STEMS), F.col("value"))
    return counts.agg(
        zero(rows).alias("num_samples"),
        mean("source").alias("avg_source_length"), mean("target").alias("avg_target_length"),
        zero(F.max(side["source"])).cast("int").alias("max_source_length"),
        zero(F.max(side["target"])).cast("int").alias("max_target_length"),
        F.count_if(of("source")).alias("vocab_size_source"), F.count_if(of("target")).alias("vocab_size_target"),
        F.count_if(of("pattern")).alias("unique_patterns"), F.sort_array(F.collect_list(term)).alias("domain_terms"))
