"""Per-pair features and their statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitloom import config
from bitloom.functions import text as tx
from bitloom.operators.quantiles import (
    moments_of_counts, pivot_quantiles, quantiles_of_counts, value_counts)

NUMERIC = [
    "source_length_chars", "source_length_words", "target_length_chars", "target_length_words",
    "length_ratio", "num_placeholders", "num_technical_terms",
    "lexical_diversity_source", "lexical_diversity_target",
]
NAMES = [
    "sample_id", "source_length_chars", "source_length_words", "source_length_tokens", "source_avg_word_length",
    "target_length_chars", "target_length_words", "target_length_tokens", "target_avg_word_length", "length_ratio",
    "num_placeholders", "placeholder_types", "num_technical_terms", "technical_terms", "has_brand_names",
    "source_unique_words", "target_unique_words", "lexical_diversity_source", "lexical_diversity_target",
    "has_urls", "has_numbers", "has_special_punctuation",
]
FLAGS = {
    "samples_with_placeholders": "num_placeholders > 0",
    "samples_with_tech_terms": "num_technical_terms > 0",
    "samples_with_brands": "has_brand_names",
    "samples_with_urls": "has_urls",
    "samples_with_numbers": "has_numbers",
}


def extract_features(df: DataFrame, count_tokens=None, word_boundary: bool = False) -> DataFrame:
    """The 22 features per pair. ``count_tokens`` is an optional Column function text -> int."""
    source, target = F.col("source"), F.coalesce("target", F.lit(""))
    shared = df.select(
        "sample_id", source.alias("source"), target.alias("target"),
        tx.words(source).alias("_s"), tx.words(target).alias("_t"),
        tx.placeholders(source).alias("_p"),
        tx.contained_terms(source, config.FEATURE_TERMS, lower=True, word_boundary=word_boundary)
        .alias("technical_terms"),
    )
    source, target = F.col("source"), F.col("target")
    n = {"source": F.size("_s"), "target": F.size("_t")}
    words = {"source": F.col("_s"), "target": F.col("_t")}
    unique = {c: F.size(F.array_distinct(F.transform(words[c], F.lower))) for c in words}
    mean = {c: tx.guarded_ratio(F.char_length(F.array_join(words[c], "")), n[c], 0.0) for c in words}
    tokens = count_tokens or (lambda _: F.lit(None).cast("int"))
    counted = shared.withColumns({f"{c}_unique_words": unique[c] for c in words})
    return counted.select(
        "sample_id",
        F.char_length(source).alias("source_length_chars"),
        n["source"].alias("source_length_words"),
        tokens(source).alias("source_length_tokens"),
        mean["source"].alias("source_avg_word_length"),
        F.char_length(target).alias("target_length_chars"),
        n["target"].alias("target_length_words"),
        F.when(target != "", tokens(target)).alias("target_length_tokens"),
        mean["target"].alias("target_avg_word_length"),
        tx.guarded_ratio(n["target"], n["source"], 1.0).alias("length_ratio"),
        F.size("_p").alias("num_placeholders"),
        tx.sorted_set(F.col("_p")).alias("placeholder_types"),
        F.size("technical_terms").alias("num_technical_terms"),
        "technical_terms",
        tx.contains_any(source, config.FEATURE_BRANDS).alias("has_brand_names"),
        "source_unique_words",
        "target_unique_words",
        tx.guarded_ratio(F.col("source_unique_words"), n["source"], 0.0)
        .alias("lexical_diversity_source"),
        tx.guarded_ratio(F.col("target_unique_words"), n["target"], 0.0)
        .alias("lexical_diversity_target"),
        source.rlike("https?://").alias("has_urls"),
        source.rlike(r"\p{Nd}").alias("has_numbers"),
        source.rlike("[™®©*#]").alias("has_special_punctuation"),
    )


def flatten_lists(features: DataFrame) -> DataFrame:
    """List columns as comma-joined strings for tabular export."""
    return features.withColumns({
        c: F.concat_ws(",", F.coalesce(c, tx.strings([]))) for c in ("placeholder_types", "technical_terms")
    })


def describe_features(features: DataFrame, columns: list[str] = NUMERIC) -> DataFrame:
    """count, mean, sample std, min, quartiles and max per numeric feature."""
    # one pass over the features; everything else works on the counted values
    counts = value_counts(features, columns)
    names = {0.25: "p25", 0.5: "p50", 0.75: "p75"}
    quartiles = pivot_quantiles(quantiles_of_counts(counts, list(names)), names)
    return moments_of_counts(counts).join(F.broadcast(quartiles), "metric").select(
        "metric", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def flag_counts(features: DataFrame) -> DataFrame:
    """How many samples show each feature."""
    return features.agg(*[F.count_if(F.expr(test)).alias(name) for name, test in FLAGS.items()])
