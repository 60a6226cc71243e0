"""Pair filters, id assignment and projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitloom import config
from bitloom.functions import text as tx


def clean_pairs(df: DataFrame, source: str = "source", target: str = "target") -> DataFrame:
    """Nulls become empty, both sides are stripped, pairs with an empty side are dropped."""
    side = lambda c: tx.strip(F.coalesce(F.col(c).cast("string"), F.lit("")))
    trimmed = df.withColumns({source: side(source), target: side(target)})
    return trimmed.where((F.col(source) != "") & (F.col(target) != ""))


def reject_reason(source: Column, target: Column,
                  bounds: config.LengthBounds = config.LengthBounds()) -> Column:
    """Why a pair is rejected (first test that fails), null when it is kept."""
    n_source, n_target = F.size(tx.words(source)), F.size(tx.words(target))
    ratio = n_target / n_source
    return (
        F.when((n_source == 0) | (n_target == 0), "empty")
        .when((n_source < bounds.min_words) | (n_target < bounds.min_words), "too_short")
        .when((n_source > bounds.max_words) | (n_target > bounds.max_words), "too_long")
        .when((ratio < bounds.min_ratio) | (ratio > bounds.max_ratio), "mismatch")
    )


def with_reject_reason(df: DataFrame, bounds: config.LengthBounds = config.LengthBounds()) -> DataFrame:
    return df.withColumn("reject_reason", reject_reason(F.col("source"), F.col("target"), bounds))


def kept(df: DataFrame) -> DataFrame:
    return df.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(df: DataFrame) -> DataFrame:
    return df.where(F.col("reject_reason").isNotNull())


def reject_counts(df: DataFrame) -> DataFrame:
    """One row per reason, zero where no pair was rejected for it."""
    counts = [F.count_if(F.col("reject_reason") == r).alias(r) for r in config.REJECT_REASONS]
    return df.agg(*counts).unpivot([], config.REJECT_REASONS, "reject_reason", "n")


def drop_identical(df: DataFrame) -> DataFrame:
    return df.where(F.col("source") != F.col("target"))


def with_sample_id(df: DataFrame, prefix: str) -> DataFrame:
    return df.withColumn("sample_id", F.concat(F.lit(prefix), F.col("row_idx").cast("string")))


def fill_defaults(df: DataFrame) -> DataFrame:
    """Missing texts become empty, a missing id becomes the row position."""
    return df.withColumns({
        "source": F.coalesce("source", F.lit("")),
        "target": F.coalesce("target", F.lit("")),
        "sample_id": F.coalesce("sample_id", F.col("row_idx").cast("string")),
    })


def pair_columns(df: DataFrame) -> DataFrame:
    """The six plain columns, without metadata."""
    return df.select("source", "target", "source_lang", "target_lang", "domain", "sample_id")


def union_sources(*frames: DataFrame) -> DataFrame:
    """All rows of all sources, duplicates kept; absent columns become null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
