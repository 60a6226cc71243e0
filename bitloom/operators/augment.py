"""Placeholder-swap augmentation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitloom import config
from bitloom.functions import text as tx

_HOLD = "__TEMP__"


def _swap(text: Column, a: Column, b: Column) -> Column:
    return F.replace(F.replace(F.replace(text, a, F.lit(_HOLD)), b, a), F.lit(_HOLD), b)


def _pair(source: Column, target: Column) -> Column:
    return F.struct(source.alias("source"), target.alias("target"))


def placeholder_variations(source: Column, target: Column, n_variations: int = 3) -> Column:
    """Array of (source, target): the original, then one swap per neighbouring numbered pair.

    Pairs already in the list are skipped; at most ``n_variations`` are added.
    """
    def build(marks: Column) -> Column:
        neighbours = F.greatest(F.size(marks) - 1, F.lit(0))
        both = F.arrays_zip(F.slice(marks, F.lit(1), neighbours).alias("a"),
                            F.slice(marks, F.lit(2), neighbours).alias("b"))
        swapped = F.transform(both, lambda m: _pair(_swap(source, m["a"], m["b"]),
                                                    _swap(target, m["a"], m["b"])))
        return F.concat(F.array(_pair(source, target)), swapped)

    marks = tx.matches(source, config.NUMBERED_PLACEHOLDER)
    return F.slice(F.array_distinct(tx.let(marks, build)), 1, n_variations + 1)


def augment_pairs(df: DataFrame, n_variations: int = 3) -> DataFrame:
    """Explodes every pair into its variations; ``variation`` 0 is the original."""
    rest = [c for c in df.columns if c not in ("source", "target")]
    out = df.select(*rest, F.posexplode(
        placeholder_variations(F.col("source"), F.col("target"), n_variations)).alias("variation", "v"))
    return out.select(*rest, "variation", "v.source", "v.target")
