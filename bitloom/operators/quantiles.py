"""Exact quantiles of many columns without gathering values in one task.

Equal values are counted first, so a value that fills a third of the table is one row from then on.
Sampled ranges of about equally many counted values tell where each wanted rank lies, and only the
values of those ranges are ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bitloom.session import work_dir


def stored(df: DataFrame) -> DataFrame:
    """The frame written once to the shared work folder and read again."""
    path = work_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(metric, value, n) for every distinct value of every column."""
    values = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
                       for c in columns])
    long = df.select(F.inline(values)).where(F.col("value").isNotNull())
    return long.groupBy("metric", "value").agg(F.count(F.lit(1)).alias("n"))


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float]) -> DataFrame:
    """(metric, prob, quantile) with linear interpolation between neighbouring ranks."""
    return quantiles_of_counts(value_counts(df, columns), probs)


def moments_of_counts(counts: DataFrame) -> DataFrame:
    """count, mean, sample std, min and max per metric, with the deviations taken from the mean."""
    value, n = F.col("value"), F.col("n")
    means = counts.groupBy("metric").agg(
        F.sum("n").alias("count"), (F.sum(value * n) / F.sum("n")).alias("mean"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    # one row per column on the broadcast side
    centred = counts.join(F.broadcast(means), "metric")
    square = F.sum(n * (value - F.col("mean")) * (value - F.col("mean")))
    std = F.when(F.col("count") > 1, F.sqrt(F.col("_square") / (F.col("count") - 1)))
    spread = centred.groupBy("metric", "count", "mean", "min", "max").agg(square.alias("_square"))
    return spread.select("metric", "count", "mean", std.alias("std"), "min", "max")


def ranked_values(counts: DataFrame, targets: Column) -> DataFrame:
    """(metric, target, value) of counted values (metric, value, n).

    ``targets`` is an array of structs over ``total`` (rows per metric), each with a field ``rank``: the
    value at that rank, from 0, is wanted. The counted values are dealt to ranges of about equally many
    of them; the sums of the ranges tell which ones hold a wanted rank, and only these are ranked, each
    for itself. So no task sees more than a range, however the values are spread.
    """
    parts = max(8, int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # written once: the ranges are sampled, and both uses have to see the same ones
    dealt = stored(counts.select("metric", "value", "n").repartitionByRange(parts, "metric", "value")
                   .withColumn("part", F.spark_partition_id()))
    sums = dealt.groupBy("metric", "part").agg(F.sum("n").alias("in_part"))
    of_metric = Window.partitionBy("metric")
    up_to = of_metric.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    wanted = (sums.withColumns({"before": F.sum("in_part").over(up_to) - F.col("in_part"),
                                "total": F.sum("in_part").over(of_metric)})
              .withColumn("target", F.explode(targets))
              .where((F.col("target.rank") >= F.col("before"))
                     & (F.col("target.rank") < F.col("before") + F.col("in_part")))
              .select("metric", "part", "before", "target"))
    inside = Window.partitionBy("metric", "part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (dealt.join(wanted.select("metric", "part", "before").distinct(), ["metric", "part"])
              .select("metric", "part", "value", "n", (F.col("before") + F.sum("n").over(inside) - F.col("n")).alias("first")))
    return (ranked.join(wanted.drop("before"), ["metric", "part"])
            .where((F.col("target.rank") >= F.col("first")) & (F.col("target.rank") < F.col("first") + F.col("n")))
            .select("metric", "target", "value"))


def quantiles_of_counts(counts: DataFrame, probs: list[float]) -> DataFrame:
    share = lambda p: F.lit(p) * (F.col("total") - 1)
    ends = [(F.floor(share(p)), F.ceil(share(p)), p) for p in probs]
    targets = F.array(*[F.struct(F.lit(p).alias("prob"), at.cast("long").alias("rank"), (share(p) - low).alias("over"))
                        for low, high, p in ends for at in (low, high)])
    low, high = F.min("value"), F.max("value")
    return ranked_values(counts, targets).groupBy("metric", F.col("target.prob").alias("prob")).agg(
        (low + (high - low) * F.max("target.over")).alias("quantile"))


def pivot_quantiles(quantiles: DataFrame, names: dict[float, str]) -> DataFrame:
    """One row per metric with a column per probability."""
    picked: list[Column] = [F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n)
                            for p, n in names.items()]
    return quantiles.groupBy("metric").agg(*picked)
