"""Alignment checks and model comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

METRICS = ["bleu", "chrf_pp", "ter", "comet", "bert_score", "aggregate_score"]


def alignment_report(hypotheses: DataFrame, references: DataFrame, key: str = "sample_id") -> DataFrame:
    """One row: matched keys and keys missing on either side."""
    h = hypotheses.select(key, F.lit(True).alias("_h"))
    r = references.select(key, F.lit(True).alias("_r"))
    both = h.join(r, key, "full_outer")
    return both.agg(
        F.count_if(F.col("_h") & F.col("_r")).alias("matched"),
        F.count_if(F.col("_r").isNull()).alias("without_reference"),
        F.count_if(F.col("_h").isNull()).alias("without_hypothesis"))


def align(hypotheses: DataFrame, references: DataFrame, key: str = "sample_id") -> DataFrame:
    """Inner join on the key; fails at run time when a row has no partner."""
    both = hypotheses.withColumn("_h", F.lit(True)).join(
        references.withColumn("_r", F.lit(True)), key, "full_outer")
    check = F.when(F.col("_h").isNull() | F.col("_r").isNull(),
                   F.raise_error(F.concat(F.lit("unmatched row "), F.col(key)))).otherwise(F.col(key))
    return both.withColumn(key, check).drop("_h", "_r")


def unpivot_metrics(results: DataFrame, model: str = "model", order: str = "model_order") -> DataFrame:
    present = [m for m in METRICS if m in results.columns]
    typed = results.select(model, order, *[F.col(m).cast("double").alias(m) for m in present])
    return typed.unpivot([model, order], present, "metric", "score").where(F.col("score").isNotNull())


def best_models(results: DataFrame, model: str = "model", order: str = "model_order") -> DataFrame:
    """(metric, best_model, score): highest score, lowest for TER; the first model wins ties."""
    goodness = F.when(F.col("metric") == "ter", -F.col("score")).otherwise(F.col("score"))
    first = Window.partitionBy("metric").orderBy(goodness.desc(), F.col(order))
    ranked = unpivot_metrics(results, model, order).withColumn("_rn", F.row_number().over(first))
    return ranked.where(F.col("_rn") == 1).select("metric", F.col(model).alias("best_model"), "score")


def comparison_matrix(results: DataFrame, models: list[str], model: str = "model",
                      order: str = "model_order") -> DataFrame:
    """One row per metric, one score column per model."""
    long = unpivot_metrics(results, model, order)
    return long.groupBy("metric").pivot(model, models).agg(F.first("score"))
