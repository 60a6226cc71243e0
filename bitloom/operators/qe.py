"""Quality estimation of translations and its reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitloom import config
from bitloom.functions import quality as q

SCORES = ("comet_qe", "comet", "bert_f1")
NEEDS_EDIT_BELOW = 0.6


def _score(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("double")


def _estimated(df: DataFrame) -> DataFrame:
    """``estimate_quality`` and ``_words``, the lowered words of the translation: every text is split once."""
    scores = [_score(df, s) for s in SCORES]
    reference = F.col("reference") if "reference" in df.columns else None
    return df.withColumn("_words", q.lowered_words(F.col("translation"))).withColumns({
        "quality_class": q.quality_class(*scores),
        "error_types": q.error_types(F.col("source"), F.col("translation"), reference, F.col("_words")),
        "confidence": q.confidence(*scores),
    })


def estimate_quality(df: DataFrame) -> DataFrame:
    """Adds quality_class, error_types and confidence. Missing score columns count as null."""
    return _estimated(df).drop("_words")


def generate_feedback(df: DataFrame) -> DataFrame:
    """Quality estimate plus edit effort, category scores and suggestions per row.

    A chain of projections without Python or an exchange. A column ``edit_ratio`` (likeness of the
    translation to its post-edit), when present, decides the effort.
    """
    rated = _estimated(df)
    source, translation = F.col("source"), F.col("translation")
    ratio = F.col("edit_ratio") if "edit_ratio" in df.columns else None
    scored = rated.withColumns({
        "edit_effort": q.edit_effort(F.col("quality_class"), ratio),
        "_fluency": q.fluency(translation, F.col("_words")),
        "_accuracy": q.accuracy_score(_score(df, "comet_qe"), _score(df, "comet")),
        "_terms": q.terminology(source, translation),
        "_form": q.formatting(source, translation),
    })
    categorised = scored.drop("_words").withColumn("categories", q.categories(
        F.col("_fluency"), F.col("_accuracy"), F.col("error_types"), F.col("_terms"), F.col("_form")))
    advised = categorised.withColumn("suggestions", q.suggestions(
        F.col("quality_class"), F.col("error_types"), F.col("categories")))
    overall = (F.col("_fluency") + F.col("_accuracy") + F.col("_terms.score") + F.col("_form.score")) / 4
    return advised.withColumns({
        "overall_score": overall,
        "needs_post_edit": overall < NEEDS_EDIT_BELOW,
    }).drop("_fluency", "_accuracy", "_terms", "_form")


def error_distribution(df: DataFrame) -> DataFrame:
    """(error_type, n, pct): rows showing each error type, zero for types never seen."""
    total = F.count(F.lit(1)).alias("total")
    counts = [F.count_if(F.array_contains("error_types", e)).alias(e) for e in config.ERROR_TYPES]
    long = df.agg(total, *counts).unpivot("total", config.ERROR_TYPES, "error_type", "n")
    pct = F.when(F.col("total") > 0, 100.0 * F.col("n") / F.greatest("total", F.lit(1)))
    return long.select("error_type", "n", F.coalesce(pct, F.lit(0.0)).alias("pct"))


def error_ranking(df: DataFrame) -> DataFrame:
    """Error types that occur, most frequent first."""
    return error_distribution(df).where(F.col("n") > 0).orderBy(F.desc("n"), "error_type")


def score_summary(df: DataFrame, score: str = "overall_score") -> DataFrame:
    """Mean, population std, min, max and median of a score."""
    from bitloom.operators.quantiles import exact_quantiles

    median = exact_quantiles(df.select(score), [score], [0.5]).agg(F.max("quantile")).scalar()
    stats = df.agg(
        F.count(score).alias("num_samples"), F.avg(score).alias("mean_score"),
        F.stddev_pop(score).alias("std_score"), F.min(score).alias("min_score"),
        F.max(score).alias("max_score"))
    return stats.withColumn("median_score", median)


def score_buckets(df: DataFrame, score: str = "overall_score") -> DataFrame:
    """Counts per score band in one row."""
    s = F.col(score)
    return df.agg(
        F.count_if(s > 0.8).alias("excellent"),
        F.count_if((s >= 0.6) & (s <= 0.8)).alias("good"),
        F.count_if((s >= 0.4) & (s < 0.6)).alias("needs_review"),
        F.count_if(s < 0.4).alias("poor"))


def post_edit_share(df: DataFrame) -> DataFrame:
    return df.agg((100.0 * F.avg(F.col("needs_post_edit").cast("int"))).alias("requires_post_edit_pct"))


def post_edit_examples(df: DataFrame, k: int = 5) -> DataFrame:
    """The first k rows that need post-editing."""
    return df.where("needs_post_edit").orderBy("row_idx").limit(k)


def report_table(feedback: DataFrame) -> DataFrame:
    """Detailed result table for export."""
    worst = lambda sev: F.exists(F.map_values("categories"), lambda c: c["severity"] == sev)
    severity = F.when(worst("critical"), "critical").when(worst("major"), "major").otherwise("minor")
    return feedback.select(
        "source", F.col("translation").alias("hypothesis"), "reference",
        F.col("overall_score").alias("score"), F.array_join("suggestions", "; ").alias("feedback"),
        severity.alias("severity"), "edit_effort", F.col("needs_post_edit").alias("needs_pe"),
        "error_types")
