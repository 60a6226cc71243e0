"""Preparation jobs: corpus filtering and splitting, and the featurise-and-split job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bitloom import config
from bitloom.operators import features, filters, prepare_text, ranks, split, stats
from bitloom.operators.store import FeatureStore
from bitloom.session import work_dir
from bitloom.sources import lines, sinks


@dataclass(frozen=True)
class CorpusJob:
    """Arguments of the aligned-corpus job."""

    source_path: str
    target_path: str
    output: str
    max_train_samples: int | None = None
    bounds: config.LengthBounds = config.CORPUS_SCRIPT_BOUNDS
    val_ratio: float = 0.05
    seed: int = 42


def stored(df: DataFrame) -> DataFrame:
    """Writes a frame to the shared work folder and reads it back, so later steps share one result
    that survives the loss of executors."""
    path = work_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def prepare_corpus(spark: SparkSession, job: CorpusJob, test: DataFrame | None = None) -> DataFrame:
    """Reads aligned files, filters, splits and writes train and val (and test) as jsonl and tsv.

    Returns the reject counts.
    """
    pairs = lines.read_aligned(spark, job.source_path, job.target_path, drop_empty=False)
    judged = stored(filters.with_reject_reason(pairs, job.bounds))
    train = filters.kept(judged)
    if job.max_train_samples:
        train = ranks.first_rows(train, job.max_train_samples)
    parts = split.split_exact(stored(train), {"val": job.val_ratio, "train": 1 - job.val_ratio}, job.seed)
    sets = {name: parts.where(F.col("split") == name) for name in ("train", "val")}
    if test is not None:
        sets["test"] = test
    for name, rows in sets.items():
        sinks.save_samples(rows, f"{job.output}/{name}.jsonl", "jsonl")
        sinks.save_samples(rows, f"{job.output}/{name}.tsv", "tsv")
    return filters.reject_counts(judged)


def summary(train: DataFrame, test: DataFrame, domain: str) -> DataFrame:
    """One row of counts and test statistics. ``train`` carries the ``split`` column."""
    sizes = train.agg(F.count_if(F.col("split") == "train").alias("total_samples"),
                      F.count_if(F.col("split") == "val").alias("val_samples"))
    lengths = stats.length_stats(test).drop("max_source_length", "max_target_length")
    vocab = stats.vocab_size(test)
    flags = features.flag_counts(features.extract_features(test)).select(
        "samples_with_placeholders", "samples_with_tech_terms")
    out = sizes.withColumn("domain", F.lit(domain))
    for name, part in (("_l", lengths), ("_v", vocab), ("_f", flags)):
        out = out.withColumn(name, part.select(F.struct("*")).scalar())
    return out.select("domain", "total_samples", "val_samples", F.col("_l.num_samples").alias("test_samples"),
                      "_l.avg_source_length", "_l.avg_target_length", "_v.*", "_f.*")


def prepare_dataset(spark: SparkSession, train: DataFrame, test: DataFrame, output: str,
                    domain: str = "software/IT",
                    cfg: config.PreprocessConfig = config.PreprocessConfig(), repeat_small: int = 0) -> DataFrame:
    """Preprocesses, featurises, splits and stores; returns the summary row. ``repeat_small`` as in
    ``split_head_tail``."""
    test = stored(test)
    processed = stored(prepare_text.preprocess_pairs(train, cfg))
    parts = split.split_head_tail(processed, repeat_small=repeat_small)
    for name in ("train", "val"):
        sinks.save_processed(parts.where(F.col("split") == name), output, name)
    sinks.save_processed(prepare_text.preprocess_pairs(test, cfg), output, "test")
    sinks.save_processed(test, output, "challenge_test")
    FeatureStore(spark, f"{output}/features").store("test_features", features.extract_features(test))
    out = summary(parts, test, domain)
    sinks.write_json_report(out, f"{output}/data_summary")
    return out
