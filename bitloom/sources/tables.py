"""Tabular and JSON sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bitloom import schemas
from bitloom.operators.filters import clean_pairs
from bitloom.sources.records import read_array_objects, read_quoted_table

# Default column names and name parts of the column search.
SOURCE_COLUMN, TARGET_COLUMN = "English Source", "Reference Translation"
SOURCE_HINTS, TARGET_HINTS = ("english", "source"), ("dutch", "reference", "translation")


def pairs_from_columns(df: DataFrame, source_col: str = SOURCE_COLUMN, target_col: str = TARGET_COLUMN,
                       row_idx: str = "row_idx", prefix: str = "challenge_") -> DataFrame:
    """Cleaned pairs from two named columns and a row number column."""
    absent = {source_col, target_col, row_idx} - set(df.columns)
    if absent:
        raise ValueError(f"required columns not found: {sorted(absent)}; available: {df.columns}")
    named = df.select(
        F.concat(F.lit(prefix), F.col(f"`{row_idx}`").cast("string")).alias("sample_id"),
        F.col(f"`{row_idx}`").cast("long").alias("row_idx"),
        F.col(f"`{source_col}`").alias("source"), F.col(f"`{target_col}`").alias("target"),
        F.lit("en").alias("source_lang"), F.lit("nl").alias("target_lang"),
        F.lit("software").alias("domain"),
        F.create_map(F.lit("row_index"), F.col(f"`{row_idx}`").cast("string")).alias("metadata"))
    return clean_pairs(named)


def resolve_columns(columns: list[str]) -> tuple[str, str]:
    """Source and target column by name parts; a later match wins, else the first two columns."""
    source = target = None
    for name in columns:
        lowered = name.lower()
        if any(h in lowered for h in SOURCE_HINTS):
            source = name
        elif any(h in lowered for h in TARGET_HINTS):
            target = name
    if source is None or target is None:
        source, target = columns[0], columns[1]
    return source, target


def pairs_from_table(df: DataFrame, row_idx: str = "row_idx", prefix: str = "test_") -> DataFrame:
    """Cleaned pairs from a table whose text columns are found by name."""
    source, target = resolve_columns([c for c in df.columns if c != row_idx])
    return pairs_from_columns(df, source, target, row_idx, prefix)


def read_jsonl(spark: SparkSession, path: str, schema=schemas.PROCESSED_PAIR) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_json_array(spark: SparkSession, path: str, schema=schemas.CACHED_PAIR, **options) -> DataFrame:
    """A JSON array per file, read by as many tasks as the file has splits; absent metadata becomes an
    empty map."""
    rows = read_array_objects(spark, path, schema, **options)
    if "metadata" not in rows.columns:
        return rows
    return rows.withColumn("metadata", F.coalesce("metadata", F.create_map().cast("map<string,string>")))


def read_translations(spark: SparkSession, path: str, sep: str = ",", **options) -> DataFrame:
    """CSV (or TSV) with header: source, reference, hypothesis. Splits are read in parallel."""
    return read_quoted_table(spark, path, schemas.TRANSLATIONS, sep, header=True, **options)


def align_benchmark(source: DataFrame, target: DataFrame, key: str = "id", text: str = "sentence",
                    prefix: str = "flores_") -> DataFrame:
    """Two monolingual benchmark tables joined on the sentence id."""
    a = source.select(F.col(key).alias("row_idx"), F.col(text).alias("source"))
    b = target.select(F.col(key).alias("row_idx"), F.col(text).alias("target"))
    return _benchmark_rows(a.join(b, "row_idx"), prefix)


def pivoted_benchmark(df: DataFrame, source_col: str, target_col: str, key: str = "id",
                      prefix: str = "flores_") -> DataFrame:
    """One benchmark table that holds both languages."""
    rows = df.select(F.col(key).alias("row_idx"), F.col(source_col).alias("source"),
                     F.col(target_col).alias("target"))
    return _benchmark_rows(rows, prefix)


def _benchmark_rows(rows: DataFrame, prefix: str) -> DataFrame:
    return rows.select(
        F.concat(F.lit(prefix), F.col("row_idx").cast("string")).alias("sample_id"), "row_idx",
        F.coalesce("source", F.lit("")).alias("source"), F.coalesce("target", F.lit("")).alias("target"),
        F.lit("en").alias("source_lang"), F.lit("nl").alias("target_lang"),
        F.lit("general").alias("domain"))
