"""Seed rows and the choice among training sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bitloom.operators.filters import union_sources
from bitloom.operators.ranks import first_rows
from bitloom.sources.lines import path_exists, read_aligned_folder
from bitloom.sources.po import parse_catalogues
from bitloom.sources.tables import read_json_array

# Small interface texts, English and Dutch.
SEED_PAIRS = [
    ("Open the menu", "Open het menu"), ("Close window", "Venster sluiten"),
    ("Save as {1}", "Opslaan als {1}"), ("Print page", "Pagina afdrukken"),
    ("Page {1} of {2}", "Pagina {1} van {2}"), ("Choose a language", "Kies een taal"),
    ("Send message", "Bericht verzenden"), ("New folder", "Nieuwe map"),
    ("Copy link", "Link kopiëren"), ("Sign in", "Aanmelden"), ("Sign out", "Afmelden"),
    ("Search results", "Zoekresultaten"), ("No results found", "Geen resultaten gevonden"),
    ("Hello, {name}", "Hallo {name}"), ("Free up space", "Ruimte vrijmaken"),
    ("Dark theme", "Donker thema"), ("Take a photo", "Foto maken"),
    ("Share with {1}", "Delen met {1}"), ("Show more", "Meer weergeven"), ("Go back", "Ga terug"),
]


def seed_pairs(spark: SparkSession, rows: list[tuple[str, str]] = SEED_PAIRS,
               domain: str = "software") -> DataFrame:
    numbered = [(f"synthetic_{i}", i, s, t, domain) for i, (s, t) in enumerate(rows)]
    return spark.createDataFrame(
        numbered, "sample_id string, row_idx long, source string, target string, domain string")


def add_seeds_if_few(df: DataFrame, seeds: DataFrame, minimum: int) -> DataFrame:
    """Appends the seed rows when the table holds fewer than ``minimum`` rows."""
    if df.limit(minimum).count() >= minimum:
        return df
    return union_sources(df, seeds)


def load_training(spark: SparkSession, folder: str, processed: str | None = None,
                  max_samples: int | None = None) -> DataFrame:
    """A processed file wins; else catalogues plus aligned text; seed rows if there is nothing."""
    if processed and path_exists(spark, processed):
        rows = read_json_array(spark, processed)
        return first_rows(rows, max_samples) if max_samples and "row_idx" in rows.columns else (
            rows.orderBy("sample_id").limit(max_samples) if max_samples else rows)
    parts = []
    if path_exists(spark, folder):
        catalogues = parse_catalogues(spark, folder)
        parts += [catalogues.withColumn("_source", F.lit(0))] if not catalogues.isEmpty() else []
        aligned = read_aligned_folder(spark, folder)
        parts += [aligned.withColumn("_source", F.lit(1))] if aligned is not None else []
    if not parts:
        return seed_pairs(spark)
    rows = union_sources(*parts)
    if max_samples:
        place = F.col("_source") * (1 << 40) + F.col("row_idx")
        rows = first_rows(rows.withColumn("_place", place), max_samples, "_place", "sample_id")
    return rows.drop("_source", "_place")


