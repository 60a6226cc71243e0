"""Preprocessing of pair tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitloom import config
from bitloom.functions import protect


def preprocess_pairs(df: DataFrame,
                     cfg: config.PreprocessConfig = config.PreprocessConfig()) -> DataFrame:
    """Preprocess both sides; the originals move to the metadata map."""
    originals = F.create_map(F.lit("original_source"), F.col("source"),
                             F.lit("original_target"), F.col("target"))
    metadata = originals
    if "metadata" in df.columns:
        fresh = F.map_filter(F.coalesce("metadata", F.create_map().cast("map<string,string>")),
                             lambda k, _: ~k.isin("original_source", "original_target"))
        metadata = F.map_concat(fresh, originals)
    return df.withColumns({
        "metadata": metadata,
        "source": protect.preprocess(F.col("source"), cfg)["text"],
        "target": protect.preprocess(F.col("target"), cfg)["text"],
    })
