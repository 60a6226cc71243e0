"""Feature sets on shared storage with a manifest of path, row count and content hash."""

from __future__ import annotations

import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bitloom.schemas import MANIFEST


_DIGITS = 15  # hexadecimal digits per sum: 60 bits


def canonical_row(df: DataFrame) -> Column:
    """A row as text: fields in the order of their names, floating point with nine decimals, nested ones
    as JSON, nulls told from every value."""
    def text(field) -> Column:
        value, kind = F.col(f"`{field.name}`"), field.dataType.typeName()
        if kind in ("double", "float"):
            value = value.cast("decimal(38,9)")
        elif kind in ("array", "map", "struct"):
            value = F.to_json(value)
        return F.coalesce(value.cast("string"), F.lit("\x1e"))
    return F.concat_ws("\x1f", *[text(f) for f in sorted(df.schema.fields, key=lambda f: f.name)])


def content_summary(df: DataFrame) -> DataFrame:
    """Row count and a hash that does not depend on row order or partitioning: the sums of two disjoint
    60-bit halves of the rows' MD5."""
    digest = F.md5(canonical_row(df).cast("binary"))
    halves = [F.conv(F.substring(digest, at, _DIGITS), 16, 10).cast("decimal(38,0)") for at in (1, 1 + _DIGITS)]
    rows = df.select(halves[0].alias("a"), halves[1].alias("b"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("decimal(38,0)").cast("string")
    return rows.agg(F.count(F.lit(1)).alias("count"), F.concat_ws(":", total("a"), total("b")).alias("content_hash"))


class FeatureStore:
    """Named parquet sets below one folder. Each version of a set has its own files and its own manifest
    entry, so writers never touch the files of a reader."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def _path(self, kind: str, name: str) -> str:
        if not re.fullmatch(r"[\w.-]+", name):
            raise ValueError(f"not a feature set name: {name!r}")
        return f"{self.base}/{kind}/{name}"

    def store(self, name: str, features: DataFrame) -> None:
        """Writes a new version, then switches the manifest entry to it. A reader finds the set as it was
        or as it is, never half of it; the version before stays until the next store."""
        version = uuid.uuid4().hex
        path = f"{self._path('sets', name)}/{version}"
        features.write.parquet(path)
        entry = content_summary(self.spark.read.schema(features.schema).parquet(path)).select(
            F.lit(name).alias("name"), F.lit(path).alias("path"), "count", "content_hash",
            F.current_timestamp().alias("stored_at"))
        # one small file per version; the latest one counts
        entry.coalesce(1).write.parquet(f"{self._path('manifest', name)}/{version}")

    def history(self) -> DataFrame:
        """One row per stored version."""
        return self.spark.read.schema(MANIFEST).parquet(f"{self.base}/manifest/*/*")

    def manifest(self) -> DataFrame:
        """The current version of every set."""
        latest = Window.partitionBy("name").orderBy(F.col("stored_at").desc(), "path")
        return (self.history().withColumn("_at", F.row_number().over(latest)).where("_at = 1")
                .drop("_at", "stored_at"))

    def load(self, name: str) -> DataFrame | None:
        """The set, or None when it is unknown or its files are gone."""
        try:
            entry = (self.spark.read.schema(MANIFEST).parquet(f"{self._path('manifest', name)}/*")
                     .orderBy(F.col("stored_at").desc(), "path").first())
            return self.spark.read.parquet(entry["path"]) if entry else None
        except AnalysisException:
            return None

    def verify(self, name: str) -> bool:
        """Whether the stored files still have the manifest's row count and hash."""
        rows = self.load(name)
        if rows is None:
            return False
        entry = self.manifest().where(F.col("name") == name).first()
        found = content_summary(rows).first()
        return (found["count"], found["content_hash"]) == (entry["count"], entry["content_hash"])
