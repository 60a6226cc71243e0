"""Writers."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bitloom import schemas
from bitloom.sources.records import read_quoted_table


def save_samples(df: DataFrame, path: str, fmt: str = "jsonl", mode: str = "overwrite") -> None:
    """jsonl or json (both one object per line, so readers can split files) or tsv (source, target)."""
    if fmt in ("jsonl", "json"):
        df.select(*[c for c in ("source", "target", "domain", "sample_id") if c in df.columns]) \
            .write.mode(mode).option("ignoreNullFields", False).json(path)
    elif fmt == "tsv":
        df.select("source", "target").write.mode(mode).options(sep="\t", escape='"').csv(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")


def save_json_array(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON array per file, an object per line."""
    def framed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = True
        for batch in batches:
            rows = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([("[" if first and not i else ",") + r for i, r in enumerate(rows)],
                                                       pa.string())], names=["value"])
            first = first and not rows
        yield pa.RecordBatch.from_arrays([pa.array(["[]" if first else "]"])], names=["value"])

    rows = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))
    rows.mapInArrow(framed, "value string").write.mode(mode).text(path)


def read_tsv(spark: SparkSession, path: str, **options) -> DataFrame:
    """Quoted source and target; splits are read in parallel."""
    return read_quoted_table(spark, path, schemas.TSV_PAIR, "\t", **options)


def save_processed(df: DataFrame, base: str, name: str) -> None:
    """Named parquet set with the seven cached fields."""
    blank = {"metadata": F.create_map().cast("map<string,string>")}
    fields = [F.col(f.name) if f.name in df.columns else
              blank.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name)
              for f in schemas.CACHED_PAIR.fields]
    df.select(*fields).write.mode("overwrite").parquet(f"{base}/{name}")


def load_processed(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.schema(schemas.CACHED_PAIR).parquet(f"{base}/{name}")


def write_csv_report(df: DataFrame, path: str) -> None:
    """Report table as CSV with header; lists are joined by commas."""
    lists = {f.name for f in df.schema.fields if f.dataType.typeName() == "array"}
    flat = df.select(*[F.concat_ws(",", c).alias(c) if c in lists else F.col(c) for c in df.columns])
    flat.write.mode("overwrite").options(header=True, escape='"').csv(path)


def write_json_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
