"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitloom.session import work_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written once below the shared checkpoint folder and read again.

    Cuts the lineage, so a lost executor costs one stage, and keeps several readers from computing the
    rows twice.
    """
    path = f"{work_dir(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(name: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(name), F.lit(""))


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def salts(df: DataFrame) -> int:
    """Number of parts a hot group is dealt to: follows the session's shuffle width."""
    return max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def unused(df: DataFrame, name: str) -> str:
    """The name, lengthened until no column of the frame has it."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def join_dealt(rows: DataFrame, side: DataFrame, key: str, spread: str) -> DataFrame:
    """Inner join with a side of at most one row per key; the rows of a hot key are dealt to salts.

    ``spread`` names a column that differs among the rows of a key. The side meets each key once per salt
    that occurs, so a key with few rows is not repeated more often than it has rows.
    """
    salt = unused(rows, "salt")
    dealt = rows.withColumn(salt, F.pmod(F.hash(spread), F.lit(salts(rows))))
    wanted = dealt.select(key, salt).distinct().join(side, key)
    return dealt.join(wanted, [key, salt]).drop(salt)
