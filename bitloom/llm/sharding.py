"""Shards of equal size with the corpus's mixture: proportional stratified interleaving.

The rows of each stratum (a source) are shuffled by a seeded hash and ranked. A row's rank, shifted by a
hashed part of a row and divided by the stratum's rows, is its place between 0 and 1. All rows sorted by
this place are cut into shards whose row counts are at most one apart; every shard holds each stratum in
proportion, to within two rows of it.

No stratum is sorted in one task: hashes and places are dealt to ``PARTS`` equal ranges, the counts per
range give each range its first rank, and ranks are counted inside of a range only.

Null text has size 1 (no bytes). Rows whose stratum is null form a stratum. Rows that agree in all key
columns tie; the places they share are the same whichever comes first. An empty table gives an empty
table. Extra columns are carried; given columns called ``shard`` or ``slot`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bitloom.llm.common import stored, whole_text

SHARDS = 8
SEED = 1
PARTS = 8192
_BITS = 60


def _hash(*columns: Column) -> Column:
    """60 bits of the MD5 of the columns as text; null is told from every value."""
    text = F.concat_ws("\x1f", *[F.coalesce(c.cast("string"), F.lit("\x1e")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, _BITS // 4), 16, 10).cast("long")


def _first(counts: DataFrame, by: list[str], part: str) -> DataFrame:
    """Counts ``n`` per (by, part) with the number of rows in the parts before and in all parts."""
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    before = whole.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(*by, part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"),
                         F.sum("n").over(whole).alias("total"))


def places(docs: DataFrame, by: str, key: list[str], seed: int) -> DataFrame:
    """(row, mix, stratum, place): every row with its fractional rank inside its stratum."""
    rows = stored(docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.concat(F.lit("="), F.col(f"`{by}`").cast("string")), F.lit("")).alias("stratum"),
        _hash(F.lit(seed), *[F.col(f"`{k}`") for k in key]).alias("mix"),
    ).withColumn("part", (F.col("mix") / 2 ** _BITS * PARTS).cast("int")), "rows")
    starts = _first(rows.groupBy("stratum", "part").agg(F.count(F.lit(1)).alias("n")), ["stratum"], "part")
    order = Window.partitionBy("stratum", "part").orderBy("mix", *[F.col(f"row.`{k}`") for k in key])
    shift = _hash(F.lit(seed), F.col("stratum")) / 2 ** _BITS
    return (rows.withColumn("inside", F.row_number().over(order) - 1).join(starts, ["stratum", "part"])
            .select("row", "mix", "stratum",
                    ((F.col("first") + F.col("inside") + shift) / F.col("total")).alias("place")))


def interleaved(docs: DataFrame, shards: int = SHARDS, by: str = "source", key: tuple[str, ...] = ("doc_id",),
                seed: int = SEED) -> DataFrame:
    """All rows with ``shard`` from 0 and ``slot``, gapless from 0 inside of the shard.

    ``key`` names the columns that tell rows apart; they and the seed decide the shuffle.
    """
    placed = stored(places(docs, by, list(key), seed).withColumn(
        "range", F.least(F.floor(F.col("place") * PARTS), F.lit(PARTS - 1)).cast("int")), "placed")
    counts = placed.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("range").orderBy("place", "mix", "stratum", *[F.col(f"row.`{k}`") for k in key])
    kept = [F.col(f"row.`{c}`") for c in docs.columns if c.lower() not in ("shard", "slot")]
    return (placed.withColumn("inside", F.row_number().over(order) - 1)
            .join(F.broadcast(_first(counts, [], "range")), "range")  # at most PARTS rows
            .withColumn("at", F.col("first") + F.col("inside"))
            .withColumn("shard", F.expr(f"int(at * {shards} div total)"))
            .withColumn("slot", F.expr(f"at - (shard * total + {shards - 1}) div {shards}"))
            .select(*kept, "shard", "slot"))


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """One folder of Parquet files per shard, rows in the order of their slots inside of each file."""
    placed = interleaved(docs, **options)
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed.repartitionByRange(width, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard").parquet(path)


def report(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Placement of every document; only sizes and checksums move, not texts."""
    raw = whole_text().cast("binary")
    rows = docs.select("doc_id", "source", (F.octet_length(raw) + 1).cast("long").alias("size"),
                       F.crc32(raw).alias("text_crc32"))
    return interleaved(rows, shards, key=("doc_id", "text_crc32")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source")
