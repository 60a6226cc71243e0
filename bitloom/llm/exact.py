"""Exact duplicates: frequent digests are removed before the shuffle, all others through it.

A Misra-Gries pass finds the digests that may be frequent, a second pass counts those exactly, and the
verified winners (at most ``counters`` rows) are broadcast. Every other digest has at most
``2 n / (counters + 1)`` rows, so the shuffle has no hot key.

Null text counts as empty. Rows without an id lose against rows with one. Rows that repeat an id and a
text are one document to ``report``; ``deduplicated`` keeps one of them. Texts are hashed whole, however
long. An empty table gives an empty table. Extra columns come back as given, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bitloom.llm.common import stored, unused, whole_text

COUNTERS = 1000


def digest(text: str = "text"):
    """SHA-256 of the text's UTF-8 bytes, 32 bytes."""
    return F.unhex(F.sha2(whole_text(text).cast("binary"), 256))


def _summary(counters: int):
    """Misra-Gries over Arrow batches: adds a batch's counts, then takes the (k+1)-th largest off all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        for batch in batches:
            found = pc.value_counts(batch.column(0))
            for key, n in zip(found.field(0).to_pylist(), found.field(1).to_pylist()):
                seen[key] = seen.get(key, 0) + n
            if len(seen) > counters:
                cut = sorted(seen.values(), reverse=True)[counters]
                seen = {k: n - cut for k, n in seen.items() if n > cut}
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())],
                names=["digest", "seen"])
    return run


def heavy_winners(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(digest, keep_id, group_size) of the frequent digests, exact, at most ``counters`` rows.

    The partial summaries add up to at most n, so at most ``counters`` digests exceed n / (counters + 1);
    each one misses at most that share, so every digest above twice the share is among them.
    """
    n = digests.count()
    partial = digests.select("digest").mapInArrow(_summary(counters), "digest binary, seen long")
    frequent = (partial.groupBy("digest").agg(F.sum("seen").alias("seen"))
                .where(F.col("seen") > n / (counters + 1)).select("digest"))
    # at most `counters` rows of 32 bytes
    likely = digests.sparkSession.createDataFrame(frequent.collect(), "digest binary")
    exact = (digests.join(F.broadcast(likely), "digest").groupBy("digest")
             .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
             .where("group_size > 1"))
    schema = f"digest binary, keep_id {digests.schema['doc_id'].dataType.simpleString()}, group_size long"
    return digests.sparkSession.createDataFrame(exact.collect(), schema)


def report(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """One row per document: the id that stays for its text, the size of the group, whether it stays."""
    digests = stored(docs.select("doc_id", digest().alias("digest")), "digests")
    winners = F.broadcast(heavy_winners(digests, counters))
    rest = digests.join(winners, "digest", "left_anti")
    groups = (rest.groupBy("digest")
              .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
              .where("group_size > 1"))
    single = {"keep_id": F.coalesce("keep_id", "doc_id"),
              "group_size": F.coalesce("group_size", F.lit(1).cast("long"))}
    rows = digests.join(winners, "digest").unionByName(
        rest.join(groups, "digest", "left").withColumns(single))
    return rows.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                       F.lower(F.hex("digest")).alias("text_sha256"))


def deduplicated(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The documents with the largest id of each text, all columns as given."""
    digests = stored(docs.select("doc_id", digest().alias("digest")), "digests")
    key, keep, rank = (unused(docs, n) for n in ("digest", "keep_id", "rank"))
    winners = heavy_winners(digests, counters).select(F.col("digest").alias(key), F.col("keep_id").alias(keep))
    left = (docs.withColumn(key, digest()).join(F.broadcast(winners), key, "left")
            .where(F.col(keep).isNull() | (F.col("doc_id") == F.col(keep))))
    first = Window.partitionBy(key).orderBy(F.col("doc_id").desc_nulls_last())
    return (left.withColumn(rank, F.row_number().over(first)).where(F.col(rank) == 1)
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
