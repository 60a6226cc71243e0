"""Quality gate on a stream of translations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bitloom.operators.qe import generate_feedback


def gated(df: DataFrame) -> DataFrame:
    """Feedback with the gate decision. Stateless, so it is the same for a batch and a stream."""
    rated = generate_feedback(df)
    bad = F.col("needs_post_edit") | (F.col("quality_class") == "poor")
    return rated.withColumn("accepted", ~bad)


def run_gate(stream: DataFrame, accepted: str, rejected: str, checkpoint: str,
             available_now: bool = True) -> StreamingQuery:
    """Writes accepted and rejected rows to two parquet folders.

    Every micro-batch owns a subfolder that a replay overwrites, so a restart adds no duplicates. Its rated
    rows are stored below the checkpoint meanwhile.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        # rated once and stored: a cache would give each task all texts of a file's part, unpacked
        stored = f"{checkpoint}/rated"
        batch.write.mode("overwrite").parquet(stored)
        rated = batch.sparkSession.read.schema(batch.schema).parquet(stored)
        for path, test in ((accepted, "accepted"), (rejected, "not accepted")):
            rated.where(test).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        rated.limit(0).write.mode("overwrite").parquet(stored)

    writer = gated(stream).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
