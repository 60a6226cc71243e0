"""Tables as streams and streams to tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from bitloom.session import work_dir

CLOSING = "9999-01-01 00:00:00"


def table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table in a folder, one file or a folder of files, as a stream with the table's schema."""
    table = spark.read.parquet(f"{folder}/{name}.parquet")
    # the last letter as a pattern: a plain path has to be a folder, a pattern may match a file as well
    return spark.readStream.schema(table.schema).parquet(f"{folder}/{name}.parque[t]")


def read_written(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What a stream has written; no rows where it has written nothing."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _run(stream: DataFrame, base: str) -> StreamingQuery:
    query = (stream.writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", f"{base}/state").option("path", f"{base}/rows")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def drain(stream: DataFrame) -> DataFrame:
    """Run a stream over what is available and return the written table."""
    base = work_dir(stream.sparkSession)
    _run(stream, base)
    return read_written(stream.sparkSession, f"{base}/rows", stream.schema)


class Closable:
    """A timed stream that can be ended: ``rows`` also reads a folder that is empty until ``close``
    writes one row far in the future there. That row moves the watermark behind every window of the rows
    before, so all of them come out; its own window never does."""

    def __init__(self, stream: DataFrame, base: str, time: str = "ts"):
        self.spark, self.time, self.path = stream.sparkSession, time, f"{base}/closing"
        self.empty = self.spark.createDataFrame([], stream.schema)
        self.empty.write.parquet(self.path)
        self.rows = stream.unionByName(self.spark.readStream.schema(stream.schema).parquet(self.path))

    def close(self) -> None:
        kinds = {f.name: f.dataType for f in self.empty.schema.fields}
        row = [F.lit(CLOSING if c == self.time else None).cast(kind).alias(c) for c, kind in kinds.items()]
        self.spark.range(1).select(*row).write.mode("append").parquet(self.path)


def drain_closed(stream: DataFrame, aggregate) -> DataFrame:
    """Run ``aggregate(stream)``, with a watermark on ``ts``, over what is available, then end the stream
    and return all rows written, those of the last window included."""
    base = work_dir(stream.sparkSession)
    ended = Closable(stream, base)
    out = aggregate(ended.rows)
    _run(out, base)
    ended.close()
    _run(out, base)
    return read_written(stream.sparkSession, f"{base}/rows", out.schema)
