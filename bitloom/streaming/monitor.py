"""Monitoring of translation requests by event time.

A window's requests are counted per distinct latency first. A stream keeps these counts as its state,
one row of fixed size per (window, latency), and writes them when the window closes; percentiles and
means come from the written counts, for a batch and for a stream alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bitloom.operators.quantiles import ranked_values
from bitloom.streaming.files import drain_closed

PERCENTS = (50, 95, 99)


def latency_counts(requests: DataFrame, size: str = "1 hour", slide: str | None = None,
                   delay: str | None = "10 minutes") -> DataFrame:
    """(window_start, window_end, latency, n, sums …) of requests (ts, latency, is_error).

    ``is_fallback`` and ``score`` are used when present. Sums are decimal, so they do not depend on the
    order of the rows.
    """
    rows = requests.withWatermark("ts", delay) if requests.isStreaming else requests
    window = F.window("ts", size, slide) if slide else F.window("ts", size)
    exact = lambda c: F.sum(F.col(c).cast("decimal(28,12)"))
    sums = [F.count(F.lit(1)).alias("n"), exact("latency").alias("latency_sum")]
    for flag in ("is_error", "is_fallback"):
        if flag in requests.columns:
            sums += [F.sum(F.col(flag).cast("long")).alias(f"{flag}_sum"), F.count(flag).alias(f"{flag}_n")]
    if "score" in requests.columns:
        sums += [exact("score").alias("score_sum"), F.count("score").alias("score_n")]
    out = rows.groupBy(window.alias("w"), "latency").agg(*sums)
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "latency",
                      *[c for c in out.columns if c not in ("w", "latency")])


def metrics_of_counts(counts: DataFrame) -> DataFrame:
    """Count, latency percentiles, means and rates per window.

    A percentile p is the smallest latency that at least p percent of the requests with a latency do not
    exceed. A window with very many distinct latencies is ranked in parts.
    """
    rate = lambda c: (F.sum(f"{c}_sum") / F.sum(f"{c}_n"))
    timed = F.sum(F.when(F.col("latency").isNotNull(), F.col("n")))
    means = [F.sum("n").alias("n"), (F.sum("latency_sum").cast("double") / timed).alias("mean_latency")]
    for flag, name in (("is_error", "error_rate"), ("is_fallback", "fallback_rate")):
        if f"{flag}_sum" in counts.columns:
            means.append(rate(flag).alias(name))
    if "score_sum" in counts.columns:
        means.append((F.sum("score_sum").cast("double") / F.sum("score_n")).alias("mean_score"))
    windows = counts.groupBy("window_start", "window_end").agg(*means)
    # rank n - floor(n - n p), counted from one: no rounding error lifts it by one
    ranks = [F.struct(F.lit(p).alias("name"), F.greatest(
        F.lit(0), F.col("total") - F.floor(F.col("total") - F.col("total") * (p / 100)) - 1).alias("rank"))
        for p in PERCENTS]
    values = counts.where("latency IS NOT NULL").select(
        F.col("window_start").alias("metric"), F.col("latency").alias("value"), "n")
    at = ranked_values(values, F.array(*ranks))
    pivoted = at.groupBy("metric").agg(*[
        F.max(F.when(F.col("target.name") == p, F.col("value"))).alias(f"latency_p{p}") for p in PERCENTS])
    joined = windows.join(pivoted.withColumnRenamed("metric", "window_start"), "window_start", "left")
    return joined.select("window_start", "window_end", *[c for c in joined.columns if not c.startswith("window_")])


def window_metrics(requests: DataFrame, size: str = "1 hour", slide: str | None = None,
                   delay: str = "10 minutes") -> DataFrame:
    """Metrics of all windows of a batch, or of a stream's rows available now, to the last window."""
    if not requests.isStreaming:
        return metrics_of_counts(latency_counts(requests, size, slide))
    return metrics_of_counts(drain_closed(requests, lambda rows: latency_counts(rows, size, slide, delay)))


def run_monitor(requests: DataFrame, output: str, checkpoint: str, size: str = "1 hour",
                slide: str | None = None, delay: str = "10 minutes", available_now: bool = False) -> StreamingQuery:
    """Writes the metrics of every window once it has closed. All counts of a window come in one
    micro-batch, whose subfolder a replay overwrites."""
    def write(batch: DataFrame, batch_id: int) -> None:
        metrics_of_counts(batch).write.mode("overwrite").parquet(f"{output}/batch={batch_id}")

    writer = latency_counts(requests, size, slide, delay).writeStream.foreachBatch(write).option(
        "checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def error_rate_by_category(rows: DataFrame, size: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Rows per window and error type."""
    timed = rows.withWatermark("ts", delay) if rows.isStreaming else rows
    exploded = timed.select("ts", F.explode("error_types").alias("error_type"))
    out = exploded.groupBy(F.window("ts", size).alias("w"), "error_type").agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("w.start").alias("window_start"), "error_type", "n")
