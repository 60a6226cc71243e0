import pytest
from pyspark.sql import functions as F

from bitloom.plans import score_queries, views
from bitloom.session import work_dir
from bitloom.streaming import dedup, files, monitor

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def spread(spark, tmp_path_factory):
    """The tables as folders of three files."""
    base = str(tmp_path_factory.mktemp("spread"))
    for name in ("events", "documents"):
        views.table(spark, DATA, name).repartition(3).write.parquet(f"{base}/{name}.parquet")
    return base


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_windows_equal_batch(spark, spread):
    batch = rows_of(monitor.window_metrics(views.as_requests(views.table(spark, DATA, "events")), "1 day"))
    for folder in (DATA, spread):
        stream = views.as_requests(files.table_stream(spark, folder, "events"))
        assert rows_of(monitor.window_metrics(stream, "1 day")) == batch


@pytest.mark.parametrize("name", ["monitor_windows_stream", "stream_dedup", "stream_qe_gate"])
def test_stream_queries_on_a_folder(spark, spread, name):
    query = score_queries.QUERIES[name]
    assert rows_of(query(spark, spread)) == rows_of(query(spark, DATA)) != []


def test_streams_without_rows(spark, tmp_path):
    for name in ("events", "documents"):
        views.table(spark, DATA, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    for name in ("monitor_windows_stream", "stream_dedup", "stream_qe_gate"):
        df = score_queries.QUERIES[name](spark, str(tmp_path))
        assert df.collect() == [] and df.columns == score_queries.QUERIES[name](spark, DATA).columns


def test_closed_windows_are_written_as_they_close(spark, tmp_path):
    events = views.table(spark, DATA, "events").select("ts", "user_id", "value", "event_type")
    day = lambda d: events.where(F.dayofmonth("ts") == d)
    source = f"{tmp_path}/source"
    stream = lambda: views.as_requests(spark.readStream.schema(events.schema).parquet(source))
    for d in (2, 3):
        day(d).write.mode("append").parquet(source)
        monitor.run_monitor(stream(), f"{tmp_path}/out", f"{tmp_path}/state", available_now=True).awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out")
    batch = monitor.window_metrics(views.as_requests(events.where(F.dayofmonth("ts").isin(2, 3))))
    assert rows_of(got.select(batch.columns).where(F.dayofmonth("window_start") == 2)) == rows_of(
        batch.where(F.dayofmonth("window_start") == 2))


def test_state_holds_one_row_per_latency(spark):
    rows = spark.range(5000).selectExpr("timestamp'2024-01-01 00:00:00' AS ts", "double(id % 7) AS latency", "id % 2 = 0 AS is_error")
    counts = monitor.latency_counts(rows)
    assert counts.count() == 7 and not [f for f in counts.schema.fields if f.dataType.typeName() in ("array", "map", "binary")]


def test_optional_rates_and_error_categories(spark):
    rows = spark.createDataFrame([("2024-01-01 00:01:00", 1.0, True, False, 0.5, ["a", "b"]), ("2024-01-01 00:02:00", 3.0, False, True, 0.7, ["a"])],
                                 "t string, latency double, is_error boolean, is_fallback boolean, score double, error_types array<string>")
    rows = rows.withColumn("ts", F.to_timestamp("t"))
    out = monitor.window_metrics(rows).first()
    assert (out["n"], out["error_rate"], out["fallback_rate"], round(out["mean_score"], 9)) == (2, 0.5, 0.5, 0.6)
    counts = {r["error_type"]: r["n"] for r in monitor.error_rate_by_category(rows).collect()}
    assert counts == {"a": 2, "b": 1}


def test_repeats(spark):
    rows = spark.createDataFrame([(1,), (1,), (2,)], "key int")
    assert dedup.drop_repeats(rows, ["key"]).count() == 2


def test_work_dir_follows_the_session(spark):
    assert work_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_percentiles_are_exact(spark):
    rows = spark.range(200_000).selectExpr("timestamp'2024-01-01 00:00:00' AS ts", "double(id * 7919 % 200000) AS latency", "false AS is_error")
    row = monitor.window_metrics(rows, "1 day").first()
    assert [row[f"latency_p{p}"] for p in (50, 95, 99)] == [99_999.0, 189_999.0, 197_999.0]


def test_gate_holds_no_batch_in_a_cache(spark, tmp_path, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    from bitloom.plans import views
    from bitloom.streaming import files, gate

    spark.createDataFrame([(i, "Some text that ends.") for i in range(40)], "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet")
    rows = views.with_scores(views.decorate(files.table_stream(spark, str(tmp_path), "documents")))
    kept = []
    monkeypatch.setattr(DataFrame, "persist", lambda self, *a: kept.append(1) or self)
    gate.run_gate(rows, f"{tmp_path}/a", f"{tmp_path}/r", f"{tmp_path}/state").awaitTermination()
    sides = [spark.read.parquet(f"{tmp_path}/{side}") for side in "ar"]
    assert not kept and sides[0].where("not accepted").isEmpty() and sides[1].where("accepted").isEmpty()
    assert sorted(r["row_idx"] for side in sides for r in side.collect()) == list(range(40))
    assert spark.read.parquet(f"{tmp_path}/state/rated").isEmpty()
