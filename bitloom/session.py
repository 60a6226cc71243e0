"""Session defaults and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows here are whole documents, so Arrow batches are kept small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}



def build_session(app: str = "bitloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the library defaults; keyword settings (dots as ``__``) override them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _one_process(spark: SparkSession) -> bool:
    return bool(re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master))


def work_dir(spark: SparkSession) -> str:
    """A fresh folder below the shared checkpoint folder the cluster names.

    A session in one process without ``spark.checkpoint.dir`` (tests, benches) works below its warehouse;
    a cluster has to name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and _one_process(spark):
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def prepare_session(spark: SparkSession) -> None:
    """Settings the results rely on, for a session that ``build_session`` did not make."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    for key in ("maxRecordsPerBatch", "maxBytesPerBatch"):
        spark.conf.set(f"spark.sql.execution.arrow.{key}", DEFAULTS[f"spark.sql.execution.arrow.{key}"])
    ship_package(spark)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package's source to the Python workers that may lack it, once per application; those of
    a session in one process lack it too when the driver was started elsewhere.

    The zip is read by the driver alone; Spark's own file server hands it to the executors.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="bitloom-source-"), "bitloom.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)
