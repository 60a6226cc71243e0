import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bitloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("work")), spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def column(spark):
    """Evaluate a Column function on texts: column(fn, "a", "b") or column(fn, ("a", "b"), …)."""
    def run(fn, *rows):
        from pyspark.sql import functions as F

        rows = [r if isinstance(r, tuple) else (r,) for r in rows]
        width = len(rows[0])
        schema = "i int, " + ", ".join(f"c{k} string" for k in range(width))
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)
        out = df.select("i", fn(*[F.col(f"c{k}") for k in range(width)]).alias("v")).collect()
        return [r["v"] for r in sorted(out, key=lambda r: r["i"])]
    return run
