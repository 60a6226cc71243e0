"""Records of JSON arrays and quoted tables that run over lines and file splits.

Spark's text source cuts a file at a separator (``}`` or the line end) and reads its splits in parallel.
Whether a separator ends a record depends on the quotes and brackets before it. Per fragment, plain
columns count its quotes and its change of depth, for a fragment that begins inside of a string and for
one that does not. Every split sums these up; a prefix sum over one row per split tells in which state
each split begins; then every split cuts its records where they are. Only records that cross a split are
moved, and put together from their pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bitloom.sources.lines import read_splits


def _count(text: Column, chars: str) -> Column:
    """How often any of these characters occurs."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _fragments(spark: SparkSession, path, separator: str, options: dict) -> DataFrame:
    rows = read_splits(spark, path, lineSep=separator, **options)
    return rows.select(F.make_valid_utf8("value").alias("value"), "file", "block",
                       F.monotonically_increasing_id().alias("pos"))


def table_lines(spark: SparkSession, path, **options) -> DataFrame:
    """(value, file, block, pos, quotes, outside, inside) of the lines of a quoted table: no depth."""
    zero = F.lit(0)
    return _fragments(spark, path, "\n", options).withColumns({
        "quotes": _count(F.col("value"), '"'), "outside": zero, "inside": zero})


def array_objects(spark: SparkSession, path, **options) -> DataFrame:
    """The same of JSON text cut behind every ``}``; the change of depth includes that bracket where it
    stands outside of strings."""
    rows = _fragments(spark, path, "}", options).withColumn("_bare", F.regexp_replace("value", r"(?s)\\.", ""))
    rows = rows.withColumn("quotes", _count(F.col("_bare"), '"'))
    closed = {start: F.when((F.col("quotes") + start) % 2 == 0, 1).otherwise(0) for start in (0, 1)}

    def depth(start: int) -> Column:
        text = F.concat(F.lit('"'), F.col("_bare")) if start else F.col("_bare")
        outside = F.regexp_replace(text, r'"[^"]*("|$)', "")
        return _count(outside, "{[") - _count(outside, "}]") - closed[start]
    return rows.withColumns({"outside": depth(0), "inside": depth(1)}).drop("_bare")


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, slice]]:
    """Slices of equal (file, block)."""
    files = batch.column("file").dictionary_encode()
    names = files.dictionary.to_pylist()
    file, block = files.indices.to_numpy(zero_copy_only=False), batch.column("block").to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(block) != 0)) + 1
    for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(file)]):
        yield (names[file[low]], int(block[low])), slice(low, high)


def _columns(batch: pa.RecordBatch, part: slice) -> list[np.ndarray]:
    return [batch.column(c).to_numpy(zero_copy_only=False)[part].astype(np.int64) for c in ("quotes", "outside", "inside")]


def _states(quotes, outside, inside, odd: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Parity of the quotes and depth behind each fragment."""
    after = (odd + np.cumsum(quotes)) & 1
    before = np.concatenate([[odd], after[:-1]])
    return after, depth + np.cumsum(np.where(before == 1, inside, outside))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, odd, rise, rise_inside): what a split adds to the state, for both states before."""
    total: dict[tuple, list[list[int]]] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        for key, part in _runs(batch):
            states = total.setdefault(key, [[0, 0], [1, 0]])
            for state in states:
                after, depth = _states(*_columns(batch, part), *state)
                state[:] = int(after[-1]), int(depth[-1])
    if total:
        rows = [(f, b, plain[0], plain[1], quoted[1]) for (f, b), (plain, quoted) in total.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)],
                                         names=["file", "block", "odd", "rise", "rise_inside"])


def _cut(end_depth: int, separator: str):
    """Complete records, and the pieces at the edges of splits (begins: the piece starts a record)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, odd, depth, held, begins, number = None, 0, 0, [], True, 0

        def rest() -> list[tuple]:
            return [(*key, number, False, begins, separator.join(held) + separator)] if held else []

        for batch in batches:
            if not batch.num_rows:
                continue
            values, rows = batch.column("value"), []
            start_odd, start_depth = batch.column("start_odd"), batch.column("start_depth")
            for here, part in _runs(batch):
                if here != key:
                    rows += rest()
                    key, held, number = here, [], 0
                    odd, depth = start_odd[part.start].as_py(), start_depth[part.start].as_py()
                    begins = odd == 0 and depth <= end_depth
                after, depths = _states(*_columns(batch, part), odd, depth)
                odd, depth = int(after[-1]), int(depths[-1])
                ends = np.flatnonzero((after == 0) & (depths == end_depth))
                texts = values.slice(part.start, part.stop - part.start).to_pylist()
                low = 0
                for end in ends.tolist():
                    held += texts[low:end + 1]
                    rows.append((*key, number, begins, begins, separator.join(held) + separator))
                    held, begins, low, number = [], True, end + 1, number + 1
                held += texts[low:]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)
        if rows := rest() if key else []:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)

    names = ["file", "block", "number", "whole", "begins", "record"]
    return run


def cut_records(fragments: DataFrame, separator: str, end_depth: int) -> DataFrame:
    """(file, block, number, record): records in their order by (block, number) within a file. An
    unfinished one at the end of a file is kept."""
    split = ["file", "block"]
    sums = (fragments.select(*split, "quotes", "outside", "inside")
            .mapInArrow(_sums, "file string, block long, odd long, rise long, rise_inside long"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (sums.withColumn("start_odd", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
              .withColumn("_rise", F.when(F.col("start_odd") == 1, F.col("rise_inside")).otherwise(F.col("rise")))
              .withColumn("start_depth", F.coalesce(F.sum("_rise").over(before), F.lit(0)))
              .select(*split, "start_odd", "start_depth"))
    # one row per split on the right; sorted again only to be safe where that join shuffles
    placed = fragments.join(starts, split).sortWithinPartitions(*split, "pos")
    cut = placed.mapInArrow(_cut(end_depth, separator), "file string, block long, number long, whole boolean, "
                                                        "begins boolean, record string")
    pieces = cut.where(~F.col("whole"))
    order = Window.partitionBy("file").orderBy("block", "number")
    whole = (pieces.withColumn("of", F.sum(F.col("begins").cast("int")).over(order))
             .groupBy("file", "of").agg(F.sort_array(F.collect_list(F.struct("block", "number", "record"))).alias("p"))
             .select("file", F.col("p")[0]["block"].alias("block"), F.col("p")[0]["number"].alias("number"),
                     F.array_join("p.record", "").alias("record")))
    return cut.where("whole").select("file", "block", "number", "record").unionByName(whole)


def read_array_objects(spark: SparkSession, path, schema, **options) -> DataFrame:
    """The objects of JSON arrays, one array of objects per file, on any number of lines."""
    cut = cut_records(array_objects(spark, path, **options), "}", 1)
    record = F.regexp_replace("record", r"^[\s,\[﻿]+", "")
    return cut.where(F.startswith(record, F.lit("{"))).select(F.from_json(record, schema).alias("r")).select("r.*")


def _without_ends(record: Column) -> Column:
    """Without the mark before and the line end behind it. Most records have just one line feed."""
    ends = F.startswith(record, F.lit("\ufeff"))
    for end in "\r\n\x85\u2028\u2029":
        ends = ends | F.endswith(record, F.lit(end + "\n"))
    plain = F.endswith(record, F.lit("\n")) & ~ends
    return F.when(plain, F.rtrim(record, F.lit("\n"))).otherwise(F.regexp_replace(record, r"^\ufeff|\r?\n$", ""))


def _first_lines(spark: SparkSession, path, **options) -> DataFrame:
    """The first line of every file; two scans of lines, nothing is cut or sent to Python."""
    lines = _fragments(spark, path, "\n", options).where("block = 0")
    first = lines.groupBy("file").agg(F.min("pos").alias("pos"))
    return lines.join(first, ["file", "pos"]).select(F.concat("value", F.lit("\n")).alias("record"))


def read_quoted_table(spark: SparkSession, path, schema, sep: str = ",", header: bool = False, **options) -> DataFrame:
    """Rows of CSV or TSV files whose fields may hold line ends, quotes (doubled) and separators between
    quotes. With ``header``, the first record of each file has to name the columns of the schema."""
    cut = cut_records(table_lines(spark, path, **options), "\n", 0)
    rows = cut.select("block", "number", _without_ends(F.col("record")).alias("record")).where(F.col("record") != "")
    form = {"sep": sep, "escape": '"', "quote": '"', "mode": "PERMISSIVE"}
    if header:
        names = [f.name for f in schema.fields]
        first = (F.col("block") == 0) & (F.col("number") == 0)
        strings = ", ".join(f"`{n}` string" for n in names)
        # without line ends in the names, a header that fits is one line
        heads = rows.where(first) if any("\n" in n for n in names) else _first_lines(spark, path, **options).select(
            _without_ends(F.col("record")).alias("record")).where(F.col("record") != "")
        other = heads.select("record", F.from_csv("record", strings, form).alias("h")).where(
            ~F.array(*[F.col(f"h.`{n}`") for n in names]).eqNullSafe(F.array(*map(F.lit, names)))).first()
        if other:
            raise ValueError(f"the header {other['record']!r} does not name the columns {names}")
        rows = rows.where(~first)
    parsed = rows.select(F.from_csv("record", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields),
                                    form).alias("r"))
    return parsed.select("r.*")
