"""Line-aligned text files.

Lines are numbered per file without moving them: every file split knows where it starts, the rows
of a split keep their order, and a table with one row per split holds how many lines come before
it. Only the join of the two sides shuffles.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bitloom.functions import text as tx


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
        return True
    except AnalysisException:
        return False


def valid_text(value: Column) -> Column:
    """Undecodable bytes dropped."""
    repaired = F.replace(F.make_valid_utf8(value), F.lit("�"), F.lit(""))
    return F.when(F.is_valid_utf8(value), value).otherwise(repaired)


def read_splits(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """(value, file, block): text rows with the split they come from."""
    return spark.read.options(**options).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"))


def number_rows(df: DataFrame, name: str = "line_no") -> DataFrame:
    """Adds the 0-based position of a row within its file, given columns file and block.

    The rows must not have been shuffled since the scan.
    """
    placed = df.withColumn("_pos", F.monotonically_increasing_id())
    splits = placed.groupBy("file", "block").agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    starts = splits.select("file", "block", "_first", (F.sum("_n").over(earlier) - F.col("_n")).alias("_start"))
    numbered = placed.join(starts, ["file", "block"])
    return numbered.withColumn(name, F.col("_start") + F.col("_pos") - F.col("_first")).drop(
        "_pos", "_first", "_start")


def read_lines(spark: SparkSession, path: str | list[str], strip_file: bool = False) -> DataFrame:
    """(file, line_no, text). ``strip_file`` numbers from the first to the last non-blank line."""
    numbered = number_rows(read_splits(spark, path)).select(
        "file", "line_no", tx.strip(valid_text(F.col("value"))).alias("text"))
    if not strip_file:
        return numbered
    filled = numbered.where(F.col("text") != "").groupBy("file").agg(
        F.min("line_no").alias("_lo"), F.max("line_no").alias("_hi"))
    inside = numbered.join(filled, "file").where(F.col("line_no").between(F.col("_lo"), F.col("_hi")))
    return inside.select("file", (F.col("line_no") - F.col("_lo")).alias("line_no"), "text")


def zip_lines(left: DataFrame, right: DataFrame, keys: tuple[str, ...] = ("line_no",)) -> DataFrame:
    """Positional join: row i with row i, as long as the shorter side."""
    a = left.select(*keys, F.col("text").alias("source"))
    b = right.select(*keys, F.col("text").alias("target"))
    return a.join(b, list(keys))


def relative_stem(file: str, folder: str) -> Column:
    """Path of a file below the folder without its ending, one name per file of a tree."""
    inside = F.element_at(F.split(F.col(file), rf"\Q{folder.rstrip('/')}/\E", -1), -1)
    return F.regexp_replace(F.regexp_replace(inside, r"\.[^./]+$", ""), "/", "_")


def numbered_files(lines: DataFrame) -> DataFrame:
    """Adds ``file_no``, the rank of the file by its name; ranks one row per file."""
    files = lines.select("file").distinct()
    ranks = files.select("file", (F.row_number().over(Window.orderBy("file")) - 1).alias("file_no"))
    return lines.join(ranks, "file")


def read_aligned(spark: SparkSession, source_path: str, target_path: str, prefix: str = "europarl_",
                 drop_empty: bool = True, strip_file: bool = False, domain: str = "general") -> DataFrame:
    """Pairs of two files, or of two sides of equally many files in the order of their names, aligned by
    line. Ids carry the line number, and the file's from the second one on."""
    sides = [numbered_files(read_lines(spark, p, strip_file)) for p in (source_path, target_path)]
    counts = [side.agg(F.max("file_no")).first()[0] for side in sides]
    if None not in counts and counts[0] != counts[1]:
        raise ValueError(f"the sides have {counts[0] + 1} and {counts[1] + 1} files")
    pairs = zip_lines(*sides, ("file_no", "line_no"))
    if drop_empty:
        pairs = pairs.where((F.col("source") != "") & (F.col("target") != ""))
    file = F.when(F.col("file_no") > 0, F.concat(F.col("file_no").cast("string"), F.lit("_"))).otherwise("")
    return pairs.select(
        F.concat(F.lit(prefix), file, F.col("line_no").cast("string")).alias("sample_id"),
        (F.col("file_no") * F.lit(1 << 40) + F.col("line_no")).alias("row_idx"), "source", "target",
        F.lit(domain).alias("domain"))


# File names tried for aligned text, in order.
ALIGNED_NAMES = [("en.txt", "nl.txt"), ("english.txt", "dutch.txt")]


def read_aligned_folder(spark: SparkSession, folder: str, prefix: str = "wmt16_txt_") -> DataFrame | None:
    """All file pairs present under the known names (blank lines kept), or None."""
    found = []
    for number, (left, right) in enumerate(ALIGNED_NAMES):
        a, b = f"{folder}/{left}", f"{folder}/{right}"
        if path_exists(spark, a) and path_exists(spark, b):
            own = f"{prefix}{number}_" if number else prefix  # ids stay apart
            found.append(read_aligned(spark, a, b, own, drop_empty=False, strip_file=True, domain="software"))
    if not found:
        return None
    out = found[0]
    for frame in found[1:]:
        out = out.unionByName(frame)
    return out


def read_stem_folder(spark: SparkSession, folder: str, lang: str = "nl",
                     prefix: str = "wmt16_batch_") -> DataFrame:
    """``<stem>_en.txt`` with ``<stem>_<lang>.txt`` in a folder tree, joined on (stem, line)."""
    def side(code: str) -> DataFrame:
        options = {"recursiveFileLookup": "true", "pathGlobFilter": f"*_{code}.txt"}
        lines = number_rows(read_splits(spark, folder, **options))
        stem = F.regexp_replace("file", f"_{code}\\.txt$", "")
        return lines.select(stem.alias("stem"), "line_no", tx.strip(valid_text(F.col("value"))).alias("text"))

    pairs = zip_lines(side("en"), side(lang), ("stem", "line_no"))
    name = relative_stem("stem", folder)
    return pairs.where((F.col("source") != "") & (F.col("target") != "")).select(
        F.concat(F.lit(prefix), name, F.lit("_"), F.col("line_no").cast("string")).alias("sample_id"),
        F.col("line_no").alias("row_idx"), "source", "target", F.lit("software/IT").alias("domain"),
        F.create_map(F.lit("source"), F.lit("wmt16_batch")).alias("metadata"))
