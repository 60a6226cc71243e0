"""Gettext catalogues as pairs.

Files are read in pieces that end at blank lines, so a large catalogue is spread over tasks. A
piece is cut again before every msgid, and each entry is parsed with regular expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bitloom.functions import text as tx
from bitloom.sources.lines import relative_stem, number_rows, read_splits, valid_text

_QUOTED = r'"((?:[^"\\]|\\.)*+)"'
_LINES = rf'((?:\s*(?:#~\s*)?{_QUOTED.replace("((", "(?:(")})++)'


def _string_of(entry: Column, keyword: str) -> Column:
    """Concatenated string lines after a keyword; null when the keyword is absent."""
    block = F.regexp_extract(entry, rf"(?m)^(?:#~\s*)?{keyword}\s{_LINES}", 1)
    return F.when(block != "", F.array_join(tx.matches(block, _QUOTED, 1), ""))


def _plural_forms(entry: Column) -> Column:
    """Array of (source, target) of one entry: msgid with the first form, msgid_plural with all others."""
    single, plural = _string_of(entry, "msgid"), _string_of(entry, "msgid_plural")
    pair = lambda s, t: F.struct(s.alias("source"), t.alias("target"))
    blocks = tx.matches(entry, rf"(?m)^(?:#~\s*)?msgstr\[\d+\]\s{_LINES}", 1)
    forms = F.transform(blocks, lambda b, i: pair(
        F.when(i == 0, single).otherwise(plural), F.array_join(tx.matches(b, _QUOTED, 1), "")))
    plain = F.array(pair(single, _string_of(entry, "msgstr")))
    chosen = F.when(plural.isNotNull(), forms).otherwise(plain)
    return F.filter(chosen, lambda p: p["source"].isNotNull() & p["target"].isNotNull())


def parse_catalogues(spark: SparkSession, path: str, lang: str | None = None, newline: str = " ",
                     domain: str = "software", glob: str = "*.po") -> DataFrame:
    """Pairs of every catalogue below a folder (``*.po``, or ``*.<lang>.po``).

    Header entries, pairs with an empty side and untranslated pairs are dropped.
    """
    options = {"recursiveFileLookup": "true", "lineSep": "\n\n",
               "pathGlobFilter": f"*.{lang}.po" if lang else glob}
    pieces = read_splits(spark, path, **options)
    entries = pieces.select("file", "block", F.explode(
        F.split(valid_text(F.col("value")), r"(?m)^(?=(?:#~\s*)?msgid\s)")).alias("entry"))
    entries = entries.where(F.col("entry").rlike(r"(?m)^(?:#~\s*)?msgid\s"))
    pairs = number_rows(entries, "entry_no").select(
        "file", "entry_no", F.posexplode(_plural_forms(F.col("entry"))).alias("form", "p"))
    stem = relative_stem("file", path)
    form = F.when(F.col("form") > 0, F.concat(F.lit("_"), F.col("form").cast("string"))).otherwise("")
    cleaned = pairs.where("p.source != '' and p.target != '' and p.source != p.target").select(
        F.concat(F.lit("po_"), stem, F.lit("_"), F.col("entry_no").cast("string"), form).alias("sample_id"),
        F.col("entry_no").alias("row_idx"),
        tx.unescape_po(F.col("p.source"), newline).alias("source"),
        tx.unescape_po(F.col("p.target"), newline).alias("target"),
        F.lit(domain).alias("domain"),
        F.create_map(F.lit("source_file"), F.col("file")).alias("metadata"))
    return cleaned.where((F.col("source") != "") & (F.col("target") != "")
                         & (F.col("source") != F.col("target")))
