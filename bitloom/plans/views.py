"""Pair, evaluation and score tables derived from the given tables, in Spark and in DuckDB SQL.

Each view keeps the whole text and every row, but for ``pairs``: user turns without a reply have no pair. The arithmetic on ``doc_id`` only decides how a row is
altered (a word left out, a placeholder lost), never whether it takes part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bitloom.functions import text as tx


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pairs(spark: SparkSession, folder: str) -> DataFrame:
    """User turns with the assistant turn that follows. A join on (conversation, turn) instead of a
    window per conversation, so one long conversation is spread like any other rows."""
    turns = table(spark, folder, "conversations")
    user = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("source"))
    reply = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("target"))
    return user.join(reply, ["conv_id", "turn"]).select(
        F.concat_ws("_", F.lit("conv"), "conv_id", "turn").alias("sample_id"),
        (F.col("conv_id") * 1_000_000_000 + F.col("turn")).alias("row_idx"), "source", "target")


def eval_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as references; every seventh word (counted from the document id) is missing in the
    hypothesis."""
    docs = table(spark, folder, "documents").select("doc_id", "lang", tx.words(F.col("text")).alias("w"))
    left = F.filter("w", lambda _, i: (i + 1 + F.col("doc_id")) % 7 != 0)
    return docs.select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("sample_id"),
        F.col("doc_id").alias("row_idx"), "lang",
        F.array_join("w", " ").alias("reference"), F.array_join(left, " ").alias("hypothesis"))


def decorated(spark: SparkSession, folder: str) -> DataFrame:
    return decorate(table(spark, folder, "documents"))


def decorate(documents: DataFrame) -> DataFrame:
    """Documents with placeholders, terms and links, and a translation that loses some of them."""
    doc = F.col("doc_id")
    docs = documents.select("doc_id", tx.collapse_whitespace(F.col("text")).alias("t"))
    some = lambda k, value: F.when(doc % k == 0, value).otherwise("")
    number = F.concat(F.lit("{"), (doc % 3 + 1).cast("string"), F.lit("}"))
    body = (F.when(doc % 7 == 0, F.substring_index("t", " ", 1))
            .when(doc % 13 == 0, F.concat_ws(" ", "t", "t", "t")).otherwise(F.col("t")))
    return docs.select(
        F.concat(F.lit("doc_"), doc.cast("string")).alias("sample_id"), doc.alias("row_idx"),
        F.concat(number, "t", some(5, " %s {2}"), some(4, " USB-C Bluetooth"),
                 some(11, F.concat(F.lit(" https://example.org/"), doc.cast("string"))),
                 some(10, " ™")).alias("source"),
        F.concat(F.when(doc % 6 == 0, "").otherwise(number), body, some(5, " %s {2}"),
                 some(8, " USB-C Bluetooth"), some(9, " the the is")).alias("translation"),
        F.col("t").alias("reference"))


def with_scores(df: DataFrame) -> DataFrame:
    """Three derived segment scores per document, each missing on some rows."""
    doc = F.col("row_idx")

    def score(factor: int, gap: int):
        return F.when(doc % gap != 0, (doc * factor % 101) / 100)

    return df.withColumns({"comet_qe": score(37, 4), "comet": score(53, 3), "bert_f1": score(71, 5)})


def scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("sample_id"),
        F.col("doc_id").alias("row_idx"))
    return with_scores(docs)


def as_requests(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").alias("key"),
        F.col("value").alias("latency"), (F.col("event_type") == "error").alias("is_error"))


# --- the same views for DuckDB -------------------------------------------------------------------
PAIRS = """v_pairs AS (
  SELECT 'conv_' || u.conv_id || '_' || u.turn AS sample_id,
         u.conv_id * 1000000000 + u.turn AS row_idx, u.text AS source, a.text AS target
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""

EVAL = r"""v_words AS (
  SELECT doc_id, lang, regexp_extract_all(text, '\S+') AS w FROM documents),
v_eval AS (
  SELECT 'doc_' || doc_id AS sample_id, doc_id AS row_idx, lang,
         array_to_string(w, ' ') AS reference,
         array_to_string(list_filter(w, lambda x, i: (i + doc_id) % 7 <> 0), ' ') AS hypothesis
  FROM v_words)"""

DECORATED = r"""v_text AS (
  SELECT doc_id, array_to_string(regexp_extract_all(text, '\S+'), ' ') AS t FROM documents),
v_decorated AS (
  SELECT 'doc_' || doc_id AS sample_id, doc_id AS row_idx,
    '{' || (doc_id % 3 + 1) || '}' || t
      || CASE WHEN doc_id % 5 = 0 THEN ' %s {2}' ELSE '' END
      || CASE WHEN doc_id % 4 = 0 THEN ' USB-C Bluetooth' ELSE '' END
      || CASE WHEN doc_id % 11 = 0 THEN ' https://example.org/' || doc_id ELSE '' END
      || CASE WHEN doc_id % 10 = 0 THEN ' ™' ELSE '' END AS source,
    CASE WHEN doc_id % 6 = 0 THEN '' ELSE '{' || (doc_id % 3 + 1) || '}' END
      || CASE WHEN doc_id % 7 = 0 THEN split_part(t, ' ', 1)
              WHEN doc_id % 13 = 0 THEN t || ' ' || t || ' ' || t ELSE t END
      || CASE WHEN doc_id % 5 = 0 THEN ' %s {2}' ELSE '' END
      || CASE WHEN doc_id % 8 = 0 THEN ' USB-C Bluetooth' ELSE '' END
      || CASE WHEN doc_id % 9 = 0 THEN ' the the is' ELSE '' END AS translation,
    t AS reference
  FROM v_text)"""

SCORES = """v_scores AS (
  SELECT 'doc_' || doc_id AS sample_id, doc_id AS row_idx,
    CASE WHEN doc_id % 4 <> 0 THEN (doc_id * 37 % 101) / 100.0::DOUBLE END AS comet_qe,
    CASE WHEN doc_id % 3 <> 0 THEN (doc_id * 53 % 101) / 100.0::DOUBLE END AS comet,
    CASE WHEN doc_id % 5 <> 0 THEN (doc_id * 71 % 101) / 100.0::DOUBLE END AS bert_f1
  FROM documents)"""

REQUESTS = """v_requests AS (
  SELECT ts, user_id AS key, value AS latency, event_type = 'error' AS is_error FROM events)"""


def sql(*views: str) -> str:
    return "WITH " + ",\n".join(views) + "\n"
