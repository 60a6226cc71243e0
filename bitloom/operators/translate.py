"""Guarded calls of a user translation function, and plug-ins for scorers and tokenisers.

Only the user function runs in Python. Validation, sanitising, protecting and restoring are
Columns before and after it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bitloom import config
from bitloom.functions import protect
from bitloom.functions import text as tx
from bitloom.operators.glossary import fallback_translation

_CALL = T.StructType([T.StructField("output", T.StringType()), T.StructField("error", T.StringType()),
                      T.StructField("seconds", T.DoubleType())])


def _one_by_one(fn: Callable[[str], str], retries: int, pause: float):
    def call(text: str) -> tuple:
        start, error = time.time(), ""
        for attempt in range(retries):
            try:
                return fn(text), None, time.time() - start
            except Exception as exc:
                error = str(exc)
            if attempt < retries - 1:
                time.sleep(pause * (attempt + 1))
        return None, error, time.time() - start

    @F.pandas_udf(_CALL)
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(None, None, 0.0) if t is None else call(t) for t in batch]
            yield pd.DataFrame(rows, columns=_CALL.names)
    return udf.asNondeterministic()  # never called once more for a filter on its result


def bisected(fn: Callable[[list[str]], list[str]], texts: list[str]) -> list[tuple]:
    """(output, error) per text. A failing call is halved until the failing texts are alone, so a batch
    with one bad text costs about two calls per halving and loses that text only. A call that returns
    another number of outputs than texts has failed."""
    out: list[tuple] = [(None, None)] * len(texts)
    spans = [(0, len(texts))] if texts else []
    while spans:
        low, high = spans.pop()
        try:
            found = list(fn(texts[low:high]))
            if len(found) != high - low:
                raise ValueError(f"{len(found)} outputs for {high - low} texts")
            out[low:high] = [(text, None) for text in found]
        except Exception as exc:
            if high - low == 1:
                out[low] = (None, str(exc))
            else:
                middle = (low + high) // 2
                spans += [(middle, high), (low, middle)]
    return out


def _batch_at_once(fn: Callable[[list[str]], list[str]]):
    @F.pandas_udf(_CALL)
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            start = time.time()
            rows = bisected(fn, batch.tolist())
            share = (time.time() - start) / max(len(batch), 1)
            yield pd.DataFrame({"output": [o for o, _ in rows], "error": [e for _, e in rows], "seconds": share})
    return udf.asNondeterministic()  # never called once more for a filter on its result


_UNBOUNDED = (1 << 31) - 1


def _guarded(df: DataFrame, column: str, max_length: int) -> DataFrame:
    clean = tx.sanitize_input(F.col(column), max_length)
    held = df.withColumn("_p", protect.protect_placeholders(clean, config.GUARD_PATTERNS))
    return held.withColumn("_t", protect.protect_terms(F.col("_p.text")))


def _put_back(output: Column) -> Column:
    return protect.restore(protect.restore(output, F.col("_t.tokens")), F.col("_p.tokens"))


def translate_column(df: DataFrame, fn: Callable, column: str = "source", mode: str = "row",
                     max_length: int | None = None, retries: int = 3, pause: float = 0.5,
                     fallback_text: str = config.FALLBACK_TEXT) -> DataFrame:
    """Adds original_input, processed_input, output, warnings, fallback_used, processing_time.

    Text is cut only when ``max_length`` is given, with a warning in either mode.

    mode "row": ``fn(text)`` per row with retries; after the last failure the word dictionary
    translates the source. mode "batch": ``fn(texts)`` per Arrow batch, no validation and no
    retry; a failing batch is halved until the failing texts are alone, which get the constant fallback
    text.
    """
    cut = max_length is not None
    max_length = max_length if cut else _UNBOUNDED
    guarded = _guarded(df, column, max_length)
    original = F.col(column)
    if mode == "batch":
        called = guarded.withColumn("_c", _batch_at_once(fn)("_t.text"))
        failed = F.col("_c.error").isNotNull()
        output = F.when(failed, F.lit(fallback_text)).otherwise(_put_back(F.col("_c.output")))
        processed = F.col("_t.text")
        warnings = tx.validate_input(original, max_length)["warnings"] if cut else tx.strings([])
    else:
        blank = F.coalesce(tx.strip(original) == "", F.lit(True))
        called = guarded.withColumn("_c", _one_by_one(fn, retries, pause)(F.when(~blank, F.col("_t.text"))))
        failed = F.col("_c.error").isNotNull()
        raw = F.when(failed, fallback_translation(original)).otherwise(F.col("_c.output"))
        restored = _put_back(raw)
        filled = F.when(restored != "", restored).otherwise(F.lit(fallback_text))
        output = F.when(blank, F.lit("")).otherwise(F.coalesce(filled, F.lit(fallback_text)))
        processed = F.when(blank, F.lit("")).otherwise(F.col("_t.text"))
        checks = tx.validate_input(original, max_length)["warnings"]
        failure = F.array_compact(F.array(
            F.when(failed, F.concat(F.lit("Translation failed: "), F.col("_c.error")))))
        warnings = F.when(blank, tx.strings(["Empty input"])).otherwise(F.concat(checks, failure))
    return called.withColumns({
        "original_input": original, "processed_input": processed, "output": output,
        "warnings": warnings, "fallback_used": failed, "processing_time": F.col("_c.seconds"),
    }).drop("_p", "_t", "_c")


def guarded(fn: Callable[[str], str], **options) -> Callable[[DataFrame, str], DataFrame]:
    """Turn a text function into a table function with the same guards."""
    return lambda df, column="source": translate_column(df, fn, column, **options)


def add_scores(df: DataFrame, scorer: Callable[[list[tuple]], list[float]], inputs: list[str],
               name: str) -> DataFrame:
    """Adds a segment score from a user scorer that maps a list of input tuples to floats."""
    @F.pandas_udf(T.DoubleType())
    def udf(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            yield pd.Series(list(scorer(list(zip(*columns)))), dtype="float64")
    return df.withColumn(name, udf.asNondeterministic()(*inputs))


def tokenizer(encode: Callable[[str], list[str]]) -> Callable[[Column], Column]:
    """Column function text -> tokens joined by spaces, from a user tokeniser."""
    @F.pandas_udf(T.StringType())
    def udf(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else " ".join(encode(t)))
    return lambda text: udf(text)


def token_counter(encode: Callable[[str], list]) -> Callable[[Column], Column]:
    """Column function text -> number of tokens, from a user tokeniser."""
    @F.pandas_udf(T.IntegerType())
    def udf(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else len(encode(t))).astype("Int32")
    return lambda text: udf(text)
