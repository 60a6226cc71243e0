"""Scalar text functions. Everything but NFKC on unstable text runs inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bitloom import config

# Python's whitespace set, as regex class members and as characters for ``btrim``. Latin-1 members
# are listed one by one and the rest sits behind one range test: Java then needs two cheap tests
# per character instead of one per range.
SPACE_CLASS = (
    r"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    r"[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]"
)
SPACE_CHARS = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
# A character that NFKC may change: outside these stable ranges. ASCII leaves at the first test.
NFKC_UNSTABLE = (
    r"[\xa0-\x{10ffff}&&[^\xa1-\xa7\xa9\xab-\xae\xb0\xb1\xb6\xb7\xbb\xbf-\u0131\u0134-\u013e"
    r"\u0141-\u0148\u014a-\u017e\u0180-\u01c3\u01cd-\u01f0\u01f4-\u02af"
    r"\u2012-\u2016\u2018-\u2023\u20ac]]"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it several times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strings(values) -> Column:
    """Array literal that keeps its string type when empty."""
    return F.array(*map(F.lit, values)).cast("array<string>")


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE_CHARS))


def words(text: Column) -> Column:
    """Split on any run of Unicode whitespace without empty items."""
    return F.array_remove(F.split(text, f"[{SPACE_CLASS}]+", -1), "")


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def sorted_set(values: Column) -> Column:
    return F.sort_array(F.array_distinct(values))


def guarded_ratio(numerator: Column, denominator: Column, default: float) -> Column:
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(default))


@F.pandas_udf(T.StringType())
def _nfkc(text: pd.Series) -> pd.Series:
    return text.str.normalize("NFKC")


def nfkc(text: Column) -> Column:
    """NFKC form. Only text holding a character that NFKC may change is sent to Python."""
    return F.coalesce(_nfkc(F.when(text.rlike(NFKC_UNSTABLE), text)), text)


def normalize_whitespace(text: Column) -> Column:
    """Runs of spaces and runs of newlines become one; ends are stripped; tabs stay."""
    return strip(F.regexp_replace(F.regexp_replace(text, " +", " "), "\n+", "\n"))


def collapse_whitespace(text: Column) -> Column:
    return F.array_join(words(text), " ")


def normalize_punctuation(text: Column, fold_curly_quotes: bool = False) -> Column:
    """En and em dashes become hyphens, three or more dots an ellipsis of three."""
    if fold_curly_quotes:
        text = F.translate(text, "“”‘’", "\"\"''")
    return F.regexp_replace(F.regexp_replace(text, "[–—]", "-"), r"\.{3,}", "...")


def truncate_words(text: Column, limit: int) -> Column:
    """First ``limit`` words joined by spaces; shorter texts stay as they are."""
    cut = let(words(text), lambda w: F.when(F.size(w) > limit, F.array_join(F.slice(w, 1, limit), " ")))
    return F.coalesce(cut, text)


def preview(text: Column, chars: int = 80) -> Column:
    return F.substring(text, 1, chars)


def contained_terms(text: Column, terms: list[str], lower: bool = False,
                    word_boundary: bool = False) -> Column:
    """Terms of the list found in the text as substrings, or as whole words on request."""
    haystack = F.lower(text) if lower else text
    if word_boundary:
        whole = lambda term: F.concat(
            F.lit(r"(?<![\p{L}\p{N}])\Q"), term, F.lit(r"\E(?![\p{L}\p{N}])"))
        test = lambda t: lambda term: F.regexp_like(t, whole(term))
    else:
        test = lambda t: lambda term: F.contains(t, term)
    return let(haystack, lambda t: F.filter(strings(sorted(terms)), test(t)))


def contains_any(text: Column, terms: list[str]) -> Column:
    found = F.lit(False)
    for term in terms:
        found = found | F.contains(text, F.lit(term))
    return found


def placeholders(text: Column) -> Column:
    """Brace placeholders followed by percent placeholders, duplicates kept."""
    return F.concat(matches(text, config.BRACE_PLACEHOLDER), matches(text, config.PERCENT_PLACEHOLDER))


def language_features(text: Column) -> Column:
    return F.struct(
        F.char_length(text).alias("length_chars"),
        F.size(words(text)).alias("length_words"),
        text.rlike(config.BRACE_PLACEHOLDER).alias("has_placeholders"),
        text.rlike(config.PERCENT_PLACEHOLDER).alias("has_percent_vars"),
        contains_any(F.lower(text), config.DOMAIN_FLAG_TERMS).alias("has_technical_terms"),
        contains_any(text, [brand for brand, _ in config.BRAND_TOKENS]).alias("has_brand_names"),
        text.rlike(r"\p{Nd}").alias("has_numbers"),
        text.rlike("https?://").alias("has_urls"),
        text.rlike("[™®©]").alias("has_special_chars"),
    )


def validate_input(text: Column, max_length: int = 1024) -> Column:
    """Struct (is_valid, warnings). A blank text is invalid, an over-long one too."""
    length = F.char_length(text)
    special = F.char_length(F.regexp_replace(text, rf"[\p{{L}}\p{{N}}{SPACE_CLASS}]", ""))
    too_long = length > max_length
    long_text = F.concat(F.lit("Input exceeds max length ("), length.cast("string"),
                         F.lit(f" > {max_length})"))
    warnings = F.array_compact(F.array(
        F.when(too_long, long_text),
        F.when(~F.is_valid_utf8(text), F.lit(config.WARN_UTF8)),
        F.when(F.contains(text, F.lit("\x00")), F.lit(config.WARN_NUL)),
        F.when(guarded_ratio(special, length, 0.0) > 0.5, F.lit(config.WARN_SPECIAL)),
    ))
    blank = F.coalesce(strip(text) == "", F.lit(True))
    return F.struct(
        (~blank & ~too_long).alias("is_valid"),
        F.when(blank, strings([config.WARN_EMPTY])).otherwise(warnings).alias("warnings"),
    )


def sanitize_input(text: Column, max_length: int = 1024) -> Column:
    """Drop NUL, NFKC, collapse whitespace, cut at ``max_length`` (back to a late last space)."""
    clean = collapse_whitespace(nfkc(F.translate(F.coalesce(text, F.lit("")), "\x00", "")))

    def cut(t: Column) -> Column:
        head = F.substring(t, 1, max_length)
        last_space = max_length - F.instr(F.reverse(head), " ")
        has_space = F.contains(head, F.lit(" "))
        at_space = F.substring(head, F.lit(1), last_space)
        shorter = F.when(has_space & (last_space > max_length * 0.8), at_space).otherwise(head)
        return F.when(F.char_length(t) > max_length, strip(shorter)).otherwise(t)

    return let(clean, cut)


def unescape_po(text: Column, newline: str = " ") -> Column:
    """Undo gettext escapes for newlines and quotes, then strip."""
    return strip(F.replace(F.replace(text, F.lit("\\n"), F.lit(newline)), F.lit('\\"'), F.lit('"')))
