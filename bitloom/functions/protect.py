"""Protect placeholders, brand names and terms by tokens, and restore them.

A protected text is a struct (text, tokens) where tokens is an ordered array of
(token, original); a map would lose the order in which tokens must be put back.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from bitloom import config
from bitloom.functions.text import normalize_whitespace, strings
from bitloom.functions import text as tx


def _state(text: Column, tokens: Column) -> Column:
    return F.struct(text.alias("text"), tokens.alias("tokens"))


def _no_tokens() -> Column:
    return F.array().cast("array<struct<token:string,original:string>>")


def _entry(token: Column, original: Column) -> Column:
    return F.struct(token.alias("token"), original.alias("original"))


def protect_placeholders(text: Column, patterns=config.PIPELINE_PATTERNS) -> Column:
    """Replace the first occurrence of every distinct placeholder, pattern after pattern.

    Tokens are numbered per row. A pattern scans the text as the earlier patterns left it; later
    repeats of a placeholder stay as they are.
    """
    table = F.array(*[F.struct(F.lit(p).alias("pattern"), F.lit(t).alias("token"))
                      for p, t in patterns])

    def replace_one(token: Column):
        def merge(state: Column, original: Column) -> Column:
            named = F.replace(token, F.lit("#"), F.size(state["tokens"]).cast("string"))
            replaced = F.overlay(state["text"], named, F.position(original, state["text"]),
                                 F.char_length(original))
            known = F.exists(state["tokens"], lambda e: e["original"] == original)
            appended = F.concat(state["tokens"], F.array(_entry(named, original)))
            return F.when(known, state).otherwise(_state(replaced, appended))
        return merge

    def apply_pattern(state: Column, row: Column) -> Column:
        found = F.array_distinct(F.regexp_extract_all(state["text"], row["pattern"], F.lit(0)))
        return F.aggregate(found, state, replace_one(row["token"]))

    folded = F.aggregate(table, _state(text, _no_tokens()), apply_pattern)
    return F.when(text.rlike(r"[{%\\]"), folded).otherwise(_state(text, _no_tokens()))


def protect_terms(text: Column, terms=config.PROTECTED_TERMS) -> Column:
    """Replace every occurrence of each term, longest first, equal lengths in text order."""
    ordered = strings(sorted(terms, key=lambda t: (-len(t), t)))

    def merge(state: Column, term: Column) -> Column:
        token = F.concat(F.lit("__TERM_"), F.size(state["tokens"]).cast("string"), F.lit("__"))
        hit = _state(F.replace(state["text"], term, token),
                     F.concat(state["tokens"], F.array(_entry(token, term))))
        return F.when(F.contains(state["text"], term), hit).otherwise(state)

    return F.aggregate(ordered, _state(text, _no_tokens()), merge)


def restore(text: Column, tokens: Column) -> Column:
    """Put the originals back, in token order, at every occurrence."""
    return F.aggregate(tokens, text, lambda t, e: F.replace(t, e["token"], e["original"]))


def protect_brands(text: Column) -> Column:
    for brand, token in config.BRAND_TOKENS:
        text = F.regexp_replace(text, "(?iu)" + re.escape(brand).replace("\\ ", " "), token)
    return text


def restore_brands(text: Column) -> Column:
    for brand, token in config.BRAND_TOKENS:
        text = F.replace(text, F.lit(token), F.lit(brand))
    return text


def preprocess(text: Column, cfg: config.PreprocessConfig = config.PreprocessConfig()) -> Column:
    """Full preprocessing as a struct (text, tokens); empty input gives an empty text."""
    text = F.coalesce(text, F.lit(""))
    if cfg.normalize_unicode:
        text = tx.nfkc(text)
    if cfg.preserve_placeholders:
        state = protect_placeholders(text)
    else:
        state = _state(text, _no_tokens())

    def finish(s: Column) -> Column:
        out = s["text"]
        if cfg.preserve_technical_terms:
            out = protect_brands(out)
        if cfg.strip_extra_whitespace:
            out = normalize_whitespace(out)
        if cfg.normalize_punctuation:
            out = tx.normalize_punctuation(out, cfg.fold_curly_quotes)
        if cfg.max_length:
            out = tx.truncate_words(out, cfg.max_length)
        return _state(out, s["tokens"])

    return tx.let(state, finish)


def postprocess(text: Column, tokens: Column) -> Column:
    """Restore placeholders and brands, then normalise whitespace."""
    return normalize_whitespace(restore_brands(restore(text, tokens)))
