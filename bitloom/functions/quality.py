"""Quality-estimation rules as Columns: no shuffle, no Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bitloom import config
from bitloom.functions import text as tx


def _repeated_subtraction(step: float, times: int, start: float = 1.0) -> list[float]:
    """start, start-step, start-step-step … with the rounding of one subtraction at a time."""
    values = [start]
    for _ in range(times):
        values.append(values[-1] - step)
    return values


def _stepped(count: Column, step: float) -> Column:
    """1.0 minus ``step`` subtracted ``count`` times; 15 steps already lie far below zero."""
    table = _repeated_subtraction(step, 15)
    return F.element_at(F.array(*map(F.lit, table)), F.least(count, F.lit(15)) + 1)


def _clamp(score: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))


def _first_above(score: Column, *steps: tuple[float, str], otherwise: str) -> Column:
    chain = None
    for bound, name in steps:
        chain = F.when(score > bound, name) if chain is None else chain.when(score > bound, name)
    return chain.otherwise(otherwise)


def _class_of(score: Column, good: float, acceptable: float) -> Column:
    return F.when(score >= good, "good").when(score >= acceptable, "acceptable").otherwise("poor")


def quality_class(comet_qe: Column, comet: Column, bert_f1: Column) -> Column:
    """Class by the first score that is present."""
    return (
        F.when(comet_qe.isNotNull(), _class_of(comet_qe, 0.8, 0.5))
        .when(comet.isNotNull(), _class_of(comet, 0.85, 0.7))
        .when(bert_f1.isNotNull(), _class_of(bert_f1, 0.9, 0.75))
        .otherwise("unknown")
    )


def confidence(comet_qe: Column, comet: Column, bert_f1: Column) -> Column:
    """Mean of the scores that are present, else 0.5."""
    scores = (comet_qe, comet, bert_f1)
    total = sum((F.coalesce(s, F.lit(0.0)) for s in scores[1:]), F.coalesce(scores[0], F.lit(0.0)))
    count = sum((s.isNotNull().cast("int") for s in scores[1:]), scores[0].isNotNull().cast("int"))
    return F.when(count > 0, total / count).otherwise(F.lit(0.5))


def brace_set(text: Column) -> Column:
    return tx.sorted_set(tx.matches(text, config.BRACE_PLACEHOLDER))


def lowered_words(text: Column) -> Column:
    return tx.words(F.lower(text))


def error_types(source: Column, translation: Column, reference: Column | None = None,
                translated: Column | None = None) -> Column:
    """Detected error types in their fixed order. ``translated``: the translation's lowered words, where a
    column holds them."""
    translated = lowered_words(translation) if translated is None else translated
    ratio = tx.guarded_ratio(F.size(translated), F.size(tx.words(source)), 1.0)
    source_set = brace_set(source)
    foreign = F.filter(translated, lambda w: w.isin(config.UNTRANSLATED_WORDS))
    tests = [
        F.when((ratio < 0.5) | (ratio > 2.0), "length_mismatch"),
        F.when((F.size(source_set) > 0) & (source_set != brace_set(translation)),
               "missing_placeholder"),
        F.when(F.size(foreign) >= 2, "untranslated"),
    ]
    if reference is not None:
        wanted = F.array_distinct(lowered_words(reference))
        found = F.array_intersect(wanted, translated)
        share = tx.guarded_ratio(F.size(found), F.size(wanted), 0.0)
        tests.append(F.when((reference != "") & (share < 0.3), "semantic_divergence"))
    return F.array_compact(F.array(*tests))


def edit_effort(quality: Column, word_ratio: Column | None = None) -> Column:
    """Effort 1 to 5: by the word-sequence ratio to a post-edit if given, else by class."""
    by_class = F.when(quality == "good", 1).when(quality == "acceptable", 3).otherwise(4)
    if word_ratio is None:
        return by_class
    by_ratio = (
        F.when(word_ratio >= 0.95, 1).when(word_ratio >= 0.85, 2)
        .when(word_ratio >= 0.70, 3).when(word_ratio >= 0.50, 4).otherwise(5)
    )
    return F.when(word_ratio.isNotNull(), by_ratio).otherwise(by_class)


def adjacent_repeats(text: Column, lowered: Column | None = None) -> Column:
    """How often a word equals the word before it, without regard to case."""
    def count(w: Column) -> Column:
        return F.size(F.filter(w, lambda word, i: (i > 0) & (word == F.get(w, i - 1))))
    return tx.let(lowered_words(text) if lowered is None else lowered, count)


def fluency(text: Column, lowered: Column | None = None) -> Column:
    score = _stepped(adjacent_repeats(text, lowered), 0.1)
    ends = F.lit(False)
    for mark in config.SENTENCE_ENDS:
        ends = ends | F.endswith(tx.strip(text), F.lit(mark))
    score = F.when(ends, score).otherwise(score - 0.1)
    return _clamp(F.when(F.char_length(text) < 5, score - 0.3).otherwise(score))


def lost_terms(source: Column, translation: Column) -> Column:
    in_source = tx.contained_terms(source, config.PRESERVED_TERMS)
    return F.filter(in_source, lambda t: ~F.contains(translation, t))


def terminology(source: Column, translation: Column) -> Column:
    """Struct (score, issues): one tenth off per preserved term that got lost."""
    def build(lost: Column) -> Column:
        text = lambda t: F.concat(F.lit("Technical term '"), t, F.lit("' may need review"))
        return F.struct(_clamp(_stepped(F.size(lost), 0.1)).alias("score"),
                        F.transform(lost, text).alias("issues"))
    return tx.let(lost_terms(source, translation), build)


def formatting(source: Column, translation: Column) -> Column:
    """Struct (score, issues) from the placeholder differences in both directions."""
    def listed(label: str, items: Column) -> Column:
        text = F.concat(F.lit(label + " placeholders: {'"), F.array_join(items, "', '"), F.lit("'}"))
        return F.when(F.size(items) > 0, text)

    def build(sets: Column) -> Column:
        missing = F.array_except(sets["s"], sets["t"])
        extra = F.array_except(sets["t"], sets["s"])
        score = F.lit(1.0) - F.lit(0.3) * F.size(missing) - F.lit(0.2) * F.size(extra)
        issues = F.array_compact(F.array(listed("Missing", missing), listed("Extra", extra)))
        return F.struct(_clamp(score).alias("score"), issues.alias("issues"))

    return tx.let(F.struct(brace_set(source).alias("s"), brace_set(translation).alias("t")), build)


def accuracy_score(comet_qe: Column, comet: Column) -> Column:
    """First score that is present and not zero, else 0.7."""
    return F.when(comet_qe != 0, comet_qe).when(comet != 0, comet).otherwise(F.lit(0.7))


def _category(score: Column, severity: Column, issues: Column) -> Column:
    return F.struct(score.alias("score"), severity.alias("severity"), issues.alias("issues"))


def categories(fluency_score: Column, accuracy: Column, errors: Column, terms: Column,
               form: Column) -> Column:
    """Map of category name to (score, severity, issues)."""
    return F.create_map(
        F.lit("fluency"), _category(
            fluency_score,
            _first_above(fluency_score, (0.8, "minor"), (0.5, "major"), otherwise="critical"),
            tx.strings([])),
        F.lit("accuracy"), _category(
            accuracy,
            _first_above(accuracy, (0.8, "minor"), (0.6, "major"), otherwise="critical"), errors),
        F.lit("terminology"), _category(
            terms["score"], _first_above(terms["score"], (0.9, "minor"), otherwise="major"),
            terms["issues"]),
        F.lit("formatting"), _category(
            form["score"], _first_above(form["score"], (0.9, "minor"), otherwise="critical"),
            form["issues"]),
    )


def suggestions(quality: Column, errors: Column, cats: Column) -> Column:
    tests = [F.when(quality == "poor", F.lit(config.SUGGEST_RETRANSLATE))]
    for error, advice in config.SUGGEST_BY_ERROR.items():
        tests.append(F.when(F.array_contains(errors, error), F.lit(advice)))
    for name, advice in config.SUGGEST_BY_CATEGORY.items():
        severe = cats[name]["severity"].isin("major", "critical")
        tests.append(F.when(severe, F.lit(advice)))
    return F.array_compact(F.array(*tests))
