"""BLEU, chrF++ and TER per sentence, per corpus and per group.

Every metric is two steps: per-row counts (row-local, no shuffle), then sums of a handful of
numbers per group, which Spark combines before its only, tiny exchange. The score is a formula
over the sums. A group holding most rows costs no more than any other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitloom import config
from bitloom.functions import kernels
from bitloom.functions import text as tx

BLEU_ORDER, CHAR_ORDER, WORD_ORDER, CHRF_BETA = 4, 6, 2, 2
_TINY = 1e-16


# --- tokenisation --------------------------------------------------------------------------------
# Symbols, entities and split rules of the mteval-13a tokeniser. Spaces belong to the
# symbols as well; splitting on whitespace afterwards makes them irrelevant.
_SYMBOLS = r"[!\"#$%&()*+/:;<=>?@\[\\\]^_`{|}~]"
_ENTITIES = (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"))
_STOP_RULES = ((r"([^0-9])([.,])", "$1 $2 "), (r"([.,])([^0-9])", " $1 $2"))


def tokens_13a(text: Column) -> Column:
    """Tokens of the mteval-13a rules, joined by single spaces.

    The two full-stop rules of the published tokeniser test nearly every character twice. Outside
    runs of stops before a digit they amount to: split every stop or comma off unless it stands
    between two digits. Only texts with such a run take the literal rules.
    """
    line = F.replace(F.replace(text, F.lit("<skipped>")), F.lit("-\n"))
    line = F.replace(line, F.lit("\n"), F.lit(" "))
    for entity, char in _ENTITIES:
        line = F.replace(line, F.lit(entity), F.lit(char))
    line = F.regexp_replace(F.concat(F.lit(" "), line, F.lit(" ")), _SYMBOLS, " $0 ")

    def split_stops(t: Column) -> Column:
        literal = t
        for pattern, spaced in _STOP_RULES:
            literal = F.regexp_replace(literal, pattern, spaced)
        short = F.regexp_replace(t, r"[.,](?:(?<![0-9][.,])|(?![0-9]))", " $0 ")
        return F.when(t.rlike(r"[.,][.,][0-9]"), literal).otherwise(short)

    line = F.regexp_replace(tx.let(line, split_stops), r"-(?<=[0-9]-)", " - ")
    return tx.collapse_whitespace(line)


def _gram_count(length: Column, n: int) -> Column:
    return F.greatest(length - (n - 1), F.lit(0)).cast("long")


# --- BLEU ----------------------------------------------------------------------------------------
def _present(text: str):
    return F.coalesce(F.col(text), F.lit(""))


def bleu_counts(df: DataFrame, hyp: str = "hypothesis", ref: str = "reference",
                tokenize=tokens_13a) -> DataFrame:
    """Adds ``bleu_match`` (array), ``bleu_hyp_len`` and ``bleu_ref_len``. Null counts as empty."""
    tokens = df.withColumns({"_h": tokenize(_present(hyp)), "_r": tokenize(_present(ref))})
    counted = tokens.withColumn("_b", kernels.word_ngram_matches(BLEU_ORDER)("_h", "_r"))
    return counted.withColumns({
        "bleu_match": F.slice("_b", 1, BLEU_ORDER),
        "bleu_hyp_len": _matched("_b", BLEU_ORDER + 1),
        "bleu_ref_len": _matched("_b", BLEU_ORDER + 2),
    }).drop("_h", "_r", "_b")


def _product(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a * b, columns)


def _bleu(match: list[Column], total: list[Column], hyp_len: Column, ref_len: Column,
          effective: bool) -> tuple[Column, Column, list[Column]]:
    """(score, brevity penalty, precisions) with exponential smoothing of orders without a match."""
    zero = F.lit(0.0)
    precisions, smoothed = [], F.lit(1.0)
    for m, t in zip(match, total):
        unmatched = (t > 0) & (m == 0)
        smoothed = F.when(unmatched, smoothed * 2).otherwise(smoothed)
        precisions.append(F.when(t == 0, zero).when(m == 0, 100.0 / (smoothed * t))
                          .otherwise(100.0 * m / t))
    bp = (F.when(hyp_len >= ref_len, F.lit(1.0)).when(hyp_len == 0, zero)
          .otherwise(F.exp(1 - ref_len / F.greatest(hyp_len, F.lit(1)))))
    logs = [F.when(p > 0, F.log(p)).otherwise(zero) for p in precisions]
    used = sum(((t > 0).cast("int") for t in total[1:]), (total[0] > 0).cast("int"))
    usable = used > 0 if effective else used == len(total)
    divisor = F.greatest(used, F.lit(1)) if effective else F.lit(len(total))
    any_match = reduce(lambda a, b: a | b, [m > 0 for m in match])
    mean_log = sum(logs[1:], logs[0]) / divisor
    score = F.when(any_match & usable, bp * F.exp(mean_log)).otherwise(zero)
    # without any match the published scorer reports no precisions at all
    precisions = [F.when(any_match, p).otherwise(zero) for p in precisions]
    return score, bp, precisions


def _matched(column: str, n: int) -> Column:
    return F.element_at(F.col(column), n)


def sentence_bleu(df: DataFrame, hyp: str = "hypothesis", ref: str = "reference",
                  name: str = "bleu") -> DataFrame:
    """Adds the sentence score (orders without grams are left out of the mean)."""
    counted = bleu_counts(df, hyp, ref)
    orders = range(1, BLEU_ORDER + 1)
    score, _, _ = _bleu([_matched("bleu_match", n) for n in orders],
                        [_gram_count(F.col("bleu_hyp_len"), n) for n in orders],
                        F.col("bleu_hyp_len"), F.col("bleu_ref_len"), effective=True)
    return counted.withColumn(name, score).drop("bleu_match", "bleu_hyp_len", "bleu_ref_len")


def _bleu_sums() -> list[Column]:
    sums = []
    for n in range(1, BLEU_ORDER + 1):
        sums.append(F.sum(_matched("bleu_match", n)).alias(f"_m{n}"))
        sums.append(F.sum(_gram_count(F.col("bleu_hyp_len"), n)).alias(f"_t{n}"))
    return sums + [F.sum("bleu_hyp_len").alias("hyp_len"), F.sum("bleu_ref_len").alias("ref_len")]


def corpus_bleu(df: DataFrame, group_cols: list[str] = (), hyp: str = "hypothesis",
                ref: str = "reference", tokenize=tokens_13a) -> DataFrame:
    """One row per group: bleu, bp, precision_1..4, hyp_len, ref_len."""
    keep = df.select(*group_cols, hyp, ref)
    sums = bleu_counts(keep, hyp, ref, tokenize).groupBy(*group_cols).agg(*_bleu_sums())
    return _bleu_scores(sums.na.fill(0), group_cols)


def _bleu_scores(sums: DataFrame, group_cols) -> DataFrame:
    orders = range(1, BLEU_ORDER + 1)
    score, bp, precisions = _bleu([F.col(f"_m{n}") for n in orders], [F.col(f"_t{n}") for n in orders],
                                  F.col("hyp_len"), F.col("ref_len"), effective=False)
    return sums.select(*group_cols, score.alias("bleu"), bp.alias("bp"),
                       *[p.alias(f"precision_{n}") for n, p in zip(orders, precisions)],
                       "hyp_len", "ref_len")


# --- chrF++ --------------------------------------------------------------------------------------
_CHRF_ORDERS = [("c", n) for n in range(1, CHAR_ORDER + 1)] + [("w", n) for n in range(1, WORD_ORDER + 1)]


def chrf_counts(df: DataFrame, hyp: str = "hypothesis", ref: str = "reference") -> DataFrame:
    """Adds ``chrf_match`` (array over 6 character and 2 word orders) and the four lengths."""
    texts = df.withColumns({"_h": _present(hyp), "_r": _present(ref)})
    counted = texts.withColumn("_c", kernels.chrf_matches(CHAR_ORDER, WORD_ORDER)("_h", "_r"))
    orders = CHAR_ORDER + WORD_ORDER
    lengths = {c: _matched("_c", orders + i).cast("int") for i, c in enumerate(
        ("chrf_hc", "chrf_rc", "chrf_hw", "chrf_rw"), 1)}
    return counted.withColumns({"chrf_match": F.slice("_c", 1, orders), **lengths}).drop("_h", "_r", "_c")


def _chrf_totals(kind: str, n: int) -> tuple[Column, Column]:
    """Grams of hypothesis and reference; hypothesis grams only count where the reference has some."""
    ref = _gram_count(F.col(f"chrf_r{kind}"), n)
    hyp = F.when(ref > 0, _gram_count(F.col(f"chrf_h{kind}"), n)).otherwise(F.lit(0).cast("long"))
    return hyp, ref


def _chrf(stats: list[tuple[Column, Column, Column]]) -> Column:
    """F-score of the precision and recall averaged over the orders both sides have."""
    zero, precisions, recalls, used = F.lit(0.0), [], [], []
    for match, hyp, ref in stats:
        both = (hyp > 0) & (ref > 0)
        precisions.append(F.when(both, match / F.greatest(hyp, F.lit(1))).otherwise(zero))
        recalls.append(F.when(both, match / F.greatest(ref, F.lit(1))).otherwise(zero))
        used.append(both.cast("int"))
    orders = F.greatest(sum(used[1:], used[0]), F.lit(1))
    p, r = sum(precisions[1:], precisions[0]) / orders, sum(recalls[1:], recalls[0]) / orders
    factor = CHRF_BETA ** 2
    return F.when(p + r > 0, 100 * (1 + factor) * p * r / (factor * p + r)).otherwise(zero)


def sentence_chrf(df: DataFrame, hyp: str = "hypothesis", ref: str = "reference",
                  name: str = "chrf_pp") -> DataFrame:
    counted = chrf_counts(df, hyp, ref)
    stats = [(_matched("chrf_match", i + 1), *_chrf_totals(kind, n))
             for i, (kind, n) in enumerate(_CHRF_ORDERS)]
    return counted.withColumn(name, _chrf(stats)).drop(
        "chrf_match", "chrf_hc", "chrf_rc", "chrf_hw", "chrf_rw")


def _chrf_sums() -> list[Column]:
    sums = []
    for i, (kind, n) in enumerate(_CHRF_ORDERS):
        hyp, ref = _chrf_totals(kind, n)
        sums += [F.sum(_matched("chrf_match", i + 1)).alias(f"_cm{i}"),
                 F.sum(hyp).alias(f"_ch{i}"), F.sum(ref).alias(f"_cr{i}")]
    return sums


def _chrf_score() -> Column:
    return _chrf([(F.col(f"_cm{i}"), F.col(f"_ch{i}"), F.col(f"_cr{i}"))
                  for i in range(len(_CHRF_ORDERS))])


def corpus_chrf(df: DataFrame, group_cols: list[str] = (), hyp: str = "hypothesis",
                ref: str = "reference") -> DataFrame:
    """One row per group: chrf_pp."""
    counted = chrf_counts(df.select(*group_cols, hyp, ref), hyp, ref)
    sums = counted.groupBy(*group_cols).agg(*_chrf_sums()).na.fill(0)
    return sums.select(*group_cols, _chrf_score().alias("chrf_pp"))


# --- TER -----------------------------------------------------------------------------------------
def ter_counts(df: DataFrame, hyp: str = "hypothesis", ref: str = "reference") -> DataFrame:
    """Adds ``ter_edits``, ``ter_shifts`` and ``ter_ref_len``; case is ignored."""
    prepared = df.withColumns({"_h": F.lower(_present(hyp)), "_r": F.lower(_present(ref))})
    counted = prepared.withColumn("_e", kernels.ter_edits("_h", "_r"))
    return counted.withColumns({
        "ter_edits": F.col("_e.edits"), "ter_shifts": F.col("_e.shifts"),
        "ter_ref_len": F.col("_e.ref_len"),
    }).drop("_h", "_r", "_e")


def _ter(edits: Column, ref_len: Column) -> Column:
    return (F.when(ref_len > 0, 100.0 * edits / F.greatest(ref_len, F.lit(1)))
            .when(edits > 0, F.lit(100.0)).otherwise(F.lit(0.0)))


def sentence_ter(df: DataFrame, hyp: str = "hypothesis", ref: str = "reference",
                 name: str = "ter") -> DataFrame:
    return ter_counts(df, hyp, ref).withColumn(name, _ter(F.col("ter_edits"), F.col("ter_ref_len")))


def corpus_ter(df: DataFrame, group_cols: list[str] = (), hyp: str = "hypothesis",
               ref: str = "reference") -> DataFrame:
    """One row per group: ter, edits, shifts, ref_len."""
    counted = ter_counts(df.select(*group_cols, hyp, ref), hyp, ref)
    sums = counted.groupBy(*group_cols).agg(
        F.sum("ter_edits").alias("edits"), F.sum("ter_shifts").alias("shifts"),
        F.sum("ter_ref_len").alias("ref_len")).na.fill(0)
    return sums.select(*group_cols, _ter(F.col("edits"), F.col("ref_len")).alias("ter"),
                       "edits", "shifts", "ref_len")


# --- combined evaluation -------------------------------------------------------------------------
def aggregate_score(scores: dict[str, Column], bert_fallback: Column | None = None) -> Column:
    """Weighted mean of the metrics that are present (0 to 1 scale, TER inverted), else 0.

    Keys: bleu, chrf_pp, ter (0 to 100) and comet, bert_score (0 to 1). A BERTScore f1 of zero or
    null falls back to ``bert_fallback``.
    """
    parts = dict(scores)
    for key in ("bleu", "chrf_pp"):
        if key in parts:
            parts[key] = parts[key] / 100
    if "ter" in parts:
        parts["ter"] = F.when(parts["ter"].isNotNull(),
                              F.greatest(F.lit(0.0), 1 - parts["ter"] / 100))
    if "bert_score" in parts and bert_fallback is not None:
        f1 = parts["bert_score"]
        parts["bert_score"] = F.when(f1 != 0, f1).otherwise(bert_fallback)
    order = [k for k in config.AGGREGATE_WEIGHTS if k in parts]
    weighted, weights = F.lit(0.0), F.lit(0.0)
    for key in order:
        weight = F.lit(config.AGGREGATE_WEIGHTS[key])
        weighted = weighted + F.coalesce(parts[key] * weight, F.lit(0.0))
        weights = weights + F.when(parts[key].isNotNull(), weight).otherwise(F.lit(0.0))
    return F.when(weights > 0, weighted / weights).otherwise(F.lit(0.0))


def neural_system_scores(df: DataFrame, group_cols: list[str] = (),
                         columns: list[str] = ("comet_qe", "comet", "bert_f1")) -> DataFrame:
    """Mean of precomputed segment scores per group."""
    return df.groupBy(*group_cols).agg(*[F.avg(c).alias(c) for c in columns])


def first_segment_scores(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The first k segment scores in row order."""
    return df.where(F.col(column).isNotNull()).orderBy("row_idx").limit(k).select("row_idx", column)


def evaluate(df: DataFrame, group_cols: list[str] = ("dataset", "model"), hyp: str = "hypothesis",
             ref: str = "reference", metrics: list[str] = ("bleu", "chrf_pp", "ter")) -> DataFrame:
    """All metrics of every group in one pass over the rows and one exchange.

    Columns ``comet`` and ``bert_f1`` (segment scores), if present, add their means.
    """
    optional = [c for c in ("comet", "bert_f1") if c in df.columns]
    rows = df.select(*group_cols, hyp, ref, *optional)
    sums = [F.count(F.lit(1)).alias("num_samples")]
    if "bleu" in metrics:
        rows, sums = bleu_counts(rows, hyp, ref), sums + _bleu_sums()
    if "chrf_pp" in metrics:
        rows, sums = chrf_counts(rows, hyp, ref), sums + _chrf_sums()
    if "ter" in metrics:
        rows = ter_counts(rows, hyp, ref)
        sums += [F.sum("ter_edits").alias("_edits"), F.sum("ter_ref_len").alias("_ter_ref")]
    sums += [F.avg(c).alias("bert_score" if c == "bert_f1" else c) for c in optional]
    out = rows.groupBy(*group_cols).agg(*sums)
    scores = {}
    if "bleu" in metrics:
        orders = range(1, BLEU_ORDER + 1)
        score, bp, precisions = _bleu(
            [F.col(f"_m{n}") for n in orders], [F.col(f"_t{n}") for n in orders],
            F.col("hyp_len"), F.col("ref_len"), effective=False)
        scores |= {"bleu": score, "bp": bp,
                   **{f"precision_{n}": p for n, p in zip(orders, precisions)}}
    if "chrf_pp" in metrics:
        scores["chrf_pp"] = _chrf_score()
    if "ter" in metrics:
        scores["ter"] = _ter(F.col("_edits"), F.col("_ter_ref"))
    present = [c for c in ("comet", "bert_score") if c in out.columns]
    table = out.select(*group_cols, "num_samples", *[c.alias(k) for k, c in scores.items()], *present)
    used = [k for k in config.AGGREGATE_WEIGHTS if k in table.columns]
    return table.withColumn("aggregate_score", aggregate_score({k: F.col(k) for k in used}))


def sample_scores(df: DataFrame, hyp: str = "hypothesis", ref: str = "reference") -> DataFrame:
    """Per-row table: keys, texts, sentence BLEU and sentence chrF++."""
    return sentence_chrf(sentence_bleu(df, hyp, ref), hyp, ref, name="chrf")


def spm_bleu(df: DataFrame, tokenizer, group_cols: list[str] = (), hyp: str = "hypothesis",
             ref: str = "reference") -> DataFrame:
    """BLEU and chrF++ with a user tokeniser: a Column function text -> space-joined tokens."""
    bleu = corpus_bleu(df, group_cols, hyp, ref, tokenize=tokenizer)
    bleu = bleu.select(*group_cols, F.col("bleu").alias("sp_bleu"))
    chrf = corpus_chrf(df, group_cols, hyp, ref)
    if group_cols:
        return bleu.join(chrf, list(group_cols))
    return bleu.withColumn("chrf_pp", chrf.scalar())


def result_json(df: DataFrame, name: str = "result") -> DataFrame:
    """Nested JSON per evaluation row, with the metric details under the metric name."""
    has = lambda *cols: [F.col(c) for c in cols if c in df.columns]
    parts = has("dataset", "model", "num_samples", "aggregate_score")
    if "bleu" in df.columns:
        parts.append(F.struct(F.lit("BLEU").alias("name"), F.col("bleu").alias("score"),
                              F.struct(F.col("bp"), F.array(*has(*[f"precision_{n}" for n in range(1, 5)]))
                                       .alias("precisions")).alias("details")).alias("bleu"))
    for column, label in (("chrf_pp", "chrF++"), ("ter", "TER"), ("comet", "COMET"), ("bert_score", "BERTScore")):
        if column in df.columns:
            parts.append(F.when(F.col(column).isNotNull(),
                                F.struct(F.lit(label).alias("name"), F.col(column).alias("score")))
                         .alias(column))
    return df.select(F.to_json(F.struct(*parts)).alias(name))
