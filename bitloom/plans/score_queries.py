"""Registered queries over metrics, quality estimation, post-edits, translation and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from bitloom import config
from bitloom.operators import compare, metrics, qe, translate
from bitloom.plans import views
from bitloom.plans.pair_queries import rounded
from bitloom.session import work_dir
from bitloom.sources import sinks, tables
from bitloom.sources.records import read_quoted_table
from bitloom.streaming import dedup, files, gate, monitor

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return register


# --- metric SQL ----------------------------------------------------------------------------------
def _tokens(column: str) -> str:
    line = f"replace(replace(replace({column}, '<skipped>', ''), '-' || chr(10), ''), chr(10), ' ')"
    for entity, char in (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        line = f"replace({line}, '{entity}', '{char}')"
    line = f"' ' || {line} || ' '"
    for pattern, spaced in ((r"([\{-\~\[-\x60 -\&\(-\+\:-\@\/])", r" \1 "), (r"([^0-9])([\.,])", r"\1 \2 "),
                            (r"([\.,])([^0-9])", r" \1 \2"), (r"([0-9])(-)", r"\1 \2 ")):
        line = f"regexp_replace({line}, '{pattern}', '{spaced}', 'g')"
    return rf"regexp_extract_all({line}, '\S+')"


def _edge_words(column: str) -> str:
    mark = r"[!-/:-@\[-\x60{-~]"
    return rf"""flatten(list_transform(regexp_extract_all({column}, '\S+'), lambda w: CASE
      WHEN length(w) > 1 AND regexp_matches(w, '{mark}$') THEN [left(w, length(w) - 1), right(w, 1)]
      WHEN length(w) > 1 AND regexp_matches(w, '^{mark}') THEN [left(w, 1), substr(w, 2)] ELSE [w] END))"""


def _grams(name: str, tokens: str, orders: int, glue: str, first: int = 0) -> str:
    """CTEs ``<name>_m``: per row and order (numbered from ``first``) match, hyp and ref counts."""
    ahead = ", ".join(f"lead(t, {k}) OVER w AS t{k}" for k in range(1, orders))
    sides = " UNION ALL ".join(
        f"SELECT sample_id, grp, '{s}' AS side, unnest({s}) AS t, generate_subscripts({s}, 1) AS i FROM {tokens}"
        for s in "hr")
    grams = " UNION ALL ".join(
        f"SELECT sample_id, grp, side, {first + n} AS n, {(' || ' + repr(glue) + ' || ').join(['t'] + [f't{k}' for k in range(1, n)])} AS gram FROM {name}_w"
        for n in range(1, orders + 1))
    return f""", {name}_t AS ({sides})
, {name}_w AS (SELECT *, {ahead} FROM {name}_t WINDOW w AS (PARTITION BY sample_id, side ORDER BY i))
, {name}_g AS ({grams})
, {name}_c AS (SELECT sample_id, grp, n, gram, count(*) FILTER (side = 'h') AS h, count(*) FILTER (side = 'r') AS r
  FROM {name}_g WHERE gram IS NOT NULL GROUP BY ALL)
, {name}_m AS (SELECT sample_id, grp, n, sum(least(h, r)) AS m, sum(h) AS h, sum(r) AS r FROM {name}_c GROUP BY ALL)"""


def _bleu_sql(group: str) -> str:
    return (views.sql(views.EVAL) + f""", tok AS (SELECT sample_id, {group} AS grp, {_tokens('hypothesis')} AS h, {_tokens('reference')} AS r FROM v_eval)
, len AS (SELECT sample_id, grp, len(h) AS hl, len(r) AS rl FROM tok)""" + _grams("b", "tok", 4, " "))


_CORPUS_BLEU = """, l AS (SELECT grp, sum(hl) AS hyp_len, sum(rl) AS ref_len FROM len GROUP BY 1)
, s AS (SELECT grp, n, sum(m) AS m, sum(h) AS t FROM b_m GROUP BY ALL)
, p AS (SELECT grp, n, 100.0 * m / t AS p FROM s)
SELECT {group} round(CASE WHEN hyp_len < ref_len THEN exp(1 - ref_len / hyp_len) ELSE 1 END * exp(sum(ln(p)) / 4), 6) AS bleu,
  round(CASE WHEN hyp_len < ref_len THEN exp(1 - ref_len / hyp_len) ELSE 1 END, 6) AS bp,
  round(max(p) FILTER (n = 1), 6) AS precision_1, round(max(p) FILTER (n = 2), 6) AS precision_2,
  round(max(p) FILTER (n = 3), 6) AS precision_3, round(max(p) FILTER (n = 4), 6) AS precision_4, hyp_len::BIGINT AS hyp_len, ref_len::BIGINT AS ref_len
FROM p JOIN l USING (grp) GROUP BY grp, hyp_len, ref_len"""


@query(_bleu_sql("1") + _CORPUS_BLEU.format(group=""))
def bleu_corpus(spark, folder):
    return rounded(metrics.corpus_bleu(views.eval_rows(spark, folder)))


@query(_bleu_sql("lang") + _CORPUS_BLEU.format(group="grp AS lang,"))
def bleu_by_lang(spark, folder):
    return rounded(metrics.corpus_bleu(views.eval_rows(spark, folder), ["lang"]))


@query(_bleu_sql("1") + """, o AS (SELECT sample_id, n, m, h AS t, sum(CASE WHEN m = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY sample_id ORDER BY n) AS k
  FROM b_m WHERE h > 0)
, e AS (SELECT sample_id, exp(avg(ln(CASE WHEN m = 0 THEN 100.0 / (pow(2, k) * t) ELSE 100.0 * m / t END))) AS g, sum(m) AS any_match FROM o GROUP BY 1)
SELECT sample_id, round(CASE WHEN coalesce(any_match, 0) = 0 OR hl = 0 THEN 0
  WHEN hl < rl THEN exp(1 - rl / hl) * g ELSE g END::DOUBLE, 6) AS bleu
FROM len LEFT JOIN e USING (sample_id)""")
def bleu_sentence(spark, folder):
    return rounded(metrics.sentence_bleu(views.eval_rows(spark, folder)).select("sample_id", "bleu"))


def _chrf_sql(group: str) -> str:
    return (rf""", chars AS (SELECT sample_id, {group} AS grp, CASE WHEN hypothesis <> '' THEN string_split(regexp_replace(hypothesis, '\s+', '', 'g'), '') ELSE [] END AS h,
  CASE WHEN reference <> '' THEN string_split(regexp_replace(reference, '\s+', '', 'g'), '') ELSE [] END AS r FROM v_eval)
, edge AS (SELECT sample_id, {group} AS grp, {_edge_words('hypothesis')} AS h, {_edge_words('reference')} AS r FROM v_eval)"""
            + _grams("cc", "chars", 6, "") + _grams("cw", "edge", 2, " ", first=6)
            + """, o AS (SELECT sample_id, grp, n, m, CASE WHEN r > 0 THEN h ELSE 0 END AS h, r FROM (SELECT * FROM cc_m UNION ALL SELECT * FROM cw_m))
""")


_CHRF = views.sql(views.EVAL).rstrip() + _chrf_sql("1")


def _f_score(rows: str, key: str) -> str:
    return f"""SELECT {key} round(CASE WHEN p + r > 0 THEN 500 * p * r / (4 * p + r) ELSE 0 END::DOUBLE, 6) AS chrf_pp
FROM (SELECT {key} coalesce(avg(m / h) FILTER (h > 0 AND r > 0), 0) AS p, coalesce(avg(m / r) FILTER (h > 0 AND r > 0), 0) AS r
  FROM {rows} {'GROUP BY 1' if key else ''})"""


@query(_CHRF + ", s AS (SELECT n, sum(m) AS m, sum(h) AS h, sum(r) AS r FROM o GROUP BY 1)\n" + _f_score("s", ""))
def chrf_corpus(spark, folder):
    return rounded(metrics.corpus_chrf(views.eval_rows(spark, folder)))


@query(_CHRF + _f_score("o", "sample_id,"))
def chrf_sentence(spark, folder):
    return rounded(metrics.sentence_chrf(views.eval_rows(spark, folder)).select("sample_id", "chrf_pp"))


# A hypothesis of the view is its reference without some words, so the lower bound of the edits, the
# difference in length, is met without a shift.
_TER = views.sql(views.EVAL) + r""", t AS (SELECT sample_id, lang, len(regexp_extract_all(reference, '\S+')) AS ref_len,
  len(regexp_extract_all(reference, '\S+')) - len(regexp_extract_all(hypothesis, '\S+')) AS edits FROM v_eval)
"""


@query(_TER + """SELECT lang, round(CASE WHEN sum(ref_len) > 0 THEN 100.0 * sum(edits) / sum(ref_len) ELSE 0 END::DOUBLE, 6) AS ter,
  sum(edits)::BIGINT AS edits, 0::BIGINT AS shifts, sum(ref_len)::BIGINT AS ref_len FROM t GROUP BY lang""")
def ter_corpus(spark, folder):
    return rounded(metrics.corpus_ter(views.eval_rows(spark, folder), ["lang"]))


@query(_TER + """SELECT sample_id, round(CASE WHEN ref_len > 0 THEN 100.0 * edits / ref_len ELSE 0 END::DOUBLE, 6) AS ter,
  edits::BIGINT AS ter_edits, ref_len::BIGINT AS ter_ref_len FROM t""")
def ter_sentence(spark, folder):
    return rounded(metrics.sentence_ter(views.eval_rows(spark, folder)).select(
        "sample_id", "ter", "ter_edits", "ter_ref_len"))


@query()
def ter_moved_phrases(spark, folder):
    """The third to fifth word of every reference come first in its hypothesis, so a shift is needed."""
    words = F.split("reference", " ")
    rows = views.eval_rows(spark, folder).withColumn("hypothesis", F.array_join(
        F.concat(F.slice(words, 3, 3), F.slice(words, 1, 2), F.slice(words, 6, F.greatest(F.size(words), F.lit(1)))), " "))
    return rounded(metrics.corpus_ter(rows, ["lang"]))


_ALL_METRICS = (_bleu_sql("lang") + """, l AS (SELECT grp, sum(hl) AS hyp_len, sum(rl) AS ref_len, count(*) AS num_samples FROM len GROUP BY 1)
, s AS (SELECT grp, n, sum(m) AS m, sum(h) AS t FROM b_m GROUP BY ALL)
, p AS (SELECT grp, n, 100.0 * m / t AS p FROM s)
, v_bleu AS (SELECT grp AS lang, num_samples, CASE WHEN hyp_len < ref_len THEN exp(1 - ref_len / hyp_len) ELSE 1 END * exp(sum(ln(p)) / 4) AS bleu,
  CASE WHEN hyp_len < ref_len THEN exp(1 - ref_len / hyp_len) ELSE 1 END::DOUBLE AS bp, max(p) FILTER (n = 1) AS precision_1,
  max(p) FILTER (n = 2) AS precision_2, max(p) FILTER (n = 3) AS precision_3, max(p) FILTER (n = 4) AS precision_4
  FROM p JOIN l USING (grp) GROUP BY grp, num_samples, hyp_len, ref_len)
""" + _chrf_sql("lang") + """, cs AS (SELECT grp, n, sum(m) AS m, sum(h) AS h, sum(r) AS r FROM o GROUP BY ALL)
, v_chrf AS (SELECT lang, CASE WHEN p + r > 0 THEN 500 * p * r / (4 * p + r) ELSE 0 END AS chrf_pp FROM (
  SELECT grp AS lang, coalesce(avg(m / h) FILTER (h > 0 AND r > 0), 0) AS p, coalesce(avg(m / r) FILTER (h > 0 AND r > 0), 0) AS r FROM cs GROUP BY 1))
""" + _TER.removeprefix(views.sql(views.EVAL)) + """, v_ter AS (SELECT lang, 100.0 * sum(edits) / sum(ref_len) AS ter FROM t GROUP BY lang)
""")


@query(_ALL_METRICS + ", " + views.SCORES + """
, v_neural AS (SELECT lang, avg(comet) AS comet, avg(bert_f1) AS bert_score FROM v_scores JOIN v_eval USING (sample_id) GROUP BY lang)
, m AS (SELECT * FROM v_bleu JOIN v_chrf USING (lang) JOIN v_ter USING (lang) JOIN v_neural USING (lang))
SELECT lang, num_samples, round(bleu, 6) AS bleu, round(bp, 6) AS bp, round(precision_1, 6) AS precision_1,
  round(precision_2, 6) AS precision_2, round(precision_3, 6) AS precision_3, round(precision_4, 6) AS precision_4,
  round(chrf_pp, 6) AS chrf_pp, round(ter, 6) AS ter, round(comet, 6) AS comet, round(bert_score, 6) AS bert_score,
  round(({bleu} * bleu / 100 + {chrf_pp} * chrf_pp / 100 + {ter} * greatest(0, 1 - ter / 100) + {comet} * comet
    + {bert_score} * bert_score) / ({bleu} + {chrf_pp} + {ter} + {comet} + {bert_score}), 6) AS aggregate_score
FROM m""".format(**config.AGGREGATE_WEIGHTS))
def evaluation_by_lang(spark, folder):
    return rounded(metrics.evaluate(views.with_scores(views.eval_rows(spark, folder)), ["lang"]))


@query()
def evaluation_json(spark, folder):
    """All metrics of every language as nested JSON."""
    return metrics.result_json(metrics.evaluate(views.with_scores(views.eval_rows(spark, folder)), ["lang"]))


@query(_bleu_sql("1") + """, o1 AS (SELECT sample_id, n, m, h AS t, sum(CASE WHEN m = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY sample_id ORDER BY n) AS k
  FROM b_m WHERE h > 0)
, e AS (SELECT sample_id, exp(avg(ln(CASE WHEN m = 0 THEN 100.0 / (pow(2, k) * t) ELSE 100.0 * m / t END))) AS g, sum(m) AS any_match FROM o1 GROUP BY 1)
, sb AS (SELECT sample_id, round(CASE WHEN coalesce(any_match, 0) = 0 OR hl = 0 THEN 0
  WHEN hl < rl THEN exp(1 - rl / hl) * g ELSE g END::DOUBLE, 6) AS bleu FROM len LEFT JOIN e USING (sample_id))
""" + _chrf_sql("1") + ", sc AS (" + _f_score("o", "sample_id,") + """)
SELECT sample_id, hypothesis, reference, bleu, coalesce(chrf_pp, 0) AS chrf FROM v_eval JOIN sb USING (sample_id) LEFT JOIN sc USING (sample_id)""")
def sample_scores(spark, folder):
    rows = metrics.sample_scores(views.eval_rows(spark, folder))
    return rounded(rows.select("sample_id", "hypothesis", "reference", "bleu", "chrf"))


_CHARS = views.sql(views.EVAL) + r""", tok AS (SELECT sample_id, lang AS grp,
  CASE WHEN hypothesis <> '' THEN string_split(regexp_replace(hypothesis, '\s+', '', 'g'), '') ELSE [] END AS h,
  CASE WHEN reference <> '' THEN string_split(regexp_replace(reference, '\s+', '', 'g'), '') ELSE [] END AS r FROM v_eval)
, len AS (SELECT sample_id, grp, len(h) AS hl, len(r) AS rl FROM tok)""" + _grams("b", "tok", 4, " ") + """, l AS (SELECT grp, sum(hl) AS hl, sum(rl) AS rl FROM len GROUP BY 1)
, s AS (SELECT grp, n, 100.0 * sum(m) / sum(h) AS p FROM b_m GROUP BY ALL)
"""


@query(_CHARS + """SELECT grp AS lang, round(CASE WHEN hl < rl THEN exp(1 - rl / hl) ELSE 1 END * exp(sum(ln(p)) / 4), 6) AS sp_bleu
FROM s JOIN l USING (grp) GROUP BY grp, hl, rl""")
def spm_bleu_by_lang(spark, folder):
    """BLEU over user tokens, here the characters of every word."""
    pieces = translate.tokenizer(lambda text: [c for word in text.split() for c in word])
    return rounded(metrics.spm_bleu(views.eval_rows(spark, folder), pieces, ["lang"])).drop("chrf_pp")


@query(_CHARS.replace(", s AS (SELECT grp, n, 100.0", ", sp AS (SELECT grp, n, 100.0") + ", v_bleu AS (SELECT grp AS lang, "
       "CASE WHEN hl < rl THEN exp(1 - rl / hl) ELSE 1 END * exp(sum(ln(p)) / 4) AS sp_bleu FROM sp JOIN l USING (grp) GROUP BY grp, hl, rl)\n"
       + _chrf_sql("lang") + """, cs AS (SELECT grp, n, sum(m) AS m, sum(h) AS h, sum(r) AS r FROM o GROUP BY ALL)
, v_chrf AS (SELECT lang, CASE WHEN p + r > 0 THEN 500 * p * r / (4 * p + r) ELSE 0 END AS chrf_pp FROM (
  SELECT grp AS lang, coalesce(avg(m / h) FILTER (h > 0 AND r > 0), 0) AS p, coalesce(avg(m / r) FILTER (h > 0 AND r > 0), 0) AS r FROM cs GROUP BY 1))
SELECT lang, round(sp_bleu, 6) AS sp_bleu, round(chrf_pp, 6) AS chrf_pp FROM v_bleu JOIN v_chrf USING (lang)""")
def spm_bleu(spark, folder):
    """BLEU and chrF++ over user tokens: here the characters of every word."""
    pieces = translate.tokenizer(lambda text: [c for word in text.split() for c in word])
    return rounded(metrics.spm_bleu(views.eval_rows(spark, folder), pieces, ["lang"]))


# --- comparison ------------------------------------------------------------------------------------
@query(views.sql(views.EVAL, views.SCORES) + """
SELECT count(*) FILTER (e.sample_id IS NOT NULL AND s.sample_id IS NOT NULL) AS matched,
  count(*) FILTER (s.sample_id IS NULL) AS without_reference, count(*) FILTER (e.sample_id IS NULL) AS without_hypothesis
FROM v_eval e FULL JOIN (SELECT sample_id FROM v_scores UNION ALL SELECT 'extra_' || item_id FROM benchmark) s USING (sample_id)""")
def eval_align_check(spark, folder):
    extra = views.table(spark, folder, "benchmark").select(F.concat(F.lit("extra_"), F.col("item_id").cast("string")).alias("sample_id"))
    references = views.scores(spark, folder).select("sample_id").unionByName(extra)
    return compare.alignment_report(views.eval_rows(spark, folder), references)


@query(views.sql(views.EVAL) + "SELECT e.sample_id, e.hypothesis, d.lang FROM v_eval e JOIN documents d ON e.row_idx = d.doc_id")
def aligned_rows(spark, folder):
    rows = views.eval_rows(spark, folder)
    return compare.align(rows.select("sample_id", "hypothesis"), rows.select("sample_id", "lang"))


_SYSTEMS = """, sys AS (SELECT CASE doc_id % 3 WHEN 0 THEN 'alpha' WHEN 1 THEN 'beta' ELSE 'gamma' END AS model,
  doc_id % 3 AS model_order, s.* FROM v_scores s JOIN documents ON doc_id = row_idx)
, res AS (SELECT model, model_order, avg(comet) AS comet, avg(bert_f1) AS bert_score, round(avg(comet_qe), 1) AS aggregate_score,
  100 * avg(comet_qe) AS ter FROM sys GROUP BY ALL)
, long AS (SELECT model, model_order, 'comet' AS metric, comet AS score FROM res UNION ALL SELECT model, model_order, 'bert_score', bert_score FROM res
  UNION ALL SELECT model, model_order, 'aggregate_score', aggregate_score FROM res UNION ALL SELECT model, model_order, 'ter', ter FROM res)
"""


def _systems(spark, folder):
    doc = F.col("row_idx") % 3
    model = F.when(doc == 0, "alpha").when(doc == 1, "beta").otherwise("gamma")
    rows = views.scores(spark, folder).select("*", model.alias("model"), doc.alias("model_order"))
    means = metrics.neural_system_scores(rows, ["model", "model_order"])
    return means.select("model", "model_order", "comet", F.col("bert_f1").alias("bert_score"),
                        F.round("comet_qe", 1).alias("aggregate_score"), (100 * F.col("comet_qe")).alias("ter"))


@query(views.sql(views.SCORES) + _SYSTEMS + """
SELECT metric, model AS best_model, round(score, 6) AS score FROM long
QUALIFY row_number() OVER (PARTITION BY metric ORDER BY CASE WHEN metric = 'ter' THEN -score ELSE score END DESC, model_order) = 1""")
def model_compare_best(spark, folder):
    return rounded(compare.best_models(_systems(spark, folder)))


@query(views.sql(views.SCORES) + _SYSTEMS + """
SELECT metric, round(max(score) FILTER (model = 'alpha'), 6) AS alpha, round(max(score) FILTER (model = 'beta'), 6) AS beta,
  round(max(score) FILTER (model = 'gamma'), 6) AS gamma FROM long GROUP BY 1""")
def model_compare_matrix(spark, folder):
    return rounded(compare.comparison_matrix(_systems(spark, folder), ["alpha", "beta", "gamma"]))


@query(views.sql(views.SCORES) + """
SELECT sample_id, round(CASE WHEN b IS NULL AND comet IS NULL AND f IS NULL AND t IS NULL THEN 0 ELSE
  (coalesce(b, 0) + coalesce(2 * comet, 0) + coalesce(1.5 * f, 0) + coalesce(0.5 * t, 0)) /
  (CASE WHEN b IS NULL THEN 0 ELSE 1 END + CASE WHEN comet IS NULL THEN 0 ELSE 2 END + CASE WHEN f IS NULL THEN 0 ELSE 1.5 END + CASE WHEN t IS NULL THEN 0 ELSE 0.5 END)
  END::DOUBLE, 6) AS aggregate_score
FROM (SELECT sample_id, comet_qe AS b, comet, CASE WHEN bert_f1 <> 0 THEN bert_f1 ELSE 0.25 END AS f,
  CASE WHEN comet IS NOT NULL THEN greatest(0, 1 - 2 * comet) END AS t FROM v_scores)""")
def aggregate_score(spark, folder):
    score = metrics.aggregate_score({
        "bleu": 100 * F.col("comet_qe"), "comet": F.col("comet"), "bert_score": F.col("bert_f1"),
        "ter": 200 * F.col("comet")}, bert_fallback=F.lit(0.25))
    return rounded(views.scores(spark, folder).select("sample_id", score.alias("aggregate_score")))


@query(views.sql(views.SCORES) + "SELECT round(avg(comet_qe), 6) AS comet_qe, round(avg(comet), 6) AS comet, round(avg(bert_f1), 6) AS bert_f1 FROM v_scores")
def neural_system_scores(spark, folder):
    return rounded(metrics.neural_system_scores(views.scores(spark, folder)))


@query(views.sql(views.SCORES) + "SELECT row_idx, comet FROM v_scores WHERE comet IS NOT NULL ORDER BY row_idx LIMIT 10")
def first_segment_scores(spark, folder):
    return metrics.first_segment_scores(views.scores(spark, folder), "comet")


# --- quality estimation ----------------------------------------------------------------------------
_CLASS = """CASE WHEN comet_qe IS NOT NULL THEN CASE WHEN comet_qe >= 0.8::DOUBLE THEN 'good' WHEN comet_qe >= 0.5::DOUBLE THEN 'acceptable' ELSE 'poor' END
  WHEN comet IS NOT NULL THEN CASE WHEN comet >= 0.85::DOUBLE THEN 'good' WHEN comet >= 0.7::DOUBLE THEN 'acceptable' ELSE 'poor' END
  WHEN bert_f1 IS NOT NULL THEN CASE WHEN bert_f1 >= 0.9::DOUBLE THEN 'good' WHEN bert_f1 >= 0.75::DOUBLE THEN 'acceptable' ELSE 'poor' END
  ELSE 'unknown' END"""
_ENGLISH = "[" + ", ".join(f"'{w}'" for w in config.UNTRANSLATED_WORDS) + "]"
_TERMS = "[" + ", ".join(f"'{w}'" for w in sorted(config.PRESERVED_TERMS)) + "]"

_JUDGED = rf""", q1 AS (SELECT v_decorated.*, comet_qe, comet, bert_f1, {_CLASS} AS quality_class,
    len(regexp_extract_all(source, '\S+')) AS sw, len(regexp_extract_all(translation, '\S+')) AS tw,
    list_sort(list_distinct(regexp_extract_all(source, '\{{[^}}]+\}}'))) AS sp,
    list_sort(list_distinct(regexp_extract_all(translation, '\{{[^}}]+\}}'))) AS tp,
    regexp_extract_all(lower(translation), '\S+') AS tl,
    list_distinct(regexp_extract_all(lower(reference), '\S+')) AS rl
  FROM v_decorated JOIN v_scores USING (sample_id))
, q2 AS (SELECT *, list_filter([
    CASE WHEN sw > 0 AND (tw / sw < 0.5 OR tw / sw > 2.0) THEN 'length_mismatch' END,
    CASE WHEN len(sp) > 0 AND sp <> tp THEN 'missing_placeholder' END,
    CASE WHEN len(list_filter(tl, lambda w: list_contains({_ENGLISH}, w))) >= 2 THEN 'untranslated' END,
    CASE WHEN reference <> '' AND len(list_intersect(rl, tl)) < 0.3 * len(rl) THEN 'semantic_divergence' END],
    lambda e: e IS NOT NULL) AS error_types,
    len(list_filter(range(1, len(tl)), lambda i: tl[i] = tl[i + 1])) AS repeats,
    list_filter({_TERMS}, lambda t: contains(source, t) AND NOT contains(translation, t)) AS lost,
    list_filter(sp, lambda p: NOT list_contains(tp, p)) AS missing, list_filter(tp, lambda p: NOT list_contains(sp, p)) AS extra
  FROM q1)
, q3 AS (SELECT *,
    greatest(0, least(1, list_reduce(list_transform(range(0, repeats + 1), lambda i: CASE WHEN i = 0 THEN 1.0::DOUBLE ELSE 0.1::DOUBLE END), lambda a, b: a - b)
      - CASE WHEN regexp_matches(translation, '[.!?"'']\s*$') THEN 0.0::DOUBLE ELSE 0.1::DOUBLE END
      - CASE WHEN length(translation) < 5 THEN 0.3::DOUBLE ELSE 0.0::DOUBLE END)) AS fluency,
    round(greatest(0, 1 - 0.1 * len(lost))::DOUBLE, 6) AS terminology,
    list_transform(lost, lambda t: 'Technical term ''' || t || ''' may need review') AS term_issues,
    round(greatest(0, 1 - 0.3 * len(missing) - 0.2 * len(extra))::DOUBLE, 6) AS formatting,
    list_filter([CASE WHEN len(missing) > 0 THEN 'Missing placeholders: {{''' || array_to_string(missing, ''', ''') || '''}}' END,
      CASE WHEN len(extra) > 0 THEN 'Extra placeholders: {{''' || array_to_string(extra, ''', ''') || '''}}' END], lambda x: x IS NOT NULL) AS format_issues,
    CASE WHEN comet_qe <> 0 THEN comet_qe WHEN comet <> 0 THEN comet ELSE 0.7 END::DOUBLE AS accuracy
  FROM q2)
, q4 AS (SELECT *,
    CASE WHEN fluency > 0.8::DOUBLE THEN 'minor' WHEN fluency > 0.5::DOUBLE THEN 'major' ELSE 'critical' END AS fluency_severity,
    CASE WHEN accuracy > 0.8::DOUBLE THEN 'minor' WHEN accuracy > 0.6::DOUBLE THEN 'major' ELSE 'critical' END AS accuracy_severity,
    CASE WHEN terminology > 0.9 THEN 'minor' ELSE 'major' END AS terminology_severity,
    CASE WHEN formatting > 0.9 THEN 'minor' ELSE 'critical' END AS formatting_severity,
    (fluency + accuracy + terminology + formatting) / 4 AS overall
  FROM q3)
"""
_QE = views.sql(views.DECORATED, views.SCORES) + _JUDGED


def _rows(spark, folder):
    """Decorated texts with their scores; both derive from one scan, so nothing is joined."""
    return views.with_scores(views.decorated(spark, folder))


@query(views.sql(views.SCORES) + f"SELECT sample_id, {_CLASS} AS quality_class FROM v_scores")
def quality_class(spark, folder):
    from bitloom.functions import quality as q
    return views.scores(spark, folder).select(
        "sample_id", q.quality_class(F.col("comet_qe"), F.col("comet"), F.col("bert_f1")).alias("quality_class"))


@query(views.sql(views.SCORES) + """
SELECT sample_id, round(coalesce((coalesce(comet_qe, 0) + coalesce(comet, 0) + coalesce(bert_f1, 0))
  / nullif((comet_qe IS NOT NULL)::INT + (comet IS NOT NULL)::INT + (bert_f1 IS NOT NULL)::INT, 0), 0.5)::DOUBLE, 6) AS confidence FROM v_scores""")
def confidence(spark, folder):
    from bitloom.functions import quality as q
    return rounded(views.scores(spark, folder).select(
        "sample_id", q.confidence(F.col("comet_qe"), F.col("comet"), F.col("bert_f1")).alias("confidence")))


@query(views.sql(views.SCORES) + f"""SELECT sample_id, CASE {_CLASS} WHEN 'good' THEN 1 WHEN 'acceptable' THEN 3 ELSE 4 END AS edit_effort FROM v_scores""")
def edit_effort(spark, folder):
    from bitloom.functions import quality as q
    return quality_class(spark, folder).select("sample_id", q.edit_effort(F.col("quality_class")).alias("edit_effort"))


@query(_QE + "SELECT sample_id, array_to_string(error_types, ',') AS error_types FROM q4")
def error_types(spark, folder):
    return qe.estimate_quality(_rows(spark, folder)).select("sample_id", F.array_join("error_types", ",").alias("error_types"))


@query(_QE + """, e AS (SELECT unnest(error_types) AS error_type FROM q4)
SELECT t.error_type, count(e.error_type) AS n, round(100.0 * count(e.error_type) / (SELECT count(*) FROM q4), 6) AS pct
FROM (VALUES ('length_mismatch'), ('missing_placeholder'), ('untranslated'), ('semantic_divergence')) t(error_type)
LEFT JOIN e USING (error_type) GROUP BY 1""")
def error_distribution(spark, folder):
    return rounded(qe.error_distribution(qe.estimate_quality(_rows(spark, folder))))


@query(_QE + "SELECT sample_id, repeats, round(fluency, 6) AS fluency FROM q4")
def fluency_scores(spark, folder):
    from bitloom.functions import quality as q
    return rounded(_rows(spark, folder).select(
        "sample_id", q.adjacent_repeats(F.col("translation")).alias("repeats"),
        q.fluency(F.col("translation")).alias("fluency")))


@query(_QE + "SELECT sample_id, terminology AS score, array_to_string(term_issues, '|') AS issues FROM q4")
def terminology_scores(spark, folder):
    from bitloom.functions import quality as q
    scored = _rows(spark, folder).select("sample_id", q.terminology(F.col("source"), F.col("translation")).alias("t"))
    return rounded(scored.select("sample_id", "t.score", F.array_join("t.issues", "|").alias("issues")))


@query(_QE + "SELECT sample_id, formatting AS score, array_to_string(format_issues, '|') AS issues FROM q4")
def formatting_scores(spark, folder):
    from bitloom.functions import quality as q
    scored = _rows(spark, folder).select("sample_id", q.formatting(F.col("source"), F.col("translation")).alias("f"))
    return rounded(scored.select("sample_id", "f.score", F.array_join("f.issues", "|").alias("issues")))


_SUGGEST = "list_filter([CASE WHEN quality_class = 'poor' THEN '" + config.SUGGEST_RETRANSLATE + "' END, " + ", ".join(
    [f"CASE WHEN list_contains(error_types, '{e}') THEN '{t}' END" for e, t in config.SUGGEST_BY_ERROR.items()]
    + [f"CASE WHEN {c}_severity IN ('major', 'critical') THEN '{t}' END" for c, t in config.SUGGEST_BY_CATEGORY.items()]
) + "], lambda x: x IS NOT NULL)"


@query(_QE + f"""SELECT sample_id, quality_class, array_to_string(error_types, ',') AS error_types,
  CASE quality_class WHEN 'good' THEN 1 WHEN 'acceptable' THEN 3 ELSE 4 END AS edit_effort,
  fluency_severity, accuracy_severity, terminology_severity, formatting_severity,
  array_to_string({_SUGGEST}, '|') AS suggestions, round(overall, 6) AS overall_score FROM q4""")
def feedback(spark, folder):
    out = qe.generate_feedback(_rows(spark, folder))
    severities = [F.col("categories")[c]["severity"].alias(f"{c}_severity") for c in config.SUGGEST_BY_CATEGORY]
    return rounded(out.select(
        "sample_id", "quality_class", F.array_join("error_types", ",").alias("error_types"), "edit_effort",
        *severities, F.array_join("suggestions", "|").alias("suggestions"), "overall_score"))


@query(_QE + """SELECT count(overall) AS num_samples, round(avg(overall), 8) AS mean_score, round(stddev_pop(overall), 8) AS std_score,
  round(min(overall), 8) AS min_score, round(max(overall), 8) AS max_score, round(quantile_cont(overall, 0.5), 8) AS median_score FROM q4""")
def score_summary(spark, folder):
    # eight digits: a mean of many short decimals may lie exactly between two six-digit numbers
    return rounded(qe.score_summary(qe.generate_feedback(_rows(spark, folder))), 8)


@query(views.sql(views.SCORES) + """SELECT count(*) FILTER (comet_qe > 0.8::DOUBLE) AS excellent,
  count(*) FILTER (comet_qe >= 0.6::DOUBLE AND comet_qe <= 0.8::DOUBLE) AS good,
  count(*) FILTER (comet_qe >= 0.4::DOUBLE AND comet_qe < 0.6::DOUBLE) AS needs_review,
  count(*) FILTER (comet_qe < 0.4::DOUBLE) AS poor FROM v_scores""")
def score_buckets(spark, folder):
    return qe.score_buckets(views.scores(spark, folder), "comet_qe")


@query(_QE + "SELECT round(100.0 * avg((round(overall, 9) < 0.6)::INT), 6) AS requires_post_edit_pct FROM q4")
def needs_post_edit_share(spark, folder):
    return rounded(qe.post_edit_share(qe.generate_feedback(_rows(spark, folder))))


@query(_QE + "SELECT sample_id, round(overall, 6) AS overall_score FROM q4 WHERE round(overall, 9) < 0.6 ORDER BY row_idx LIMIT 5")
def post_edit_examples(spark, folder):
    return rounded(qe.post_edit_examples(qe.generate_feedback(_rows(spark, folder))).select("sample_id", "overall_score"))


_SEVERITIES = ", ".join(f"{c}_severity" for c in config.SUGGEST_BY_CATEGORY)


@query(_QE + f"""SELECT source, translation AS hypothesis, reference, round(overall, 6) AS score, array_to_string({_SUGGEST}, '; ') AS feedback,
  CASE WHEN list_contains([{_SEVERITIES}], 'critical') THEN 'critical' WHEN list_contains([{_SEVERITIES}], 'major') THEN 'major' ELSE 'minor' END AS severity,
  CASE quality_class WHEN 'good' THEN 1 WHEN 'acceptable' THEN 3 ELSE 4 END AS edit_effort, round(overall, 9) < 0.6 AS needs_pe,
  array_to_string(error_types, ',') AS error_types FROM q4""")
def qe_report(spark, folder):
    report = rounded(qe.report_table(qe.generate_feedback(_rows(spark, folder))))
    return report.withColumn("error_types", F.array_join("error_types", ","))


@query(ORACLES["qe_report"])
def csv_report_roundtrip(spark, folder):
    """The report written as CSV with quoted fields and read back by several tasks per file."""
    path = work_dir(spark)
    report = qe_report(spark, folder)
    sinks.write_csv_report(report, path)
    return read_quoted_table(spark, path, report.schema, header=True).na.fill("")


@query(ORACLES["qe_report"])
def json_report_roundtrip(spark, folder):
    path = work_dir(spark)
    report = qe_report(spark, folder)
    sinks.write_json_report(report, path)
    return tables.read_jsonl(spark, path, report.schema)


# --- translation -----------------------------------------------------------------------------------
def _upper_or_fail(text: str) -> str:
    if text.endswith("Bluetooth") or text.endswith("__"):
        raise ValueError("no model for this text")
    return text + " ok"


@query()
def translate_guarded(spark, folder):
    """Per-row calls with retries and the word dictionary as fallback; tests recompute some rows."""
    rows = views.decorated(spark, folder).select("sample_id", "source")
    out = translate.translate_column(rows, _upper_or_fail, pause=0.0, max_length=200_000)
    return out.select("sample_id", "processed_input", "output", "warnings", "fallback_used")


@query(views.sql(views.DECORATED) + """
SELECT sample_id, replace(source, '™', 'TM') || ' ok' AS output, false AS fallback_used FROM v_decorated""")
def translate_batch(spark, folder):
    rows = views.decorated(spark, folder).select("sample_id", "source")
    out = translate.translate_column(rows, lambda texts: [t + " ok" for t in texts], mode="batch", max_length=1_000_000)
    return out.select("sample_id", "output", "fallback_used")


def _fails_on_some(texts: list[str]) -> list[str]:
    if any("thth" in t for t in texts):
        raise ValueError("no model for one of these texts")
    return [t + " ok" for t in texts]


@query(views.sql(views.DECORATED) + f"""
SELECT sample_id, contains(source, 'thth') AS fallback_used,
  CASE WHEN contains(source, 'thth') THEN '{config.FALLBACK_TEXT}' ELSE replace(source, '™', 'TM') || ' ok' END AS output
FROM v_decorated""")
def translate_batch_failing(spark, folder):
    """Texts that the function refuses get the fallback text; their neighbours are translated."""
    rows = views.decorated(spark, folder).select("sample_id", "source")
    out = translate.translate_column(rows, _fails_on_some, mode="batch", max_length=1_000_000)
    return out.select("sample_id", "fallback_used", "output")


@query(views.sql(views.EVAL) + """
SELECT sample_id, round(CASE WHEN length(reference) > 0 THEN length(hypothesis) / length(reference) ELSE 0 END::DOUBLE, 6) AS score FROM v_eval""")
def user_scorer(spark, folder):
    ratio = lambda rows: [len(h) / len(r) if r else 0.0 for h, r in rows]
    scored = translate.add_scores(views.eval_rows(spark, folder), ratio, ["hypothesis", "reference"], "score")
    return rounded(scored.select("sample_id", "score"))


@query(views.sql(views.PAIRS) + "SELECT sample_id, len(string_split(source, ' ')) AS n_tokens FROM v_pairs")
def user_token_count(spark, folder):
    count = translate.token_counter(lambda text: text.split(" "))
    return views.pairs(spark, folder).select("sample_id", count(F.col("source")).alias("n_tokens"))


# --- streams ---------------------------------------------------------------------------------------
_WINDOW = """SELECT {w} AS window_start, {w} + INTERVAL 1 HOUR AS window_end, count(*) AS n,
  round(avg(latency), 6) AS mean_latency, round(avg(is_error::INT), 6) AS error_rate,
  quantile_disc(latency, 0.5) AS latency_p50, quantile_disc(latency, 0.95) AS latency_p95, quantile_disc(latency, 0.99) AS latency_p99
FROM {rows} GROUP BY {w}"""


def _plain_time(df):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in df.columns if c.startswith("window_")})


@query(views.sql(views.REQUESTS) + _WINDOW.format(w="date_trunc('hour', ts)", rows="v_requests"))
def monitor_windows_batch(spark, folder):
    return _plain_time(rounded(monitor.window_metrics(views.as_requests(views.table(spark, folder, "events")))))


@query(views.sql(views.REQUESTS) + _WINDOW.format(w="date_trunc('hour', ts)", rows="v_requests"))
def monitor_windows_stream(spark, folder):
    """The stream is ended, so the last window comes out as well."""
    stream = views.as_requests(files.table_stream(spark, folder, "events"))
    return _plain_time(rounded(monitor.window_metrics(stream)))


@query(views.sql(views.REQUESTS) + ", s AS (SELECT *, unnest([0, 1]) AS back FROM v_requests)\n" + _WINDOW.format(
    w="time_bucket(INTERVAL 30 MINUTE, ts) - back * INTERVAL 30 MINUTE", rows="s"))
def monitor_sliding_windows(spark, folder):
    requests = views.as_requests(views.table(spark, folder, "events"))
    return _plain_time(rounded(monitor.window_metrics(requests, slide="30 minutes")))


@query(_QE + """SELECT sample_id, NOT (round(overall, 9) < 0.6 OR quality_class = 'poor') AS accepted FROM q4""")
def stream_qe_gate(spark, folder):
    base = work_dir(spark)
    docs = files.table_stream(spark, folder, "documents")
    rows = views.with_scores(views.decorate(docs))
    gate.run_gate(rows, f"{base}/accepted", f"{base}/rejected", f"{base}/state").awaitTermination()
    schema = gate.gated(rows).schema
    both = [files.read_written(spark, f"{base}/{side}", schema) for side in ("accepted", "rejected")]
    return both[0].unionByName(both[1]).select("sample_id", "accepted")


@query(views.sql(views.REQUESTS) + "SELECT DISTINCT key FROM v_requests")
def stream_dedup(spark, folder):
    """A watermark wider than the table: every key is kept once."""
    stream = views.as_requests(files.table_stream(spark, folder, "events"))
    return files.drain(dedup.drop_repeats(stream, ["key"], within="60 days").select("key"))
