"""Registered queries over texts: scalar functions, protection, features, glossary, prompts."""

from __future__ import annotations

from pyspark.sql import functions as F

from bitloom import config
from bitloom.functions import prompts, protect
from bitloom.functions import text as tx
from bitloom.operators import augment, features, glossary, prepare_text, store
from bitloom.plans import views
from bitloom.plans.pair_queries import rounded
from bitloom.session import work_dir

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return register


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _any(text: str, values) -> str:
    return "(" + " OR ".join(f"contains({text}, '{v}')" for v in values) + ")"


_STRIP = "trim({}, ' ' || chr(10) || chr(9) || chr(13))"
_WS = "trim(regexp_replace(regexp_replace({}, ' +', ' ', 'g'), '\\n+', chr(10), 'g'), ' ' || chr(10) || chr(9) || chr(13))"
_PUNCT = r"regexp_replace(regexp_replace({}, '[–—]', '-', 'g'), '\.{{3,}}', '...', 'g')"
_WORDS = r"regexp_extract_all({}, '\S+')"


@query(f"SELECT doc_id, {_PUNCT.format(_WS.format('text'))} AS text FROM documents")
def normalize_ws_punct(spark, folder):
    text = tx.normalize_punctuation(tx.normalize_whitespace(F.col("text")))
    return views.table(spark, folder, "documents").select("doc_id", text.alias("text"))


@query(f"SELECT page_id, array_to_string({_WORDS.format('html')}, ' ') AS html FROM pages")
def collapse_whitespace(spark, folder):
    return views.table(spark, folder, "pages").select("page_id", tx.collapse_whitespace(F.col("html")).alias("html"))


@query(f"""SELECT doc_id, CASE WHEN len(w) > 50 THEN array_to_string(w[1:50], ' ') ELSE text END AS text
FROM (SELECT doc_id, text, {_WORDS.format('text')} AS w FROM documents)""")
def truncate_words(spark, folder):
    return views.table(spark, folder, "documents").select("doc_id", tx.truncate_words(F.col("text"), 50).alias("text"))


@query(f"""SELECT doc_id, trim(text, ' ' || chr(10) || chr(9) || chr(13)) <> '' AND length(text) <= 1024 AS is_valid,
  CASE WHEN trim(text, ' ' || chr(10) || chr(9) || chr(13)) = '' THEN '{config.WARN_EMPTY}' ELSE array_to_string(list_filter([
    CASE WHEN length(text) > 1024 THEN 'Input exceeds max length (' || length(text) || ' > 1024)' END,
    CASE WHEN length(regexp_replace(text, '[\\p{{L}}\\p{{N}}\\s]', '', 'g')) / length(text) > 0.5 THEN '{config.WARN_SPECIAL}' END],
    lambda x: x IS NOT NULL), '|') END AS warnings
FROM (SELECT doc_id, text FROM documents UNION ALL SELECT page_id + 1000000000, html FROM pages)""")
def validate_inputs(spark, folder):
    docs = views.table(spark, folder, "documents").select("doc_id", "text")
    pages = views.table(spark, folder, "pages").select((F.col("page_id") + 1_000_000_000).alias("doc_id"), F.col("html").alias("text"))
    checked = docs.unionByName(pages).select("doc_id", tx.validate_input(F.col("text")).alias("v"))
    return checked.select("doc_id", "v.is_valid", F.array_join("v.warnings", "|").alias("warnings"))


@query(f"""SELECT doc_id, CASE WHEN length(c) <= 1024 THEN c
  WHEN contains(left(c, 1024), ' ') AND 1024 - strpos(reverse(left(c, 1024)), ' ') > 1024 * 0.8
    THEN trim(left(c, 1024 - strpos(reverse(left(c, 1024)), ' '))) ELSE trim(left(c, 1024)) END AS text
FROM (SELECT doc_id, array_to_string({_WORDS.format('text')}, ' ') AS c FROM documents)""")
def sanitize_inputs(spark, folder):
    return views.table(spark, folder, "documents").select("doc_id", tx.sanitize_input(F.col("text")).alias("text"))


@query(views.sql(views.DECORATED) + "SELECT sample_id, replace(source, '™', 'TM') AS source FROM v_decorated")
def nfkc_text(spark, folder):
    return views.decorated(spark, folder).select("sample_id", tx.nfkc(F.col("source")).alias("source"))


@query(views.sql(views.DECORATED) + f"""
SELECT sample_id, length(source) AS length_chars, len({_WORDS.format('source')}) AS length_words,
  regexp_matches(source, '\\{{[^}}]+\\}}') AS has_placeholders, regexp_matches(source, '%[sd%]') AS has_percent_vars,
  {_any('lower(source)', config.DOMAIN_FLAG_TERMS)} AS has_technical_terms,
  {_any('source', [b for b, _ in config.BRAND_TOKENS])} AS has_brand_names,
  regexp_matches(source, '[0-9]') AS has_numbers, regexp_matches(source, 'https?://') AS has_urls,
  regexp_matches(source, '[™®©]') AS has_special_chars FROM v_decorated""")
def language_features(spark, folder):
    rows = views.decorated(spark, folder).select("sample_id", tx.language_features(F.col("source")).alias("f"))
    return rows.select("sample_id", "f.*")


@query(views.sql(views.DECORATED) + f"""
SELECT sample_id, array_to_string(list_filter({_list(sorted(config.FEATURE_TERMS))}, lambda x: contains(lower(source), x)), ',') AS terms,
  {_any('source', config.FEATURE_BRANDS)} AS has_brand FROM v_decorated""")
def tech_term_hits(spark, folder):
    hits = tx.contained_terms(F.col("source"), config.FEATURE_TERMS, lower=True)
    return views.decorated(spark, folder).select(
        "sample_id", F.array_join(hits, ",").alias("terms"),
        tx.contains_any(F.col("source"), config.FEATURE_BRANDS).alias("has_brand"))


# first occurrences become tokens: {n}, then {2} if it is another one, then %s (later {2} and %s stay)
@query(views.sql(views.DECORATED) + r"""
, p AS (SELECT *, list_distinct(regexp_extract_all(source, '\{[^}]+\}')) AS braces,
    list_distinct(regexp_extract_all(source, '%[sd%]')) AS percents FROM v_decorated)
SELECT sample_id, len(braces) + len(percents) AS n_tokens, source AS restored FROM p""")
def protect_roundtrip(spark, folder):
    held = views.decorated(spark, folder).select(
        "sample_id", protect.protect_placeholders(F.col("source")).alias("p"))
    return held.select("sample_id", F.size("p.tokens").alias("n_tokens"),
                       protect.restore(F.col("p.text"), F.col("p.tokens")).alias("restored"))


@query(views.sql(views.PAIRS) + """
SELECT sample_id, '__READY_FOR__ ' || source || ' __EXPERIENCE_HUB__ and __TURBOPOWER_TM__' AS protected,
  'Ready For ' || source || ' Experience hub and TurboPower™' AS restored FROM v_pairs""")
def brand_roundtrip(spark, folder):
    text = F.concat(F.lit("ready for "), "source", F.lit(" EXPERIENCE HUB and turbopower™"))
    held = views.pairs(spark, folder).select("sample_id", protect.protect_brands(text).alias("protected"))
    return held.select("sample_id", "protected", protect.restore_brands(F.col("protected")).alias("restored"))


def _term_fold() -> str:
    steps = [", p0 AS (SELECT sample_id, source, source AS text, [] AS terms FROM v_decorated)"]
    ordered = sorted(config.PROTECTED_TERMS, key=lambda t: (-len(t), t))
    for i, term in enumerate(ordered):
        steps.append(f""", p{i + 1} AS (SELECT sample_id, source,
  CASE WHEN contains(text, '{term}') THEN replace(text, '{term}', '__TERM_' || len(terms) || '__') ELSE text END AS text,
  CASE WHEN contains(text, '{term}') THEN list_append(terms, '{term}') ELSE terms END AS terms FROM p{i})""")
    return "\n".join(steps) + f"\nSELECT sample_id, text, array_to_string(terms, ',') AS terms, source AS restored FROM p{len(ordered)}"


@query(views.sql(views.DECORATED) + _term_fold())
def term_protect(spark, folder):
    held = views.decorated(spark, folder).select("sample_id", "source", protect.protect_terms(F.col("source")).alias("p"))
    return held.select("sample_id", F.col("p.text").alias("text"),
                       F.array_join(F.transform("p.tokens", lambda e: e["original"]), ",").alias("terms"),
                       protect.restore(F.col("p.text"), F.col("p.tokens")).alias("restored"))


def _first_replaced(text: str, found: str, token: str) -> str:
    at = f"strpos({text}, {found})"
    return f"left({text}, {at} - 1) || {token} || substr({text}, {at} + length({found}))"


def _preprocess_sql(column: str = "source", p: str = "") -> str:
    """Ordered fold over the distinct placeholders of the first and third pattern (the texts hold no
    other ones); at most two numbers and three percent forms can be distinct. ``p``: prefix of its CTEs."""
    ordered = "list_filter({0}, lambda x, i: list_position({0}, x) = i)"
    steps = [rf""", {p}n0 AS (SELECT sample_id, replace({column}, '™', 'TM') AS t FROM v_decorated)
, {p}n1 AS (SELECT *, t AS s0, regexp_extract_all(t, '\{{\d+\}}') AS a FROM {p}n0)
, {p}n2 AS (SELECT *, """ + ordered.format("a") + f" AS d FROM {p}n1)"]
    for j in (1, 2):
        steps.append(f""", {p}n{2 + j} AS (SELECT *, CASE WHEN len(d) >= {j} THEN {_first_replaced(f's{j - 1}', f'd[{j}]', f"'__PLACEHOLDER_NUM_{j - 1}__'")} ELSE s{j - 1} END AS s{j} FROM {p}n{1 + j})""")
    steps.append(f", {p}m0 AS (SELECT *, s2 AS q0, regexp_extract_all(s2, '%[sd%]') AS b FROM {p}n4)")
    steps.append(f", {p}m1 AS (SELECT *, " + ordered.format("b") + f" AS e FROM {p}m0)")
    for j in (1, 2, 3):
        token = f"'__PERCENT_' || (len(d) + {j - 1}) || '__'"
        steps.append(f""", {p}m{1 + j} AS (SELECT *, CASE WHEN len(e) >= {j} THEN {_first_replaced(f'q{j - 1}', f'e[{j}]', token)} ELSE q{j - 1} END AS q{j} FROM {p}m{j})""")
    clean = lambda c: _PUNCT.format(_WS.format(c))
    steps.append(f", {p}done AS (SELECT sample_id, {clean('q3')} AS text, {clean('t')} AS restored FROM {p}m4)")
    return "\n".join(steps) + "\n"


@query(views.sql(views.DECORATED) + _preprocess_sql() + "SELECT * FROM done")
def preprocess_full(spark, folder):
    held = views.decorated(spark, folder).select("sample_id", protect.preprocess(F.col("source")).alias("p"))
    return held.select("sample_id", "p.text", protect.postprocess(F.col("p.text"), F.col("p.tokens")).alias("restored"))


@query(views.sql(views.DECORATED) + _preprocess_sql("source", "s_") + _preprocess_sql("translation", "t_") + """
SELECT sample_id, s_done.text AS source, t_done.text AS target, d.source AS original_source,
  d.translation AS original_target, 'docs' AS origin FROM v_decorated d JOIN s_done USING (sample_id) JOIN t_done USING (sample_id)""")
def preprocessed_originals(spark, folder):
    """Preprocessed pairs; the originals are kept in the metadata, next to earlier metadata."""
    rows = views.decorated(spark, folder).withColumnRenamed("translation", "target")
    out = prepare_text.preprocess_pairs(rows.withColumn("metadata", F.create_map(F.lit("origin"), F.lit("docs"))))
    return out.select("sample_id", "source", "target", *[
        F.col("metadata")[k].alias(k) for k in ("original_source", "original_target", "origin")])


_FEATURES = rf""", f AS (SELECT *, {_WORDS.format('source')} AS sw, {_WORDS.format('translation')} AS tw,
  list_concat(regexp_extract_all(source, '\{{[^}}]+\}}'), regexp_extract_all(source, '%[sd%]')) AS ph FROM v_decorated)
, features AS (SELECT sample_id, length(source) AS source_length_chars, len(sw) AS source_length_words,
  NULL::INTEGER AS source_length_tokens,
  CASE WHEN len(sw) > 0 THEN length(array_to_string(sw, '')) / len(sw) ELSE 0 END::DOUBLE AS source_avg_word_length,
  length(translation) AS target_length_chars, len(tw) AS target_length_words, NULL::INTEGER AS target_length_tokens,
  CASE WHEN len(tw) > 0 THEN length(array_to_string(tw, '')) / len(tw) ELSE 0 END::DOUBLE AS target_avg_word_length,
  CASE WHEN len(sw) > 0 THEN len(tw) / len(sw) ELSE 1 END::DOUBLE AS length_ratio,
  len(ph) AS num_placeholders, array_to_string(list_sort(list_distinct(ph)), ',') AS placeholder_types,
  len(list_filter({_list(config.FEATURE_TERMS)}, lambda x: contains(lower(source), x))) AS num_technical_terms,
  array_to_string(list_filter({_list(sorted(config.FEATURE_TERMS))}, lambda x: contains(lower(source), x)), ',') AS technical_terms,
  {_any('source', config.FEATURE_BRANDS)} AS has_brand_names,
  len(list_distinct(regexp_extract_all(lower(source), '\S+'))) AS source_unique_words,
  len(list_distinct(regexp_extract_all(lower(translation), '\S+'))) AS target_unique_words,
  CASE WHEN len(sw) > 0 THEN len(list_distinct(regexp_extract_all(lower(source), '\S+'))) / len(sw) ELSE 0 END::DOUBLE AS lexical_diversity_source,
  CASE WHEN len(tw) > 0 THEN len(list_distinct(regexp_extract_all(lower(translation), '\S+'))) / len(tw) ELSE 0 END::DOUBLE AS lexical_diversity_target,
  regexp_matches(source, 'https?://') AS has_urls, regexp_matches(source, '[0-9]') AS has_numbers,
  regexp_matches(source, '[™®©*#]') AS has_special_punctuation FROM f)
"""


def _features(spark, folder):
    rows = views.decorated(spark, folder).withColumnRenamed("translation", "target")
    return features.extract_features(rows)


@query(views.sql(views.DECORATED) + _FEATURES + """SELECT * REPLACE (
  round(source_avg_word_length, 6) AS source_avg_word_length, round(target_avg_word_length, 6) AS target_avg_word_length,
  round(length_ratio, 6) AS length_ratio, round(lexical_diversity_source, 6) AS lexical_diversity_source,
  round(lexical_diversity_target, 6) AS lexical_diversity_target) FROM features""")
def pair_features(spark, folder):
    return rounded(features.flatten_lists(_features(spark, folder)))


def _describe(column: str) -> str:
    return f"""SELECT '{column}' AS metric, count({column}) AS count, round(avg({column}), 6) AS mean,
  round(stddev_samp({column}), 6) AS std, round(min({column})::DOUBLE, 6) AS min,
  round(quantile_cont({column}::DOUBLE, 0.25), 6) AS p25, round(quantile_cont({column}::DOUBLE, 0.5), 6) AS p50,
  round(quantile_cont({column}::DOUBLE, 0.75), 6) AS p75, round(max({column})::DOUBLE, 6) AS max FROM features"""


@query(views.sql(views.DECORATED) + _FEATURES + "\nUNION ALL ".join(map(_describe, features.NUMERIC)))
def feature_describe(spark, folder):
    return rounded(features.describe_features(_features(spark, folder)))


@query(views.sql(views.DECORATED) + _FEATURES + """SELECT
  count(*) FILTER (num_placeholders > 0) AS samples_with_placeholders,
  count(*) FILTER (num_technical_terms > 0) AS samples_with_tech_terms,
  count(*) FILTER (has_brand_names) AS samples_with_brands, count(*) FILTER (has_urls) AS samples_with_urls,
  count(*) FILTER (has_numbers) AS samples_with_numbers FROM features""")
def feature_flag_counts(spark, folder):
    return features.flag_counts(_features(spark, folder))


def _canonical(features_sql: str) -> str:
    """The rows of ``features`` as text, fields in the order of their names."""
    kinds = {"double": "coalesce(round({c}, 9)::DECIMAL(38,9)::VARCHAR, chr(30))",
             "other": "coalesce({c}::VARCHAR, chr(30))"}
    doubles = {"source_avg_word_length", "target_avg_word_length", "length_ratio", "lexical_diversity_source",
               "lexical_diversity_target"}
    parts = [kinds["double" if c in doubles else "other"].format(c=c) for c in sorted(features.NAMES)]
    return f"SELECT md5({' || chr(31) || '.join(parts)}) AS m FROM {features_sql}"


@query(views.sql(views.DECORATED) + _FEATURES + f""", j AS ({_canonical('features')})
SELECT 'decorated' AS name, count(*) AS count, sum(('0x' || substr(m, 1, 15))::BIGINT::HUGEINT)::VARCHAR || ':'
  || sum(('0x' || substr(m, 16, 15))::BIGINT::HUGEINT)::VARCHAR AS content_hash FROM j""")
def feature_store_manifest(spark, folder):
    base = store.FeatureStore(spark, work_dir(spark))
    base.store("decorated", features.flatten_lists(_features(spark, folder)))
    return base.manifest().drop("path")


@query(ORACLES["pair_features"])
def feature_store_load(spark, folder):
    """All feature columns, stored twice: the second version is the one that loads."""
    base = store.FeatureStore(spark, work_dir(spark))
    rows = features.flatten_lists(_features(spark, folder))
    base.store("decorated", rows.where("num_placeholders > 1"))
    base.store("decorated", rows)
    return rounded(base.load("decorated"))


# --- glossary ------------------------------------------------------------------------------------
# Terms for the lookups come from the texts: the most frequent words stand in for a glossary.
_FREQ = rf"""freq AS MATERIALIZED (SELECT w AS word, count(*) AS n FROM
  (SELECT unnest(regexp_extract_all(lower(text), '\S+')) AS w FROM documents) GROUP BY 1)
, terms AS MATERIALIZED (SELECT word AS term, '<' || word || '>' AS translation FROM freq WHERE n >= 20)"""


def _text_glossary(spark, folder):
    docs = views.table(spark, folder, "documents")
    return glossary.word_frequencies(docs).where("n >= 20").select(
        F.col("word").alias("term"), F.concat(F.lit("<"), "word", F.lit(">")).alias("translation"))


@query(f"""WITH {_FREQ}, o AS (SELECT doc_id, unnest(regexp_extract_all(text, '\\S+')) AS word FROM documents)
SELECT doc_id, count(*) AS n_words, count(translation) AS n_known, min(translation) AS first_translation
FROM o LEFT JOIN terms ON term = lower(word) GROUP BY 1""")
def glossary_lookup(spark, folder):
    words = glossary.word_occurrences(views.table(spark, folder, "documents"))
    found = glossary.lookup(words, _text_glossary(spark, folder), spread="doc_id")
    return found.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_words"), F.count("translation").alias("n_known"),
        F.min("translation").alias("first_translation"))


@query(f"WITH {_FREQ} SELECT word, n FROM freq ANTI JOIN terms ON word = term")
def glossary_missing(spark, folder):
    words = glossary.word_frequencies(views.table(spark, folder, "documents"))
    return glossary.unknown_words(words, _text_glossary(spark, folder))


@query(f"WITH {_FREQ} SELECT word, n FROM freq SEMI JOIN terms ON word = term")
def glossary_known(spark, folder):
    words = glossary.word_frequencies(views.table(spark, folder, "documents"))
    return glossary.known_words(words, _text_glossary(spark, folder))


@query(f"""WITH {_FREQ}, fresh AS (SELECT word AS term, 'seen ' || n AS translation FROM freq WHERE n BETWEEN 10 AND 30)
SELECT term, translation FROM terms ANTI JOIN fresh USING (term)
UNION ALL SELECT term, translation FROM fresh""")
def glossary_upsert(spark, folder):
    seen = glossary.word_frequencies(views.table(spark, folder, "documents")).where("n between 10 and 30")
    fresh = seen.select(F.col("word").alias("term"), F.concat(F.lit("seen "), F.col("n").cast("string")).alias("translation"))
    return glossary.upsert(_text_glossary(spark, folder), fresh)


_DICT = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in config.FALLBACK_WORDS.items()) + "}"


@query(f"""SELECT doc_id, array_to_string(list_transform(regexp_extract_all(lower('Settings Device ' || text || ' Battery'), '\\S+'),
  lambda w: coalesce({_DICT}[w], w)), ' ') AS text FROM documents""")
def dict_fallback(spark, folder):
    text = F.concat(F.lit("Settings Device "), "text", F.lit(" Battery"))
    return views.table(spark, folder, "documents").select("doc_id", glossary.fallback_translation(text).alias("text"))


# --- augmentation and prompts ----------------------------------------------------------------------
_SWAP = "replace(replace(replace({c}, a, '__TEMP__'), b, a), '__TEMP__', b)"


@query(views.sql(views.DECORATED) + rf"""
, m AS (SELECT sample_id, source, translation, regexp_extract_all(source, '\{{\d+\}}') AS p FROM v_decorated)
, s AS (SELECT sample_id, source, translation, p[j] AS a, p[j + 1] AS b, j
    FROM m, LATERAL (SELECT unnest(range(1, greatest(len(p), 1))) AS j))
, v AS (SELECT sample_id, 0 AS j, source, translation AS target FROM m UNION ALL
  SELECT sample_id, j, {_SWAP.format(c='source')}, {_SWAP.format(c='translation')} FROM s)
, d AS (SELECT sample_id, source, target, min(j) AS j FROM v GROUP BY ALL)
SELECT sample_id, row_number() OVER (PARTITION BY sample_id ORDER BY j) - 1 AS variation, source, target FROM d
QUALIFY variation <= 3""")
def augment_swap(spark, folder):
    rows = views.decorated(spark, folder).select("sample_id", "source", F.col("translation").alias("target"))
    return augment.augment_pairs(rows)


def _template_sql(name: str, full: bool) -> str:
    text = config.PROMPT_TEMPLATES[name]
    if not full:
        text = text.split("{target}")[0]
    quoted = "'" + text.replace("\n", "' || chr(10) || '") + "'"
    return quoted.replace("{source}", "' || source || '").replace("{target}", "' || target || '")


@query(views.sql(views.PAIRS) + "\nUNION ALL ".join(
    f"SELECT sample_id, '{n}' AS template, {_template_sql(n, True)} AS full_prompt, {_template_sql(n, False)} AS source_prompt FROM v_pairs"
    for n in config.PROMPT_TEMPLATES))
def prompts_rendered(spark, folder):
    pairs = views.pairs(spark, folder)
    rendered = F.array(*[F.struct(
        F.lit(name).alias("template"),
        prompts.render_prompt(F.col("source"), F.col("target"), name).alias("full_prompt"),
        prompts.render_prompt(F.col("source"), template=name).alias("source_prompt"))
        for name in config.PROMPT_TEMPLATES])
    return pairs.select("sample_id", F.inline(rendered))


@query(views.sql(views.PAIRS) + f"""
SELECT sample_id, template, CASE WHEN template = 'gpt2' THEN {_STRIP.format("'English: ' || source || chr(10) || 'Dutch: ' || target")}
  ELSE {_STRIP.format("target")} END AS answer FROM v_pairs, (VALUES ('llama'), ('mistral'), ('phi'), ('gpt2'), ('generic')) t(template)""")
def response_extract(spark, folder):
    """The gpt2 template names the language first, so its first marker is in the instruction."""
    rows = prompts_rendered(spark, folder)
    return rows.select("sample_id", "template", prompts.extract_response(F.col("full_prompt")).alias("answer"))
