"""Registered queries over pairs: filters, statistics, splits, readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitloom.config import CORPUS_SCRIPT_BOUNDS, FEATURE_TERMS
from bitloom.functions import text as tx
from bitloom.operators import filters, ranks, split, stats
from bitloom.plans import prepare, views
from bitloom.session import work_dir
from bitloom.sources import cascade, lines, po, sinks, tables

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Floating point columns rounded for comparison between engines."""
    return df.select(*[F.round(f.name, digits).alias(f.name) if f.dataType.typeName() in ("double", "float")
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


_COUNTED = r""", v_counted AS (
  SELECT *, len(regexp_extract_all(source, '\S+')) AS s, len(regexp_extract_all(target, '\S+')) AS t
  FROM v_pairs)"""


def _reasons(low: int, high: int) -> str:
    return _COUNTED + f""", v_judged AS (
  SELECT *, CASE WHEN s = 0 OR t = 0 THEN 'empty' WHEN s < {low} OR t < {low} THEN 'too_short'
    WHEN s > {high} OR t > {high} THEN 'too_long'
    WHEN t / s < 0.3 OR t / s > 3.0 THEN 'mismatch' END AS reject_reason
  FROM v_counted)
"""


_ROWS = "SELECT sample_id, row_idx, source, target FROM "


@query(views.sql(views.PAIRS) + _reasons(5, 200) + """
SELECT r.reject_reason, count(j.sample_id) AS n
FROM (VALUES ('empty'), ('too_short'), ('too_long'), ('mismatch')) r(reject_reason)
LEFT JOIN v_judged j USING (reject_reason) GROUP BY 1""")
def reject_reason_counts(spark, folder):
    return filters.reject_counts(filters.with_reject_reason(views.pairs(spark, folder)))


@query(views.sql(views.PAIRS) + _reasons(3, 150) + "SELECT sample_id, row_idx, reject_reason FROM v_judged")
def reject_reasons_script_bounds(spark, folder):
    judged = filters.with_reject_reason(views.pairs(spark, folder), CORPUS_SCRIPT_BOUNDS)
    return judged.select("sample_id", "row_idx", "reject_reason")


@query(views.sql(views.PAIRS) + _reasons(5, 200) + _ROWS + "v_judged WHERE reject_reason IS NULL")
def kept_pairs(spark, folder):
    return filters.kept(filters.with_reject_reason(views.pairs(spark, folder)))


@query(views.sql(views.PAIRS) + _reasons(5, 200) + """
SELECT sample_id, reject_reason FROM v_judged WHERE reject_reason IS NOT NULL""")
def rejected_pairs(spark, folder):
    return filters.rejected(filters.with_reject_reason(views.pairs(spark, folder))).select(
        "sample_id", "reject_reason")


@query("""SELECT 'b_' || item_id AS sample_id, item_id AS row_idx, trim(text, ' ' || chr(10) || chr(9)) AS source,
  trim(lower(text), ' ' || chr(10) || chr(9)) AS target FROM benchmark
WHERE trim(text, ' ' || chr(10) || chr(9)) <> '' AND trim(text, ' ' || chr(10) || chr(9)) <> trim(lower(text), ' ' || chr(10) || chr(9))
UNION ALL SELECT sample_id, row_idx, source, target FROM (
  SELECT 'conv_' || conv_id || '_' || turn AS sample_id, conv_id * 1000000000 + turn AS row_idx,
    trim(text, ' ' || chr(10) || chr(9)) AS source, trim(replace(text, 'a', 'e'), ' ' || chr(10) || chr(9)) AS target FROM conversations)
WHERE source <> '' AND target <> '' AND source <> target""")
def identical_pairs_dropped(spark, folder):
    bench = views.table(spark, folder, "benchmark").select(
        F.concat(F.lit("b_"), F.col("item_id").cast("string")).alias("sample_id"),
        F.col("item_id").alias("row_idx"), F.col("text").alias("source"), F.lower("text").alias("target"))
    turns = views.table(spark, folder, "conversations").select(
        F.concat_ws("_", F.lit("conv"), "conv_id", "turn").alias("sample_id"),
        (F.col("conv_id") * 1_000_000_000 + F.col("turn")).alias("row_idx"),
        F.col("text").alias("source"), F.replace("text", F.lit("a"), F.lit("e")).alias("target"))
    return filters.drop_identical(filters.clean_pairs(filters.union_sources(bench, turns)))


@query(views.sql(views.PAIRS) + _COUNTED + """
SELECT count(*) AS num_samples, round(avg(s), 6) AS avg_source_length, round(avg(t), 6) AS avg_target_length,
  max(s) AS max_source_length, max(t) AS max_target_length FROM v_counted""")
def dataset_length_stats(spark, folder):
    return rounded(stats.length_stats(views.pairs(spark, folder)))


@query(views.sql(views.PAIRS) + r"""
, ws AS (SELECT DISTINCT unnest(regexp_extract_all(lower(source), '\S+')) AS w FROM v_pairs)
, wt AS (SELECT DISTINCT unnest(regexp_extract_all(lower(target), '\S+')) AS w FROM v_pairs)
SELECT (SELECT count(*) FROM ws) AS vocab_size_source, (SELECT count(*) FROM wt) AS vocab_size_target""")
def vocab_size(spark, folder):
    return stats.vocab_size(views.pairs(spark, folder))


_PLACEHOLDERS = r"""list_concat(regexp_extract_all(source, '\{[^}]+\}'), regexp_extract_all(source, '%[sd%]'))"""


def _decorated_pairs(spark, folder):
    return views.decorated(spark, folder).withColumnRenamed("translation", "target")


@query(views.sql(views.DECORATED) + f"""
SELECT pattern, count(*) AS n FROM (SELECT unnest({_PLACEHOLDERS}) AS pattern FROM v_decorated) GROUP BY 1""")
def placeholder_inventory(spark, folder):
    return stats.placeholder_inventory(_decorated_pairs(spark, folder))


@query(views.sql(views.DECORATED) + r"""
SELECT DISTINCT w AS word FROM (SELECT unnest(regexp_extract_all(lower(source), '\S+')) AS w FROM v_decorated)
WHERE regexp_matches(w, 'usb|bluetooth|wifi|app|phone|display|battery') ORDER BY 1 LIMIT 50""")
def domain_terms(spark, folder):
    return stats.domain_terms(_decorated_pairs(spark, folder))


@query(views.sql(views.DECORATED) + rf"""
, c AS (SELECT *, regexp_extract_all(source, '\S+') AS sw, regexp_extract_all(translation, '\S+') AS tw FROM v_decorated)
, ws AS (SELECT DISTINCT unnest(regexp_extract_all(lower(source), '\S+')) AS w FROM c)
, wt AS (SELECT DISTINCT unnest(regexp_extract_all(lower(translation), '\S+')) AS w FROM c)
, d AS (SELECT w FROM ws WHERE regexp_matches(w, 'usb|bluetooth|wifi|app|phone|display|battery') ORDER BY w LIMIT 50)
SELECT count(*) AS num_samples, round(avg(len(sw)), 6) AS avg_source_length, round(avg(len(tw)), 6) AS avg_target_length,
  max(len(sw)) AS max_source_length, max(len(tw)) AS max_target_length,
  (SELECT count(*) FROM ws) AS vocab_size_source, (SELECT count(*) FROM wt) AS vocab_size_target,
  (SELECT count(DISTINCT p) FROM (SELECT unnest({_PLACEHOLDERS}) AS p FROM v_decorated)) AS unique_patterns,
  (SELECT string_agg(w, ',' ORDER BY w) FROM d) AS domain_terms
FROM c""")
def dataset_stats(spark, folder):
    out = rounded(stats.dataset_stats(_decorated_pairs(spark, folder)))
    return out.withColumn("domain_terms", F.array_join("domain_terms", ","))


@query(views.sql(views.PAIRS) + _reasons(5, 200) + _ROWS
       + "v_judged WHERE reject_reason IS NULL ORDER BY row_idx LIMIT 50")
def first_n_kept(spark, folder):
    return ranks.first_rows(kept_pairs(spark, folder), 50)


@query(views.sql(views.PAIRS) + """
SELECT 'user_' || row_number() OVER (ORDER BY row_idx) - 1 AS sample_id, left(source, 80) AS source, left(target, 80) AS target
FROM v_pairs ORDER BY row_idx LIMIT 20""")
def numbered_previews(spark, folder):
    """First twenty pairs, numbered, with their first 80 characters."""
    first = ranks.first_rows(views.pairs(spark, folder), 20)
    numbered = first.agg(F.array_sort(F.collect_list(F.struct("row_idx", "source", "target"))).alias("rows"))
    out = numbered.select(F.posexplode("rows").alias("row_idx", "r"))
    out = out.select("row_idx", tx.preview(F.col("r.source")).alias("source"),
                     tx.preview(F.col("r.target")).alias("target"))
    return filters.with_sample_id(out, "user_").drop("row_idx")


@query(views.sql(views.PAIRS) + """, h AS (SELECT sample_id, ('0x' || substr(md5('42:' || sample_id), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS f FROM v_pairs)
SELECT sample_id, CASE WHEN f < 0.8::DOUBLE THEN 'train' WHEN f < 0.9::DOUBLE THEN 'val' ELSE 'test' END AS split FROM h""")
def split_hash(spark, folder):
    parts = {"train": 0.8, "val": 0.1, "test": 0.1}
    return split.split_by_hash(views.pairs(spark, folder), parts).select("sample_id", "split")


_RANKED = """, r AS (SELECT sample_id, row_number() OVER (ORDER BY md5('42:' || sample_id)) - 1 AS k,
  count(*) OVER () AS n FROM v_pairs)
"""


@query(views.sql(views.PAIRS) + _RANKED + """
SELECT sample_id, CASE WHEN k < floor(n * 0.8) THEN 'train'
  WHEN k < floor(n * 0.8) + floor(n * 0.1) THEN 'val' ELSE 'test' END AS split FROM r""")
def split_exact(spark, folder):
    parts = {"train": 0.8, "val": 0.1, "test": 0.1}
    return split.split_exact(views.pairs(spark, folder), parts).select("sample_id", "split")


@query(views.sql(views.PAIRS) + _RANKED
       + "SELECT sample_id, CASE WHEN k < floor(n * 0.05) THEN 'val' ELSE 'train' END AS split FROM r")
def split_two_way(spark, folder):
    parts = {"val": 0.05, "train": 0.95}
    return split.split_exact(views.pairs(spark, folder), parts).select("sample_id", "split")


@query(views.sql(views.PAIRS) + """, r AS (SELECT sample_id, row_number() OVER (ORDER BY row_idx) - 1 AS k, count(*) OVER () AS n FROM v_pairs)
SELECT sample_id, CASE WHEN k < floor(n * 0.9) THEN 'train' ELSE 'val' END AS split FROM r""")
def split_head_tail(spark, folder):
    return split.split_head_tail(views.pairs(spark, folder)).select("sample_id", "split")


@query(views.sql(views.PAIRS, views.DECORATED) + """
SELECT sample_id, row_idx, source, target, NULL AS reference FROM v_pairs
UNION ALL SELECT sample_id, row_idx, source, translation, reference FROM v_decorated""")
def union_sources(spark, folder):
    return filters.union_sources(views.pairs(spark, folder), _decorated_pairs(spark, folder))


@query("""SELECT coalesce(l.quality::VARCHAR, '') AS source, '' AS target, d.doc_id::VARCHAR AS sample_id
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def default_fill(spark, folder):
    docs = views.table(spark, folder, "documents").select("doc_id")
    labelled = docs.join(views.table(spark, folder, "labels"), "doc_id", "left")
    rows = labelled.select(
        F.col("quality").cast("string").alias("source"), F.lit(None).cast("string").alias("target"),
        F.lit(None).cast("string").alias("sample_id"), F.col("doc_id").alias("row_idx"))
    return filters.fill_defaults(rows).drop("row_idx")


@query(views.sql(views.PAIRS) + """
SELECT source, target, 'en' AS source_lang, 'nl' AS target_lang, 'software' AS domain, 'challenge_' || row_idx AS sample_id
FROM (SELECT row_idx, trim(source, ' ' || chr(10) || chr(9)) AS source, trim(target, ' ' || chr(10) || chr(9)) AS target FROM v_pairs)
WHERE source <> '' AND target <> ''""")
def pairs_by_column_name(spark, folder):
    """Columns found by name parts, cleaned, then projected without metadata."""
    renamed = views.pairs(spark, folder).select(
        "row_idx", F.col("source").alias("English text"), F.col("target").alias("Dutch text"))
    return filters.pair_columns(tables.pairs_from_table(renamed, prefix="challenge_"))


_ONE_LINE = r"trim(regexp_replace({c}, '\s+', ' ', 'g'))"


@query(views.sql(views.PAIRS) + f"""
SELECT {_ONE_LINE.format(c='source')} AS source, {_ONE_LINE.format(c='target')} AS target FROM v_pairs""")
def positional_join(spark, folder):
    """Both sides written as text files, read back and joined on (file part, line number)."""
    base = work_dir(spark)
    rows = views.pairs(spark, folder).select(
        "row_idx", tx.collapse_whitespace(F.col("source")).alias("source"),
        tx.collapse_whitespace(F.col("target")).alias("target"))
    ordered = rows.repartition(8, "row_idx").sortWithinPartitions("row_idx")
    sides = []
    for side in ("source", "target"):
        ordered.select(side).write.text(f"{base}/{side}")
        part = F.regexp_extract("file", r"part-(\d+)", 1)
        sides.append(lines.read_lines(spark, f"{base}/{side}").withColumn("part", part))
    return lines.zip_lines(*sides, keys=("part", "line_no")).select("source", "target")


@query(views.sql(views.PAIRS) + r"""
SELECT trim(replace(source, chr(10), ' ')) AS source, trim(replace(target, chr(10), ' ')) AS target
FROM v_pairs WHERE source <> target""")
def po_entries(spark, folder):
    """Pairs written as catalogue entries and parsed again."""
    base = work_dir(spark)
    quote = lambda c: F.replace(F.replace(F.col(c), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n"))
    entry = F.concat(F.lit('#: conversation\nmsgid "'), quote("source"), F.lit('"\nmsgstr "'), quote("target"),
                     F.lit('"\n'))
    views.pairs(spark, folder).select(entry).write.text(f"{base}/po")
    return po.parse_catalogues(spark, f"{base}/po", glob="part-*").select("source", "target")


@query(views.sql(views.PAIRS) + "SELECT source, target, 'chat' AS domain, sample_id FROM v_pairs")
def jsonl_roundtrip(spark, folder):
    path = work_dir(spark)
    sinks.save_samples(views.pairs(spark, folder).withColumn("domain", F.lit("chat")), path)
    return tables.read_jsonl(spark, path)


@query(views.sql(views.PAIRS) + "SELECT source, target FROM v_pairs")
def tsv_roundtrip(spark, folder):
    path = work_dir(spark)
    sinks.save_samples(views.pairs(spark, folder), path, "tsv")
    return sinks.read_tsv(spark, path)


@query(views.sql(views.EVAL) + "SELECT sample_id AS source, reference, hypothesis FROM v_eval")
def translations_csv_roundtrip(spark, folder):
    path = work_dir(spark)
    rows = views.eval_rows(spark, folder).select(F.col("sample_id").alias("source"), "reference", "hypothesis")
    rows.write.options(header=True, escape='"', emptyValue="").csv(path)
    return tables.read_translations(spark, path).na.fill("")


@query(views.sql(views.PAIRS) + """SELECT source, target, 'en' AS source_lang, 'nl' AS target_lang,
  NULL AS domain, sample_id, 0 AS n_metadata FROM v_pairs""")
def processed_roundtrip(spark, folder):
    base = work_dir(spark)
    rows = views.pairs(spark, folder).withColumns({"source_lang": F.lit("en"), "target_lang": F.lit("nl")})
    sinks.save_processed(rows, base, "train")
    return sinks.load_processed(spark, base, "train").withColumn("n_metadata", F.size("metadata")).drop("metadata")


@query("""SELECT 'flores_' || doc_id AS sample_id, doc_id AS row_idx, text AS source, 'nl: ' || text AS target, 'general' AS domain
FROM documents
UNION ALL SELECT 'page_' || page_id, page_id, d.text, p.html, 'general' FROM documents d JOIN pages p ON d.doc_id = p.page_id""")
def benchmark_alignment(spark, folder):
    """Monolingual tables joined on the id: all documents and the documents behind a mark, and documents
    and the pages of the same number."""
    docs = views.table(spark, folder, "documents")
    side = lambda text: docs.select(F.col("doc_id").alias("id"), text.alias("sentence"))
    pages = views.table(spark, folder, "pages").select(F.col("page_id").alias("id"), F.col("html").alias("sentence"))
    marked = tables.align_benchmark(side(F.col("text")), side(F.concat(F.lit("nl: "), "text")))
    paged = tables.align_benchmark(side(F.col("text")), pages, prefix="page_")
    return marked.unionByName(paged).drop("source_lang", "target_lang")


@query(views.sql(views.PAIRS) + """SELECT sample_id, source, target, 'en' AS source_lang, 'nl' AS target_lang,
  'chat' AS domain, length(source) AS source_chars FROM v_pairs""")
def json_array_roundtrip(spark, folder):
    """Pairs written as JSON arrays with nested metadata and read back, several tasks per file."""
    path = work_dir(spark)
    rows = views.pairs(spark, folder).select(
        "source", "target", F.lit("en").alias("source_lang"), F.lit("nl").alias("target_lang"),
        F.lit("chat").alias("domain"), "sample_id",
        F.create_map(F.lit("source_chars"), F.char_length("source").cast("string")).alias("metadata"))
    sinks.save_json_array(rows, path)
    back = tables.read_json_array(spark, path)
    return back.withColumn("source_chars", F.col("metadata")["source_chars"].cast("int")).drop("metadata")


_AS_LINES = r"""'- ' || trim(regexp_replace({c}, '\s+', ' ', 'g'))"""


def _aligned_files(spark, folder, base):
    """Both sides of the pairs as text, one line per pair, under the known names."""
    line = lambda c: F.concat(F.lit("- "), tx.collapse_whitespace(F.col(c)))
    rows = prepare.stored(views.pairs(spark, folder).select("row_idx", line("source").alias("source"), line("target").alias("target"))
                          .repartition(8, "row_idx").sortWithinPartitions("row_idx"))
    for side, name in zip(("source", "target"), lines.ALIGNED_NAMES[0]):
        rows.select(side).write.text(f"{base}/{name}")


_LINE_PAIRS = views.sql(views.PAIRS) + f""", v_lines AS (
  SELECT sample_id, {_AS_LINES.format(c='source')} AS source, {_AS_LINES.format(c='target')} AS target FROM v_pairs)
"""


@query(_LINE_PAIRS + "SELECT source, target, 'software' AS domain FROM v_lines")
def aligned_folder(spark, folder):
    base = work_dir(spark)
    _aligned_files(spark, folder, base)
    return lines.read_aligned_folder(spark, base).select("source", "target", "domain")


@query(_LINE_PAIRS + """SELECT 'processed' AS origin, source, target FROM v_pairs
UNION ALL SELECT 'aligned', source, target FROM v_lines UNION ALL SELECT 'most', source, target FROM v_lines""")
def training_cascade(spark, folder):
    """The processed file wins; without one, the aligned text is read; then the same with a bound."""
    base = work_dir(spark)
    _aligned_files(spark, folder, f"{base}/raw")
    sinks.save_json_array(views.pairs(spark, folder).select("source", "target", "sample_id"), f"{base}/processed")
    found = {"processed": cascade.load_training(spark, f"{base}/raw", f"{base}/processed"),
             "aligned": cascade.load_training(spark, f"{base}/raw", f"{base}/none"),
             "most": cascade.load_training(spark, f"{base}/raw", max_samples=1 << 30)}
    parts = [rows.select(F.lit(name).alias("origin"), "source", "target") for name, rows in found.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_KEPT_LINES = _LINE_PAIRS.replace("v_lines AS", "v_lines0 AS").replace("v_pairs AS", "v_given AS").replace(
    "FROM v_pairs", "FROM v_given") + ", v_pairs AS (SELECT sample_id, 0 AS row_idx, source, target FROM v_lines0)" + _reasons(3, 150)


def _corpus_job(spark, folder):
    """Aligned files of the pairs, filtered, split and written; the output folder and the reject counts."""
    base = work_dir(spark)
    _aligned_files(spark, folder, base)
    source, target = lines.ALIGNED_NAMES[0]
    job = prepare.CorpusJob(f"{base}/{source}", f"{base}/{target}", f"{base}/out")
    return job, prepare.prepare_corpus(spark, job, test=views.pairs(spark, folder))


@query(_KEPT_LINES + """, k AS (SELECT source, target FROM v_judged WHERE reject_reason IS NULL)
SELECT 'corpus' AS part, source, target FROM k UNION ALL SELECT 'tsv', source, target FROM k
UNION ALL SELECT 'test', source, target FROM v_given""")
def prepare_corpus_job(spark, folder):
    """All rows that the job wrote: train and val (read as jsonl and as tsv) and test."""
    job, _ = _corpus_job(spark, folder)
    read = lambda part, name, rows: rows(spark, f"{job.output}/{name}").select(
        F.lit(part).alias("part"), "source", "target")
    out = read("test", "test.jsonl", tables.read_jsonl)
    for name in ("train", "val"):
        out = out.unionByName(read("corpus", f"{name}.jsonl", tables.read_jsonl)).unionByName(
            read("tsv", f"{name}.tsv", sinks.read_tsv))
    return out


@query(_KEPT_LINES + """, c AS (SELECT count(*) AS n FROM v_judged WHERE reject_reason IS NULL)
SELECT r.name, count(j.sample_id) AS n FROM (VALUES ('empty'), ('too_short'), ('too_long'), ('mismatch')) r(name)
LEFT JOIN v_judged j ON j.reject_reason = r.name GROUP BY 1
UNION ALL SELECT 'val', floor(n * 0.05)::BIGINT FROM c UNION ALL SELECT 'train', n - floor(n * 0.05)::BIGINT FROM c""")
def prepare_corpus_counts(spark, folder):
    job, rejected = _corpus_job(spark, folder)
    out = rejected.select(F.col("reject_reason").alias("name"), "n")
    for name in ("train", "val"):
        out = out.unionByName(tables.read_jsonl(spark, f"{job.output}/{name}.jsonl").agg(
            F.lit(name).alias("name"), F.count(F.lit(1)).alias("n")))
    return out


@query(views.sql(views.PAIRS) + _reasons(5, 200) + rf"""
, k AS (SELECT * FROM v_judged WHERE reject_reason IS NULL)
, c AS (SELECT count(*) AS n FROM k)
SELECT 'software/IT' AS domain, (SELECT (n * 0.9)::BIGINT - CASE WHEN (n * 0.9)::BIGINT > n * 0.9 THEN 1 ELSE 0 END FROM c) AS total_samples,
  (SELECT n - floor(n * 0.9)::BIGINT FROM c) AS val_samples, (SELECT count(*) FROM v_pairs) AS test_samples,
  (SELECT round(avg(s), 6) FROM v_counted) AS avg_source_length, (SELECT round(avg(t), 6) FROM v_counted) AS avg_target_length,
  (SELECT count(*) FROM (SELECT DISTINCT unnest(regexp_extract_all(lower(source), '\S+')) FROM v_pairs)) AS vocab_size_source,
  (SELECT count(*) FROM (SELECT DISTINCT unnest(regexp_extract_all(lower(target), '\S+')) FROM v_pairs)) AS vocab_size_target,
  (SELECT count(*) FROM v_pairs WHERE len({_PLACEHOLDERS}) > 0) AS samples_with_placeholders,
  (SELECT count(*) FROM v_pairs WHERE {" OR ".join(f"contains(lower(source), '{t}')" for t in FEATURE_TERMS)}) AS samples_with_tech_terms""")
def preparation_summary(spark, folder):
    """The whole preparation job: preprocesses, splits, featurises, stores and reports; the report is
    read back from its file."""
    base = work_dir(spark)
    out = prepare.prepare_dataset(spark, kept_pairs(spark, folder), views.pairs(spark, folder), base)
    return rounded(spark.read.schema(out.schema).json(f"{base}/data_summary"))
