"""Registered queries of the corpus operators and their SQL."""

from __future__ import annotations

import public_tokenizers

from bitloom.llm import (
    bpe,
    collocations,
    exact,
    html_text,
    packing,
    quality,
    secret_scan,
    sharding,
    shingle_join,
    spelling,
    spotsigs,
    suffix_dedup,
    url_filter,
)
from bitloom.llm.common import table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return register


@query(r"""
WITH parsed AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^(?s:.)*?://([^/?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^(?s:.)*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
rules(verdict, rhost, rpath) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fits AS (
  SELECT page_id, max_by(rhost || rpath, length(rhost || rpath)) AS rule,
         max_by(verdict, length(rhost || rpath)) AS verdict
  FROM parsed JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id)
SELECT page_id, host, path, rule,
  coalesce(verdict, CASE WHEN regexp_matches(host, '(^|\.)(adult-|ads-|casino-|cheap-pills|free-bets|spam-)')
                         THEN 'block' ELSE 'allow' END) AS verdict
FROM parsed LEFT JOIN fits USING (page_id)""")
def op8_url_filter(spark, folder):
    return url_filter.judge(table(spark, folder, "pages"))


@query("""
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
FROM d JOIN g USING (text_sha256)""")
def op9_exact_dedup(spark, folder):
    return exact.report(table(spark, folder, "documents"))


@query()
def op10_secret_scan(spark, folder):
    return secret_scan.report(table(spark, folder, "documents"))


@query()
def op5_byte_bpe(spark, folder):
    return bpe.report(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                      public_tokenizers.PATTERN)


@query()
def op1_packing(spark, folder):
    return packing.packed(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query()
def op3_spotsigs(spark, folder):
    return spotsigs.report(table(spark, folder, "documents"))


@query()
def op4_html_text(spark, folder):
    return html_text.extract(table(spark, folder, "pages"))


@query()
def op6_shingle_join(spark, folder):
    return shingle_join.classes(table(spark, folder, "documents"))


@query()
def op7_quality(spark, folder):
    return quality.report(table(spark, folder, "documents"))


@query()
def op2_suffix_dedup(spark, folder):
    return suffix_dedup.report(table(spark, folder, "documents"))


_CRC32 = """(SELECT list(list_reduce(list_prepend(i, range(8)),
  lambda c, b: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY i) FROM range(256) AS t(i))"""


def _crc32(text: str) -> str:
    """CRC-32 of a text's bytes, by the table that follows from its polynomial."""
    return f"""xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode({text})), '..'),
      lambda h: ('0x' || h)::BIGINT)), lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])), 4294967295)"""


@query(rf"""
WITH cut AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
pieces AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda w: w <> '') AS w FROM cut),
grams AS (
  SELECT lang, words, unnest(list_transform(range(1, len(w) - words + 2),
    lambda i: array_to_string(w[i:i + words - 1], ' '))) AS phrase
  FROM pieces, range(1, 6) AS t(words)),
f AS (SELECT lang, words, phrase, count(*)::HUGEINT AS n FROM grams GROUP BY ALL),
total AS (SELECT lang, sum(n)::HUGEINT AS n FROM f WHERE words = 1 GROUP BY lang),
often AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE n >= 100),
cuts AS (
  SELECT lang, phrase, n AS a, k, array_to_string(w[1:k], ' ') AS p, array_to_string(w[k + 1:], ' ') AS q
  FROM (SELECT *, unnest(range(1, words)) AS k FROM often WHERE words > 1)),
scored AS (
  SELECT c.lang, c.phrase, a, x.n AS l, y.n AS r, t.n AS n, 1000 * a * t.n // (x.n * y.n) AS score, k
  FROM cuts c JOIN often x ON c.lang = x.lang AND p = x.phrase JOIN often y ON c.lang = y.lang AND q = y.phrase
  JOIN total t ON c.lang = t.lang),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, array_to_string(w[i:j], ' ') AS phrase, max(n) AS longer
  FROM often, range(1, 6) AS s(i), range(1, 6) AS e(j) WHERE words > 2 AND i < j AND j <= words AND j - i + 1 < words
  GROUP BY ALL),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
  FROM lowest LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000""")
def op11_collocations(spark, folder):
    return collocations.report(table(spark, folder, "documents"))


@query(rf"""
WITH runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
crc AS (SELECT {_CRC32} AS crc_table),
marked AS (SELECT run, times, {_crc32("id || ':' || run")} AS h
  FROM (SELECT id, run, count(*) AS times FROM runs GROUP BY ALL), crc),
v AS MATERIALIZED (
  SELECT word, sum(times)::BIGINT AS n FROM (SELECT times, CASE WHEN h % 97 = 0
    THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM marked)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
holes AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM holes a JOIN holes b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT v.word, h.word, h.n FROM v JOIN holes h ON v.word = h.rest
  UNION SELECT h.word, v.word, v.n FROM v JOIN holes h ON v.word = h.rest),
best AS (SELECT word, count(*) AS n_near, min((-near_n, near)) AS best FROM pairs GROUP BY word),
formed AS MATERIALIZED (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best[1] >= 2 * v.n THEN best[2] END AS form,
         CASE WHEN -best[1] >= 2 * v.n THEN -best[1] END AS form_n
  FROM v LEFT JOIN best USING (word)),
chain AS (
  WITH RECURSIVE c AS (SELECT word, word AS last FROM formed
    UNION SELECT c.word, f.form FROM c JOIN formed f ON f.word = c.last WHERE f.form IS NOT NULL)
  SELECT c.word, c.last AS root FROM c JOIN formed f ON f.word = c.last WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n::BIGINT AS form_n FROM formed JOIN chain USING (word)""")
def op12_spelling(spark, folder):
    return spelling.report(table(spark, folder, "documents"))


def _hash(*parts: str) -> str:
    return f"""('0x' || substr(md5(concat_ws(chr(31), {', '.join(parts)})), 1, 15))::BIGINT"""


@query(rf"""
WITH crc AS (SELECT {_CRC32} AS crc_table),
sized AS MATERIALIZED (SELECT doc_id, source, strlen(coalesce(text, '')) + 1 AS size, {_crc32("coalesce(text, '')")} AS text_crc32
  FROM documents, crc),
mixed AS (SELECT *, coalesce('=' || source, '') AS stratum,
  {_hash("'1'", "coalesce(doc_id::VARCHAR, chr(30))", "text_crc32::VARCHAR")} AS mix FROM sized),
placed AS (
  SELECT *, (row_number() OVER (PARTITION BY stratum ORDER BY mix, doc_id NULLS FIRST, text_crc32) - 1
    + {_hash("'1'", "stratum")} / pow(2, 60)) / count(*) OVER (PARTITION BY stratum) AS place FROM mixed),
ordered AS (SELECT *, row_number() OVER (ORDER BY place, mix, stratum, doc_id NULLS FIRST, text_crc32) - 1 AS pos,
  count(*) OVER () AS total FROM placed)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, (pos * 8 // total)::INT AS shard,
  (pos - (pos * 8 // total * total + 7) // 8)::BIGINT AS slot, NULL::INT AS grown_shard, source
FROM ordered""")
def op13_sharding(spark, folder):
    return sharding.report(table(spark, folder, "documents"))
