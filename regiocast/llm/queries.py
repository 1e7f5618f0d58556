"""Registered queries of the operators and, where SQL can state them, their check statements."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiocast.llm.alignment import align_documents
from regiocast.llm.inner_products import top_products
from regiocast.llm.lexical_search import search_documents
from regiocast.llm.lm_scoring import score_documents
from regiocast.llm.mixing import mix_documents
from regiocast.llm.ngram_join import near_duplicates
from regiocast.llm.packing import pack_documents
from regiocast.llm.quality_classifier import classify
from regiocast.llm.quality_rules import clean_documents
from regiocast.llm.simhash import simhash_groups
from regiocast.llm.token_counts import token_counts
from regiocast.llm.token_files import read_ids, write_ids
from regiocast.llm.url_filter import judge_urls
from regiocast.session import scratch_path
from regiocast.sources.tables import Tables


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Tables(spark, sf_dir))


QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    def wrap(build):
        QUERIES[name] = Query(build, sql)
        return build
    return wrap


@register("op4_quality_rules", r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
win AS (SELECT doc_id, i, w[i:i+4] AS g FROM w, unnest(range(1, greatest(len(w) - 3, 1))) u(i)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n
  FROM win) WHERE n > 1),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM rep, unnest(range(0, 5)) u(k) GROUP BY doc_id),
f AS (SELECT doc_id, list_filter(l, lambda x:
   (regexp_matches(x, '[#*$%&|<>!?=_~^]')
    AND (2 * len(regexp_extract_all(x, '[#*$%&|<>!?=_~^]{2}'))
          >= len(regexp_extract_all(x, '[^\x20\x09-\x0D]+'))
      OR 10 * (length(x) - length(translate(x, '#*$%&|<>!?=_~^', ''))) >= 3 * length(x)))
   OR (len(list_filter(regexp_extract_all(x, '[^\x20\x09-\x0D]+'),
        lambda v: list_contains(['|', '>', '»', '·', '•'], v))) >= 3
    AND 5 * len(list_filter(regexp_extract_all(x, '[^\x20\x09-\x0D]+'),
        lambda v: list_contains(['|', '>', '»', '·', '•'], v)))
         >= len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')))
   OR (length(x) <= 300 AND regexp_matches(lower(x), 'licensed under|all rights reserved|copyright ©|terms of use|terms of service|privacy policy|cookie|enable javascript|lorem ipsum|click here|sign in|sign up|subscribe')))
  AS bad FROM w),
b AS (SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
  CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
  CAST(len(l) AS BIGINT) AS n_lines, CAST(len(bad) AS BIGINT) AS n_failed_lines,
  CAST(coalesce(list_sum(list_transform(bad,
    lambda x: len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')))), 0) AS BIGINT) AS lost_words
  FROM w LEFT JOIN r USING (doc_id) JOIN f USING (doc_id))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
 NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND lost_words <= 0.5 * n_words AS kept
FROM b""")
def op4_quality_rules(t: Tables) -> DataFrame:
    """Every document judged by line-first cleaning; the cleaned text itself is left out."""
    return clean_documents(t.documents).drop("clean_text")


MIXED = r"""
z AS (SELECT doc_id, source,
  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
 FROM documents),
s1 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM z GROUP BY source),
s2 AS (SELECT *, 3 * source_size AS cap,
  (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s1),
s3 AS (SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0) AS left_size,
  sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS left_weight FROM s2
  WINDOW b AS (ORDER BY cap / weight, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s4 AS (SELECT *, cap * left_weight >= left_size * weight AS free FROM s3),
lev AS (SELECT left_size AS ls, left_weight AS lw FROM s4 WHERE free
  ORDER BY cap / weight, source NULLS LAST LIMIT 1),
s5 AS (SELECT source, source_size, CASE WHEN free
   THEN CAST(ls * weight AS DOUBLE) / CAST(lw AS DOUBLE) ELSE CAST(cap AS DOUBLE) END AS target
  FROM s4 LEFT JOIN lev ON true),
s6 AS (SELECT *, CAST(floor(CAST(sum(CAST(floor(target) AS BIGINT)) OVER (ORDER BY source NULLS LAST) AS DOUBLE)
   / CAST(sum(CAST(floor(target) AS BIGINT)) OVER () AS DOUBLE) * 4294967296) AS BIGINT) AS to_x
  FROM s5),
s7 AS (SELECT source, source_size, target,
   coalesce(lag(to_x) OVER (ORDER BY source NULLS LAST), 0) AS from_x,
   CASE WHEN lead(1) OVER (ORDER BY source NULLS LAST) IS NULL THEN 4294967296 ELSE to_x END AS to_x
  FROM s6),
par AS (SELECT CAST(least(4096, greatest(1, floor(min(target) FILTER (target > 0) / 2000)))
   AS BIGINT) AS block, CAST(sum(source_size) AS BIGINT) AS total FROM s7),
pts AS (SELECT i AS slot, (i % 2147483648) * 2654435769 % 4294967296 AS x
  FROM par, unnest(range((total + block - 1) // block)) u(i)),
rk AS (SELECT s7.source, (source_size + block - 1) // block AS blocks,
   row_number() OVER (PARTITION BY s7.source ORDER BY slot) - 1 AS rank
  FROM pts JOIN s7 ON x >= from_x AND x < to_x, par),
tm AS (SELECT source, rank % blocks AS block_no, count(*) AS times FROM rk
  WHERE rank // blocks < 3 GROUP BY ALL),
sp AS (SELECT doc_id, source, size, CAST(sum(size) OVER (PARTITION BY source
   ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS stop
  FROM z WHERE size > 0),
cut AS (SELECT sp.*, block, unnest(range((stop - size) // block, (stop - 1) // block + 1)) AS b
  FROM sp, par),
tk AS (SELECT cut.doc_id, cut.source, size, stop, CAST(sum(coalesce(times, 0)
   * (least(stop, (b + 1) * block) - greatest(stop - size, b * block))) AS BIGINT) AS taken
  FROM cut LEFT JOIN tm ON cut.source IS NOT DISTINCT FROM tm.source AND b = block_no GROUP BY ALL),
mixed AS (SELECT doc_id, source, size, taken FROM tk
  UNION ALL SELECT doc_id, source, size, 0 FROM z WHERE size = 0)"""


@register("op6_mixing", "WITH" + MIXED + """
SELECT doc_id, size, source_size, target, taken
FROM mixed JOIN s7 ON mixed.source IS NOT DISTINCT FROM s7.source""")
def op6_mixing(t: Tables) -> DataFrame:
    """Words that a mix of the whole table's size takes from every document."""
    return mix_documents(t.documents)


RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"),
         ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


@register("op8_url_filter", r"""
WITH p AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0
   THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
   'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM p),
r(verdict, host, path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
m AS (SELECT page_id, r.host || r.path AS rule, verdict, row_number() OVER (
   PARTITION BY page_id ORDER BY length(r.host) + length(r.path) DESC, length(r.host) DESC) AS k
  FROM u JOIN r ON (u.host = r.host OR ends_with(u.host, '.' || r.host))
   AND starts_with(u.path, r.path))
SELECT u.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM u LEFT JOIN m ON u.page_id = m.page_id AND k = 1""")
def op8_url_filter(t: Tables) -> DataFrame:
    """Every page's url against five fixed rules."""
    return judge_urls(t.pages, RULES)


@register("op1_packing")
def op1_packing(t: Tables) -> DataFrame:
    """All documents packed into sequences of at most 1024 ids."""
    return pack_documents(t.documents, public_tokenizers.path("byte_bpe_50k.json"),
                          keep_words=1_200_000)


@register("op10_inner_products", """
WITH v AS (SELECT vec_id, list_transform(embedding,
   lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL
   AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(
   list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q, v c WHERE q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (SELECT *,
  row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5""")
def op10_inner_products(t: Tables) -> DataFrame:
    """The five highest inner products of every fiftieth vector with all the others."""
    return top_products(t.embeddings, F.col("vec_id") % 50 == 0)


@register("op5_quality_classifier")
def op5_quality_classifier(t: Tables) -> DataFrame:
    """Every document's probability of being good, by compression."""
    return classify(t.documents, t.labels)


@register("op3_ngram_jaccard_join")
def op3_ngram_jaccard_join(t: Tables) -> DataFrame:
    """Components of all documents that share four fifths of their five-word shingles."""
    return near_duplicates(t.documents)


@register("op2_token_counts")
def op2_token_counts(t: Tables) -> DataFrame:
    """Tokens of every line of every document, counted on the whole documents' ids."""
    return token_counts(t.documents, public_tokenizers.path("byte_bpe_50k.json"))


@register("op9_lm_scoring")
def op9_lm_scoring(t: Tables) -> DataFrame:
    """Every document under an attention model and a word unigram model."""
    return score_documents(t.documents, public_tokenizers.path("word_bpe_49k.json"))


@register("op7_token_files")
def op7_token_files(t: Tables) -> DataFrame:
    """All documents' ids written to coded files in doc_id order and read back from them."""
    path = scratch_path(t.spark, "token-files")
    write_ids(t.documents, path, public_tokenizers.path("word_bpe_49k.json"))
    return read_ids(t.spark, path)


@register("op11_lexical_search", r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text,
   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
d AS (SELECT r, doc_id, ts, CAST(len(ts) AS BIGINT) AS n FROM t WHERE len(ts) > 0),
s AS (SELECT CAST(count(*) AS BIGINT) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM d),
p AS (SELECT r, term, CAST(count(*) AS BIGINT) AS tf
  FROM (SELECT r, unnest(ts) AS term FROM d) GROUP BY r, term),
f AS (SELECT term, count(*) AS df FROM p GROUP BY term),
q AS (SELECT i, item_id, term, CAST(count(*) AS BIGINT) AS c FROM (
  SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(translate(text,
   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY i, item_id, term),
w AS (SELECT i, item_id, term, c * CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE)
   / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS wc FROM q JOIN f USING (term), s),
x AS (SELECT i, item_id, p.r, d.doc_id, CAST(sum(wc * ((1000000000 * tf)
   // (1000 * tf + 8 * (25 + (75 * n * nn) // ll)))) AS BIGINT) AS score
  FROM w JOIN p USING (term) JOIN d USING (r), s GROUP BY i, item_id, p.r, d.doc_id),
y AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM x WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM y WHERE rank <= 10""")
def op11_lexical_search(t: Tables) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return search_documents(t.documents, t.benchmark)


@register("op12_simhash")
def op12_simhash(t: Tables) -> DataFrame:
    """Components of all documents whose fingerprints differ in three bits or fewer."""
    return simhash_groups(t.documents)


@register("op13_alignment")
def op13_alignment(t: Tables) -> DataFrame:
    """Every document's tokens under two vocabularies, cut into groups of common ends."""
    return align_documents(t.documents, public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"))
