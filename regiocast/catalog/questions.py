"""Routing, search, citations and answer parsing."""

from pyspark.sql import functions as F

from regiocast.catalog.registry import register
from regiocast.plans import questions as qs
from regiocast.plans import retrieval as rt
from regiocast.plans import search_index as si
from regiocast.plans import semantic
from regiocast.session import scratch_path

CATEGORIES = [
    qs.Category("allocation", "next_forecast", ("the", "der", "la")),
    qs.Category("comparison", "total_sales", ("of", "und", "de"), needs_region=False),
    qs.Category("trend", "total_sales", ("and", "die", "le")),
    qs.Category("forecast", "next_forecast", ("that", "das", "et")),
    qs.Category("accuracy", "mean_error_pct", ("is", "ist", "que")),
    qs.Category("property", "avg_sale_price", ("in", "den", "el")),
    qs.Category("population", "net_move", ("to", "von", "en")),
]
_TERMS = ", ".join(f"('{w}','{c.name}','{c.metric}',{i})"
                   for i, c in enumerate(CATEGORIES) for w in c.terms)
ROUTED = rf"""
 SELECT q.conv_id, q.turn, coalesce(category, 'none') AS category, metric,
  CAST(coalesce(hits, 0) AS INTEGER) AS hits
 FROM (SELECT * FROM conversations WHERE role = 'user') q LEFT JOIN (
  SELECT conv_id, turn, category, metric, hits FROM (
   SELECT conv_id, turn, category, metric, pos, count(*) AS hits FROM (
     SELECT conv_id, turn, unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS w
     FROM conversations WHERE role = 'user')
   JOIN (VALUES {_TERMS}) s(term, category, metric, pos) ON w = term GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY hits DESC, pos) = 1) b
 ON b.conv_id = q.conv_id AND b.turn = q.turn"""


def asked(t):
    return t.conversations.filter(F.col("role") == "user").select("conv_id", "turn", "text")


@register("question_routing", "N1", ROUTED)
def question_routing(t):
    return qs.route(asked(t), "text", CATEGORIES).drop("text")


PHRASES = semantic.synonym_rows()
METRIC_CATEGORIES = [qs.Category(m.comment, name, (name, *m.synonyms))
                     for name, m in semantic.METRICS.items()]
_SYNONYMS = ", ".join(f"('{term}','{c.name}','{c.metric}',{i})"
                      for i, c in enumerate(METRIC_CATEGORIES) for term in c.terms)
_LIST = ", ".join(f"'{term}'" for term, _ in PHRASES)


@register("synonym_routing", "N1", rf"""
 WITH q AS (SELECT conv_id, turn, text || ' ' || ([{_LIST}])[CAST(turn % {len(PHRASES)} AS INTEGER) + 1]
   || '? ' || ([{_LIST}])[CAST(length(text) % {len(PHRASES)} AS INTEGER) + 1] AS text
  FROM conversations WHERE role = 'user'),
 f AS (SELECT conv_id, turn, list_transform(regexp_extract_all(' ' || array_to_string(
   regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+'), '  ') || ' ',
   '{qs.phrase_pattern([p for p, _ in PHRASES])}', 1), lambda p: replace(p, '  ', ' ')) AS phrases FROM q),
 h AS (SELECT conv_id, turn, category, metric, pos, count(*) AS hits
  FROM (SELECT conv_id, turn, unnest(phrases) AS term FROM f)
  JOIN (VALUES {_SYNONYMS}) s(term, category, metric, pos) USING (term) GROUP BY ALL)
 SELECT f.conv_id, f.turn, array_to_string(phrases, '|') AS phrases, coalesce(category, 'none') AS category,
  metric, CAST(coalesce(hits, 0) AS INTEGER) AS hits
 FROM f LEFT JOIN (SELECT * FROM h QUALIFY row_number() OVER (
   PARTITION BY conv_id, turn ORDER BY hits DESC, pos) = 1) b
 ON b.conv_id = f.conv_id AND b.turn = f.turn""")
def synonym_routing(t):
    """User turns followed by two terms of the metric catalogue, some of several words."""
    terms = F.array(*[F.lit(p) for p, _ in PHRASES])
    asking = asked(t).withColumn("text", F.concat(
        "text", F.lit(" "), F.get(terms, (F.col("turn") % len(PHRASES)).cast("int")), F.lit("? "),
        F.get(terms, F.length("text") % len(PHRASES))))
    return qs.route_phrases(asking, "text", METRIC_CATEGORIES).withColumn(
        "phrases", F.array_join("phrases", "|")).drop("text")


@register("scope_rule", "N2", rf"""
 SELECT r.conv_id, r.turn, category, n.conv_id IS NOT NULL AS names_region,
  n.conv_id IS NULL AND category <> 'comparison' AS needs_clarification
 FROM ({ROUTED}) r LEFT JOIN (SELECT DISTINCT conv_id, turn FROM (
   SELECT conv_id, turn, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+')) AS w
   FROM conversations WHERE role = 'user') JOIN nation ON w = lower(n_name)) n
 ON n.conv_id = r.conv_id AND n.turn = r.turn""")
def scope_rule(t):
    routed = qs.route(asked(t), "text", CATEGORIES)
    regions = t.nation.select(F.col("n_name").alias("region"))
    return qs.scope_rule(routed, "text", regions, ["conv_id", "turn"], CATEGORIES).select(
        "conv_id", "turn", "category", "names_region", "needs_clarification")


SEARCHES = [
    rt.SearchQuery("policy", "the license of thanedble"),
    rt.SearchQuery("refund_en", "attion retion that", {"lang": "en"}),
    rt.SearchQuery("richtlinie", "der die und ist", {"lang": "de"}),
    rt.SearchQuery("una_fuente", "la que el", {"source": "src7"}),
]
_Q = ", ".join(f"('{q.query_id}','{w}')" for q in SEARCHES for w in q.terms)
SEARCH = rf"""
 WITH d AS (SELECT doc_id, lang, source, regexp_extract_all(lower(text), '\p{{L}}+') AS w
   FROM documents),
 s AS (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(len(w)) AS DOUBLE) AS dl FROM d),
 q AS (SELECT * FROM (VALUES {_Q}) v(query_id, term)),
 tf AS (SELECT doc_id, lang, source, dl, term, count(*) AS tf FROM (
   SELECT doc_id, lang, source, CAST(len(w) AS DOUBLE) AS dl, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL),
 df AS (SELECT term, CAST(count(*) AS DOUBLE) AS df FROM tf GROUP BY 1),
 scored AS (SELECT query_id, doc_id, lang, source, sum(CAST(
   ln(1 + (n - df + 0.5) / (df + 0.5)) * CAST(tf AS DOUBLE) * 2.2::DOUBLE
    / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * tf.dl / (s.dl / n)))
   AS DECIMAL(20,8))) AS s
  FROM tf JOIN q USING (term) JOIN df USING (term), s GROUP BY ALL)
 SELECT query_id, doc_id, CAST(s AS DOUBLE) AS score,
  CAST(row_number() OVER (PARTITION BY query_id ORDER BY s DESC, doc_id) AS INTEGER) AS rank
 FROM scored WHERE CASE query_id WHEN 'refund_en' THEN lang = 'en'
  WHEN 'richtlinie' THEN lang = 'de' WHEN 'una_fuente' THEN source = 'src7' ELSE true END
 QUALIFY rank <= %d"""


@register("document_search", "N3", SEARCH % 20)
def document_search(t):
    return rt.keyword_search(t.documents, SEARCHES, 20)


@register("indexed_search", "N3", SEARCH % 20)
def indexed_search(t):
    """The same searches from stored posting lists."""
    index = si.build_index(t.documents, scratch_path(t.spark, "search-index"))
    return si.search_index(t.spark, index, SEARCHES, 20)


@register("vector_search", "N4", """
 WITH c AS (SELECT label, list(x ORDER BY i) AS q FROM (
   SELECT label, i, CAST(sum(CAST(CAST(x AS DOUBLE) AS DECIMAL(18,9))) AS DOUBLE) / count(x)
    AS x FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i
    FROM embeddings) GROUP BY 1, 2) GROUP BY 1)
 SELECT c.label AS query_id, vec_id,
  round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), q), 6) AS score,
  CAST(row_number() OVER (PARTITION BY c.label ORDER BY
   list_cosine_similarity(CAST(embedding AS DOUBLE[]), q) DESC, vec_id) AS INTEGER) AS rank FROM embeddings, c QUALIFY rank <= 10""")
def vector_search(t):
    """Nearest vectors to the mean vector of every label."""
    queries = rt.centroids(t.embeddings, "label", "embedding")
    found = rt.vector_search(t.embeddings, "vec_id", "embedding", queries, 10)
    return found.withColumn("score", F.round("score", 6))


@register("citations", "N5 G12", f"""
 SELECT query_id, rank, h.doc_id, source, left(text, 300) AS snippet FROM ({SEARCH % 3}) h
 JOIN documents d ON d.doc_id = h.doc_id""")
def citations(t):
    """Three documents per query, each with the first 300 characters of its text."""
    return rt.citations(t.documents, SEARCHES).select("query_id", F.inline("citations"))


@register("answer_parsing", "N6 S16", """
 SELECT conv_id, turn, role = 'user' AS parsed, CASE WHEN role = 'user' THEN text
   ELSE trim(text) END AS answer,
  CASE WHEN role = 'user' THEN 'region ' || turn ELSE '-' END AS recommended_region,
  CASE WHEN role = 'user' THEN turn * 2.5::DOUBLE END AS allocation_pct,
  CASE WHEN role = 'user' THEN '["sales","moves"]' ELSE '[]' END AS drivers,
  CASE WHEN role = 'user' THEN 'low' ELSE '' END AS risk, '' AS next_action
 FROM conversations""")
def answer_parsing(t):
    """User turns wrapped as JSON inside prose, all other turns as plain text."""
    wrapped = F.concat(F.lit("Here it is:\n"), F.to_json(F.struct(
        F.col("text").alias("answer"),
        F.concat(F.lit("region "), F.col("turn").cast("string")).alias("recommended_region"),
        (F.col("turn") * F.lit(2.5)).alias("allocation_pct"),
        F.array(F.lit("sales"), F.lit("moves")).alias("drivers"), F.lit("low").alias("risk"))),
        F.lit("\nDone."))
    raw = t.conversations.select("conv_id", "turn", F.when(
        F.col("role") == "user", wrapped).otherwise(F.col("text")).alias("raw"))
    return qs.parse_answers(raw, "raw").drop("raw").withColumn("drivers", F.to_json("drivers"))
