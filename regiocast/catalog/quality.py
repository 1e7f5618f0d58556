"""Data-quality queries."""

from pyspark.sql import functions as F

from regiocast.catalog.oracle import sql
from regiocast.catalog.registry import register
from regiocast.operators.spine import dense_months
from regiocast.plans import mart, quality as q, staging


def dense(t):
    regions = t.nation.select(F.col("n_name").alias("region")).distinct()
    return dense_months(regions, t.orders, "o_orderdate").select("ym", "region")


@register("grain_report", "Q2 G15", sql("act_orders months", """
 SELECT row_count, key_count, expected, expected - key_count AS missing,
  row_count = expected AS complete
 FROM (SELECT count(*) AS row_count, count(DISTINCT (ym, region)) AS key_count
   FROM act_orders), (SELECT count(*) AS expected FROM months CROSS JOIN nation)"""))
def grain_report(t):
    return q.grain_report(staging.customer_activity(t, with_lines=False), dense(t), mart.KEY)


@register("missing_cells", "Q2 C9", sql("act_orders months", """
 SELECT m.ym, n_name AS region FROM months m CROSS JOIN nation
 WHERE NOT EXISTS (SELECT 1 FROM act_orders a WHERE a.ym = m.ym AND a.region = n_name)"""))
def missing_cells(t):
    return q.missing_cells(dense(t), staging.customer_activity(t, with_lines=False), mart.KEY)


@register("duplicate_keys", "Q3", """
 SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2
 HAVING count(*) > 1""")
def duplicate_keys(t):
    return q.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@register("mart_duplicate_keys", "Q3", sql("mart1", """
 SELECT ym, region, count(*) AS n FROM mart1 GROUP BY 1, 2 HAVING count(*) > 1"""))
def mart_duplicate_keys(t):
    return q.duplicate_keys(mart.base_mart(t), mart.KEY)


@register("orphan_keys", "Q4 C10", """
 SELECT doc_id, count(*) AS n FROM documents
 WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY 1""")
def orphan_keys(t):
    """Documents without a label row."""
    return q.orphans(t.documents, "doc_id", t.labels, "doc_id")


@register("customer_orphans", "Q4 C10", """
 SELECT o_custkey AS c_custkey, count(*) AS n FROM orders
 WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) GROUP BY 1""")
def customer_orphans(t):
    return q.orphans(t.orders, "o_custkey", t.customer, "c_custkey")


COVERED = [c for c in mart.SIGNAL_COLUMNS]


@register("feature_coverage", "Q5 G6", sql("mart3", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS total_rows, count({c}) AS non_null,"
    f" count({c}) * 100.0::DOUBLE / count(*) AS pct FROM mart3" for c in COVERED)))
def feature_coverage(t):
    return q.coverage(mart.signal_mart(t), COVERED)


@register("scale_check", "Q6", sql("mart2", """
 SELECT column_name, declared_min, declared_max, observed_min, observed_max,
  observed_min >= declared_min AND observed_max <= declared_max AS in_range FROM (
  SELECT 'age_20_39_share' AS column_name, 0.0::DOUBLE AS declared_min, 1.0::DOUBLE AS declared_max,
   min(age_20_39_share) AS observed_min, max(age_20_39_share) AS observed_max FROM mart2
  UNION ALL SELECT 'senior_60p_share', 0, 1, min(senior_60p_share), max(senior_60p_share)
   FROM mart2
  UNION ALL SELECT 'stability_score', 0, 100, min(stability_score), max(stability_score)
   FROM mart2
  UNION ALL SELECT 'tourism_demand_idx', 50, 200, min(tourism_demand_idx),
   max(tourism_demand_idx) FROM mart2)"""))
def scale_check(t):
    return q.scale_check(mart.extended_mart(t), {
        "age_20_39_share": (0, 1), "senior_60p_share": (0, 1), "stability_score": (0, 100),
        "tourism_demand_idx": (50, 200)})


TERMS = ["license", "password", "copyright", "secret", "confidential", "lorem ipsum"]


@register("forbidden_terms", "Q7", """
 SELECT term, count(doc_id) AS documents
 FROM (SELECT unnest(['license','password','copyright','secret','confidential','lorem ipsum'])
  AS term) LEFT JOIN documents ON contains(lower(text), term) GROUP BY 1""")
def forbidden_terms(t):
    return q.forbidden_terms(t.documents, "text", TERMS)


LINKS = r"""
 SELECT regexp_replace(regexp_replace(CASE WHEN regexp_matches(href, '^https?://') THEN href
   WHEN href LIKE '/%' THEN origin || href END, '[?#].*$', ''), '/$', '') AS target,
  count(*) AS links FROM (
  SELECT regexp_extract(url, '^(https?://[^/?#]+)', 1) AS origin,
   unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS href FROM pages)
 WHERE href LIKE '/%' OR regexp_matches(href, '^https?://') GROUP BY 1"""


@register("link_targets", "Q8", LINKS)
def link_targets(t):
    return q.link_targets(t.pages)


@register("broken_links", "Q8", f"""SELECT * FROM ({LINKS}) WHERE target NOT IN (
 SELECT regexp_replace(regexp_replace(url, '[?#].*$', ''), '/$', '') FROM pages)""")
def broken_links(t):
    return q.broken_links(t.pages)


RULES = [("documents", "text", 40), ("documents", "lang", 2), ("documents", "source", 4),
         ("pages", "url", 10), ("pages", "html", 200), ("conversations", "text", 20),
         ("conversations", "role", 4), ("benchmark", "text", 50)]


@register("contract_violations", "Q9", " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{c}' AS column_name, {n} AS min_length,"
    f" count(*) AS checked, count(*) FILTER (WHERE {c} IS NULL OR length({c}) < {n})"
    f" AS violations, count(*) FILTER (WHERE {c} IS NULL OR length({c}) < {n}) = 0 AS ok"
    f" FROM {table}" for table, c, n in RULES))
def contract_violations(t):
    return q.contract_violations({n: t.read(n) for n in {r[0] for r in RULES}}, RULES)
