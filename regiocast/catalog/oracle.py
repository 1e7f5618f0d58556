"""Check statements: named subqueries in plain SQL, written apart from the Spark jobs."""

from __future__ import annotations

from regiocast.plans import fixed

_PARTS: dict[str, tuple[tuple[str, ...], str]] = {}


def part(name: str, needs: str, body: str) -> None:
    _PARTS[name] = (tuple(needs.split()), body)


def sql(needs: str, select: str) -> str:
    """``select`` behind a WITH clause of the needed subqueries, in dependency order."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for need in _PARTS[name][0]:
            visit(need)
        order.append(name)

    for name in needs.split():
        visit(name)
    if not order:
        return select
    ctes = ",\n".join(f"{n} AS ({_PARTS[n][1]})" for n in order)
    return f"WITH {ctes}\n{select}"


def rounded(expr: str, digits: int) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(24,6)), {digits}) AS DOUBLE)"


part("act_lines", "", """
 SELECT strftime(o_orderdate,'%Y%m') AS ym, n_name AS region, count(*) AS total_tx_count,
  sum(CASE WHEN l_returnflag='A' THEN CAST(l_quantity AS DECIMAL(12,2)) ELSE 0 END) AS res_pop,
  sum(CASE WHEN l_returnflag='N' THEN CAST(l_quantity AS DECIMAL(12,2)) ELSE 0 END) AS work_pop,
  sum(CASE WHEN l_returnflag='R' THEN CAST(l_quantity AS DECIMAL(12,2)) ELSE 0 END) AS visit_pop,
  sum(CAST(l_quantity AS DECIMAL(12,2))) AS total_pop,
  sum(net) AS total_sales,
  sum(CASE WHEN p_type='ECONOMY' THEN net ELSE 0 END) AS economy_sales,
  sum(CASE WHEN p_type='LARGE' THEN net ELSE 0 END) AS large_sales,
  sum(CASE WHEN p_type='MEDIUM' THEN net ELSE 0 END) AS medium_sales,
  sum(CASE WHEN p_type='PROMO' THEN net ELSE 0 END) AS promo_sales,
  sum(CASE WHEN p_type='SMALL' THEN net ELSE 0 END) AS small_sales,
  sum(CASE WHEN p_type='STANDARD' THEN net ELSE 0 END) AS standard_sales
 FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(12,2))
        * (1 - CAST(l_discount AS DECIMAL(5,2))) AS net FROM lineitem) l
 JOIN part ON l_partkey = p_partkey
 JOIN orders ON l_orderkey = o_orderkey
 JOIN customer ON o_custkey = c_custkey
 JOIN nation ON c_nationkey = n_nationkey
 GROUP BY ALL""")

part("act_orders", "", """
 SELECT strftime(o_orderdate,'%Y%m') AS ym, n_name AS region, any_value(n_nationkey) AS code,
  count(*) AS move_in, count(DISTINCT c_custkey) AS customers,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_income,
  CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_asset,
  count(*) FILTER (WHERE o_orderpriority='1-URGENT') AS rental_count,
  count(*) FILTER (WHERE o_orderpriority='2-HIGH') AS new_contract_count,
  count(*) FILTER (WHERE o_orderpriority='3-MEDIUM') AS campaign_count,
  count(*) FILTER (WHERE o_orderpriority='4-NOT SPECIFIED') AS cs_calls,
  count(*) FILTER (WHERE o_orderpriority='5-LOW') AS cancel_count,
  CAST(sum(CASE WHEN o_orderpriority='1-URGENT' THEN CAST(o_totalprice AS DECIMAL(18,2))
       ELSE 0 END) AS DOUBLE) AS rental_amount,
  count(DISTINCT CASE WHEN c_mktsegment='FURNITURE' THEN c_custkey END) AS pop_0_19,
  count(DISTINCT CASE WHEN c_mktsegment IN ('BUILDING','AUTOMOBILE') THEN c_custkey END)
   AS pop_20_39,
  count(DISTINCT CASE WHEN c_mktsegment='HOUSEHOLD' THEN c_custkey END) AS pop_40_59,
  count(DISTINCT CASE WHEN c_mktsegment='MACHINERY' THEN c_custkey END) AS pop_60_plus,
  count(DISTINCT CASE WHEN c_mktsegment IN ('BUILDING','HOUSEHOLD') THEN c_custkey END)
   AS pop_30_49,
  count(DISTINCT CASE WHEN c_mktsegment IN ('AUTOMOBILE','MACHINERY') THEN c_custkey END)
   AS pop_male
 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
 GROUP BY ALL""")

part("population", "act_lines", """
 SELECT ym, region, CAST(res_pop AS DOUBLE) AS res_pop, CAST(work_pop AS DOUBLE) AS work_pop,
  CAST(visit_pop AS DOUBLE) AS visit_pop, CAST(total_pop AS DOUBLE) AS total_pop
 FROM act_lines""")

part("card_sales", "act_lines", """
 SELECT ym, region, CAST(total_sales AS DOUBLE) AS total_sales,
  CAST(economy_sales AS DOUBLE) AS economy_sales, CAST(large_sales AS DOUBLE) AS large_sales,
  CAST(medium_sales AS DOUBLE) AS medium_sales, CAST(promo_sales AS DOUBLE) AS promo_sales,
  CAST(small_sales AS DOUBLE) AS small_sales, CAST(standard_sales AS DOUBLE) AS standard_sales,
  total_tx_count FROM act_lines""")

part("assets", "act_orders", "SELECT ym, region, customers, avg_income, avg_asset FROM act_orders")

part("sup_month", "", """
 SELECT l_suppkey, date_trunc('month', l_shipdate)::DATE AS mon, count(*) AS lines,
  sum(CAST(l_quantity AS DECIMAL(12,2))) AS qty,
  sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS price,
  sum(CAST(p_retailprice AS DECIMAL(12,2))) AS retail
 FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL""")

part("sup_open", "sup_month", """
 SELECT s.*, date_diff('month', f.first_mon, s.mon) AS tenure,
  p.l_suppkey IS NULL AS opened, n.l_suppkey IS NULL AS closes
 FROM sup_month s
 JOIN (SELECT l_suppkey, min(mon) AS first_mon FROM sup_month GROUP BY 1) f USING (l_suppkey)
 LEFT JOIN sup_month p ON p.l_suppkey = s.l_suppkey AND p.mon = s.mon - INTERVAL 1 MONTH
 LEFT JOIN sup_month n ON n.l_suppkey = s.l_suppkey AND n.mon = s.mon + INTERVAL 1 MONTH""")

part("sup_activity", "sup_open", """
 SELECT strftime(mon,'%Y%m') AS ym, n_name AS region,
  CAST(sum(retail) AS DOUBLE) / nullif(sum(lines), 0) AS avg_sale_price,
  CAST(sum(price) AS DOUBLE) / nullif(CAST(sum(qty) AS DOUBLE), 0) AS avg_price_per_unit,
  CASE WHEN sum(active) > 0 THEN CAST(sum(qty) AS DOUBLE) END AS total_households,
  CAST(sum(lines) AS BIGINT) AS move_out, CAST(sum(active) AS BIGINT) AS active_stores,
  CASE WHEN sum(opened) >= sum(closed) THEN 'growing' ELSE 'stagnant' END AS commercial_status,
  CASE WHEN sum(active) > 0 THEN CAST(sum(active) - sum(opened) AS DOUBLE) * 100.0::DOUBLE
   / CAST(sum(active) AS DOUBLE) ELSE 0 END AS stability_score,
  CAST(sum(tenure) AS DOUBLE) / nullif(CAST(sum(active) AS DOUBLE), 0) AS avg_operating_months,
  CAST(sum(closed_tenure) AS DOUBLE) / nullif(CAST(sum(closed) AS DOUBLE), 0)
   AS avg_closure_months,
  CAST(sum(opened) AS BIGINT) AS store_open_cnt, CAST(sum(closed) AS BIGINT) AS store_close_cnt,
  CAST(sum(opened) - sum(closed) AS BIGINT) AS net_store_change,
  CASE WHEN sum(closed) > sum(opened) THEN 1 ELSE 0 END AS closure_risk_flag,
  CASE WHEN (sum(opened) + sum(closed)) * 2 > sum(active) THEN 1 ELSE 0 END
   AS dynamic_zone_flag
 FROM (
  SELECT l_suppkey, mon, 1 AS active, opened::INT AS opened, 0 AS closed, tenure,
   0 AS closed_tenure, lines, qty, price, retail FROM sup_open
  UNION ALL
  SELECT l_suppkey, (mon + INTERVAL 1 MONTH)::DATE, 0, 0, 1, 0, tenure + 1, 0, 0, 0, 0
  FROM sup_open WHERE closes AND mon < (SELECT max(mon) FROM sup_month)) e
 JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
 GROUP BY 1, 2""")

part("movement", "act_orders sup_activity", """
 SELECT coalesce(a.ym, s.ym) AS ym, coalesce(a.region, s.region) AS region,
  coalesce(move_in, 0) AS move_in, coalesce(move_out, 0) AS move_out,
  coalesce(move_in, 0) - coalesce(move_out, 0) AS net_move
 FROM act_orders a FULL JOIN (SELECT * FROM sup_activity WHERE active_stores > 0) s
  ON a.ym = s.ym AND a.region = s.region""")

part("days", "", f"""
 SELECT d::DATE AS d, dayofweek(d) IN (0, 6) AS weekend,
  strftime(d,'%m%d') IN ({",".join(f"'{h}'" for h in fixed.FIXED_HOLIDAYS)}) AS holiday
 FROM (SELECT unnest(generate_series(
   date_trunc('month', (SELECT min(o_orderdate) FROM orders))::TIMESTAMP - INTERVAL 7 DAY,
   date_trunc('month', (SELECT max(o_orderdate) FROM orders))::TIMESTAMP
    + INTERVAL 1 MONTH + INTERVAL 7 DAY, INTERVAL 1 DAY)) AS d)""")

part("long_weekends", "days", """
 SELECT strftime(min(d),'%Y%m') AS ym FROM (
  SELECT d, d - CAST(row_number() OVER (ORDER BY d) AS INTEGER) AS island
  FROM days WHERE weekend OR holiday) GROUP BY island HAVING count(*) >= 3""")

part("calendar", "days long_weekends", """
 SELECT ym, CAST(count(*) FILTER (WHERE holiday AND NOT weekend) AS INTEGER) AS holiday_days,
  CAST(coalesce(any_value(n), 0) AS INTEGER) AS long_weekend_cnt,
  CAST(count(*) FILTER (WHERE NOT holiday AND NOT weekend) AS INTEGER) AS business_days
 FROM (SELECT *, strftime(d,'%Y%m') AS ym FROM days) d
 LEFT JOIN (SELECT ym, count(*) AS n FROM long_weekends GROUP BY 1) w USING (ym)
 WHERE ym BETWEEN (SELECT strftime(min(o_orderdate),'%Y%m') FROM orders)
  AND (SELECT strftime(max(o_orderdate),'%Y%m') FROM orders)
 GROUP BY ym""")

part("demographics", "act_orders", """
 SELECT ym, region, customers AS total_resident, pop_0_19, pop_20_39, pop_40_59, pop_60_plus,
  pop_20_39 / customers::DOUBLE AS age_20_39_share,
  pop_30_49 / customers::DOUBLE AS family_30_49_share,
  pop_60_plus / customers::DOUBLE AS senior_60p_share,
  pop_male / customers::DOUBLE AS male_ratio FROM act_orders""")

part("months", "", """
 SELECT strftime(m,'%Y%m') AS ym, month(m) AS mm, year(m) AS yy,
  date_diff('month', (SELECT min(o_orderdate) FROM orders)::TIMESTAMP, m) AS i
 FROM (SELECT unnest(generate_series(
  date_trunc('month', (SELECT min(o_orderdate) FROM orders))::TIMESTAMP,
  (SELECT max(o_orderdate) FROM orders)::TIMESTAMP, INTERVAL 1 MONTH)) AS m)""")


_VISITS = {"domestic_visitor_idx": "visit_pop", "foreign_visitor_idx": "work_pop",
           "tourism_spend_idx": "total_sales"}
part("tourism", "months population card_sales", f"""
 SELECT ym, region, {", ".join(f"{rounded(c, 1)} AS {c}" for c in _VISITS)},
  {rounded("(" + " + ".join(_VISITS) + ") / 3.0::DOUBLE", 1)} AS tourism_demand_idx
 FROM (SELECT ym, region, {", ".join(
     f"CASE WHEN b_{c} > 0 THEN {c} * 100.0::DOUBLE / b_{c} END AS {i}" for i, c in _VISITS.items())}
  FROM (SELECT *, {", ".join(
      f"CAST(sum(CAST({c} AS DECIMAL(28,4))) FILTER (i < 12) OVER (PARTITION BY region) AS DOUBLE)"
      f" / 12.0::DOUBLE AS b_{c}" for c in _VISITS.values())}
   FROM (SELECT m.ym, m.i, n_name AS region, coalesce(visit_pop, 0) AS visit_pop,
     coalesce(work_pop, 0) AS work_pop, coalesce(total_sales, 0) AS total_sales
    FROM months m CROSS JOIN nation LEFT JOIN population p ON p.ym = m.ym AND p.region = n_name
    LEFT JOIN card_sales c ON c.ym = m.ym AND c.region = n_name)))""")

part("commercial", "sup_activity", """
 SELECT ym, region, commercial_status, stability_score, avg_operating_months,
  avg_closure_months, store_open_cnt, store_close_cnt, net_store_change, closure_risk_flag,
  dynamic_zone_flag FROM sup_activity""")

part("telecom", "act_orders", """
 SELECT ym, region, move_in AS contract_count, new_contract_count, cancel_count, rental_count,
  rental_amount, (20000 * rental_count + move_in) // (2 * move_in) / 10000.0::DOUBLE
   AS marketing_score, campaign_count, cs_calls FROM act_orders""")

part("mart1", "population card_sales assets sup_activity movement", """
 SELECT * EXCLUDE (prev_price),
  CASE WHEN prev_sales > 0 THEN (total_sales - prev_sales) / prev_sales * 100 ELSE 0 END
   AS sales_chg_pct,
  CASE WHEN prev_pop > 0 THEN (total_pop - prev_pop) / prev_pop * 100 ELSE 0 END AS pop_chg_pct,
  CASE WHEN prev_price > 0 THEN (avg_sale_price - prev_price) / prev_price * 100 ELSE 0 END
   AS price_chg_pct
 FROM (
  SELECT p.ym, p.region, total_pop, res_pop, work_pop, visit_pop, total_sales, economy_sales,
   large_sales, medium_sales, promo_sales, small_sales, standard_sales, total_tx_count,
   customers, avg_income, avg_asset, avg_sale_price, avg_price_per_unit, total_households,
   m.move_in, m.move_out, m.net_move,
   CASE WHEN total_pop > 0 THEN total_sales / total_pop ELSE 0 END AS sales_per_pop,
   CASE WHEN avg_asset > 0 THEN avg_sale_price / avg_asset END AS price_to_asset_ratio,
   lag(total_sales) OVER w AS prev_sales, lag(total_pop) OVER w AS prev_pop,
   lag(avg_sale_price) OVER w AS prev_price
  FROM population p LEFT JOIN card_sales c USING (ym, region) LEFT JOIN assets a USING (ym, region)
  LEFT JOIN sup_activity s USING (ym, region) LEFT JOIN movement m USING (ym, region)
  WINDOW w AS (PARTITION BY p.region ORDER BY p.ym))""")

part("mart2", "mart1 calendar demographics tourism commercial", """
 SELECT *, CASE WHEN next_month_holidays >= 2 THEN 1 ELSE 0 END AS pre_holiday_flag,
  CASE WHEN prev_month_holidays >= 2 THEN 1 ELSE 0 END AS post_holiday_flag,
  coalesce(age_20_39_share * tourism_demand_idx / 100, 0) AS young_consumer_idx,
  coalesce(stability_score * (1.0::DOUBLE - closure_risk_flag * 0.3::DOUBLE), 0)
   AS market_health_score,
  coalesce((net_move + net_store_change) * tourism_demand_idx / 100, 0) AS rental_signal_v2
 FROM (
  SELECT f.*, holiday_days, long_weekend_cnt, business_days, total_resident, pop_0_19,
   pop_20_39, pop_40_59, pop_60_plus, age_20_39_share, family_30_49_share, senior_60p_share,
   male_ratio, domestic_visitor_idx, foreign_visitor_idx, tourism_spend_idx,
   tourism_demand_idx, commercial_status, stability_score, avg_operating_months,
   avg_closure_months, store_open_cnt, store_close_cnt, net_store_change, closure_risk_flag,
   dynamic_zone_flag,
   lead(holiday_days) OVER w AS next_month_holidays,
   lag(holiday_days) OVER w AS prev_month_holidays
  FROM mart1 f LEFT JOIN calendar USING (ym) LEFT JOIN demographics USING (ym, region)
  LEFT JOIN tourism USING (ym, region) LEFT JOIN commercial USING (ym, region)
  WINDOW w AS (PARTITION BY f.region ORDER BY f.ym))""")

part("mart3", "mart2 telecom", """
 SELECT f.*, contract_count, new_contract_count, cancel_count, rental_count, rental_amount,
  marketing_score, campaign_count, cs_calls,
  coalesce(rental_count, 0) * 0.5::DOUBLE + coalesce(net_move, 0) * 0.01::DOUBLE
   + coalesce(sales_chg_pct, 0) * 0.1::DOUBLE AS rental_signal,
  CASE WHEN move_in > 0 THEN
   (20000 * coalesce(rental_count, 0) + move_in) // (2 * move_in) / 10000.0::DOUBLE END
   AS rental_conversion_rate
 FROM mart2 f LEFT JOIN telecom USING (ym, region)""")

# ---------------------------------------------------------------- forecasts
part("complete", "", """
 SELECT strftime(CASE WHEN d = last_day(d) THEN d ELSE d - INTERVAL 1 MONTH END, '%Y%m') AS ym
 FROM (SELECT max(o_orderdate)::DATE AS d FROM orders)""")
part("train", "card_sales complete", """
 SELECT region AS series, strptime(ym || '01','%Y%m%d')::DATE AS ds, total_sales AS y
 FROM card_sales WHERE total_sales > 0 AND ym <= (SELECT ym FROM complete)""")


def exact(expr: str) -> str:
    return (f"(CAST(floor({expr}) AS DOUBLE)"
            f" + CAST({expr} - floor({expr}) AS DOUBLE))")


_T = "((year(ds) - 1970) * 12 + month(ds) - 1)"


def fit_parts(prefix: str, source: str, needs: str, keys: str) -> None:
    """Parameters per key, in the same expression order as the Spark job."""
    part(f"{prefix}_m", needs, f"""
 SELECT {keys}, month(ds) AS mm, CAST(count(*) AS DOUBLE) AS n,
  CAST(sum({_T}) AS BIGINT) AS st, CAST(sum({_T} * {_T}) AS BIGINT) AS stt,
  sum(CAST(y AS DECIMAL(18,4))) AS sy,
  sum(CAST(y AS DECIMAL(18,4)) * CAST({_T} AS DECIMAL(10,0))) AS sty,
  sum(CAST(y AS DECIMAL(19,4)) * CAST(y AS DECIMAL(19,4))) AS syy, max(ds) AS last_ds
 FROM {source} GROUP BY ALL""")
    part(f"{prefix}_s", f"{prefix}_m", f"""
 SELECT {keys}, sum(n) AS n, count(*) AS k, max(last_ds) AS last_ds,
  CAST(sum(st) AS DOUBLE) AS st, CAST(sum(stt) AS DOUBLE) AS stt,
  {exact("sum(sy)")} AS sy, {exact("sum(sty)")} AS sty, {exact("sum(syy)")} AS syy,
  sum(CAST(stt AS DOUBLE) - CAST(st AS DOUBLE) * CAST(st AS DOUBLE) / n ORDER BY mm) AS wxx,
  sum({exact("sty")} - CAST(st AS DOUBLE) * {exact("sy")} / n ORDER BY mm) AS wxy,
  sum({exact("syy")} - {exact("sy")} * {exact("sy")} / n ORDER BY mm) AS wyy
 FROM {prefix}_m GROUP BY ALL""")
    part(prefix, f"{prefix}_s", f"""
 SELECT *, (sy - trend_slope * st) / n AS level, CASE WHEN dof > 0 THEN sqrt(greatest(
   CASE WHEN seasonal THEN wyy - slope * wxy ELSE tyy - slope * txy END, 0) / dof) END AS sigma
 FROM (SELECT *, CASE WHEN seasonal THEN wxy / wxx ELSE trend_slope END AS slope,
   CASE WHEN seasonal THEN n - 13 ELSE n - 2 END AS dof
  FROM (SELECT *, CASE WHEN txx > 0 THEN txy / txx ELSE 0 END AS trend_slope
   FROM (SELECT *, k = 12 AND n > 12 AND wxx > 0 AS seasonal, sy / n AS mean,
     stt - st * st / n AS txx, sty - st * sy / n AS txy, syy - sy * sy / n AS tyy
    FROM {prefix}_s)))""")


fit_parts("fitted", "train", "train", "series")

part("forecast", "fitted fitted_m", f"""
 SELECT series, ts, forecast, forecast - {fixed.Z_95}::DOUBLE * sigma AS lower_bound,
  forecast + {fixed.Z_95}::DOUBLE * sigma AS upper_bound
 FROM (SELECT f.series, f.ts, sigma, CASE WHEN seasonal
   THEN ({exact("m.sy")} - slope * CAST(m.st AS DOUBLE)) / m.n + slope * t
   ELSE level + trend_slope * t END AS forecast
  FROM (SELECT *, ((year(ts) - 1970) * 12 + month(ts) - 1)::DOUBLE AS t FROM (
    SELECT *, ((SELECT max(last_ds) FROM fitted) + to_months(CAST(h AS INTEGER)))::DATE AS ts
    FROM fitted, generate_series(1, 3) g(h))) f
  LEFT JOIN fitted_m m ON m.series = f.series AND m.mm = month(f.ts))""")

part("train_age", "train", f"""
 SELECT *, max({_T}) OVER (PARTITION BY series) - {_T} AS age FROM train""")
part("known", "train_age", """
 SELECT series, CAST(k AS INTEGER) AS fold, ds, y FROM train_age, generate_series(1, 6) g(k)
 WHERE age >= k + 2""")
part("target", "train_age", """
 SELECT series, CAST(k AS INTEGER) AS fold, ds, y FROM train_age, generate_series(1, 6) g(k)
 WHERE age < k + 2 AND age >= k - 1""")
fit_parts("folded", "known", "known", "series, fold")

part("ladder", "folded folded_m target", f"""
 SELECT series, fold, ds, actual, unnest(['MODEL_A','MODEL_B','MODEL_C']) AS model_name,
  unnest([mean, trend, CASE WHEN seasonal THEN season ELSE trend END]) AS forecast
 FROM (SELECT a.series, a.fold, a.ds, a.y AS actual, mean, seasonal,
   level + trend_slope * {_T.replace("ds", "a.ds")}::DOUBLE AS trend,
   ({exact("m.sy")} - slope * CAST(m.st AS DOUBLE)) / m.n
    + slope * {_T.replace("ds", "a.ds")}::DOUBLE AS season
  FROM target a JOIN folded f ON f.series = a.series AND f.fold = a.fold
  LEFT JOIN folded_m m ON m.series = a.series AND m.fold = a.fold AND m.mm = month(a.ds))""")

part("errors", "ladder", """
 SELECT model_name, series, fold,
  CAST(abs(actual - forecast) / abs(actual) * 100 AS DECIMAL(18,6)) AS mape,
  CAST(abs(actual - forecast) * 200 / (abs(actual) + abs(forecast)) AS DECIMAL(18,6)) AS smape,
  CAST(abs(actual - forecast) AS DECIMAL(24,6)) AS mae FROM ladder""")
part("fold_errors", "errors", """
 SELECT model_name, series, fold, CAST(sum(mape) AS DOUBLE) / count(*) AS mape,
  CAST(sum(smape) AS DOUBLE) / count(*) AS smape, CAST(sum(mae) AS DOUBLE) / count(*) AS mae
 FROM errors GROUP BY ALL""")
part("fold_means", "fold_errors", """
 SELECT model_name, series, CAST(count(*) AS DOUBLE) AS k,
  sum(mape ORDER BY fold) / count(*) AS mape_m, sum(smape ORDER BY fold) / count(*) AS smape_m,
  sum(mae ORDER BY fold) / count(*) AS mae_m FROM fold_errors GROUP BY ALL""")


def _sd(m: str) -> str:
    return (f"CASE WHEN count(*) > 1 THEN sqrt(sum(({m} - {m}_m) * ({m} - {m}_m) ORDER BY fold)"
            f" / (count(*) - 1)) END")


part("fold_sd", "fold_errors fold_means", f"""
 SELECT model_name, series, {_sd("mape")} AS mape_sd, {_sd("smape")} AS smape_sd,
  {_sd("mae")} AS mae_sd FROM fold_errors JOIN fold_means USING (model_name, series)
 GROUP BY ALL""")
part("wide_metrics", "errors", """
 SELECT model_name, series, CAST(sum(mape) AS DOUBLE) / count(*) AS mape,
  CAST(sum(smape) AS DOUBLE) / count(*) AS smape, CAST(sum(mae) AS DOUBLE) / count(*) AS mae
 FROM errors GROUP BY ALL""")
part("model_summary", "wide_metrics", """
 SELECT model_name, series, model_order, mape, smape, mae,
  baseline - mape AS improve_vs_baseline,
  CASE WHEN baseline > 0 THEN (baseline - mape) / baseline * 100 END AS improve_pct_vs_baseline,
  prev - mape AS step_improve,
  CASE WHEN prev > 0 THEN (prev - mape) / prev * 100 END AS step_improve_pct
 FROM (SELECT *, first_value(mape) OVER w AS baseline, lag(mape) OVER w AS prev FROM (
  SELECT *, CAST(instr('ABC', right(model_name, 1)) AS INTEGER) AS model_order
  FROM wide_metrics) WINDOW w AS (PARTITION BY series ORDER BY model_order))""")

FEATURES = ["holiday_days", "long_weekend_cnt", "business_days", "age_20_39_share",
            "senior_60p_share", "family_30_49_share", "tourism_demand_idx",
            "foreign_visitor_idx", "stability_score", "net_store_change"]
part("panel", "mart2 complete", f"""
 SELECT region AS series, strptime(ym || '01','%Y%m%d')::DATE AS ds, total_sales AS y,
  {", ".join(f"coalesce({c}, 0)::DOUBLE AS {c}" for c in FEATURES)}
 FROM mart2 WHERE total_sales > 0 AND ym <= (SELECT ym FROM complete)""")
part("panel_long", "panel", " UNION ALL ".join(
    f"SELECT series, CAST(y AS DECIMAL(18,4)) AS y, '{c}' AS feature_name,"
    f" CAST({c} AS DECIMAL(18,6)) AS x, {i} AS pos FROM panel" for i, c in enumerate(FEATURES)))
part("corr_sums", "panel_long", f"""
 SELECT series, feature_name, any_value(pos) AS pos, CAST(count(*) AS DOUBLE) AS n,
  {exact("sum(x)")} AS sx, {exact("sum(y)")} AS sy,
  {exact("sum(CAST(x AS DECIMAL(19,6)) * CAST(x AS DECIMAL(19,6)))")} AS sxx,
  {exact("sum(CAST(y AS DECIMAL(19,4)) * CAST(y AS DECIMAL(19,4)))")} AS syy,
  {exact("sum(CAST(y AS DECIMAL(19,4)) * CAST(x AS DECIMAL(19,6)))")} AS sxy
 FROM panel_long GROUP BY ALL""")
part("importance", "corr_sums", """
 SELECT series, feature_name, s / total AS importance_score,
  CAST(row_number() OVER (PARTITION BY series ORDER BY s / total DESC NULLS LAST, feature_name)
   AS INTEGER) AS rank
 FROM (SELECT *, t.total FROM (
   SELECT series, feature_name, CASE WHEN vx > 0 AND vy > 0
    THEN abs(n * sxy - sy * sx) / (sqrt(vx) * sqrt(vy)) ELSE 0 END AS s
   FROM (SELECT *, n * sxx - sx * sx AS vx, n * syy - sy * sy AS vy FROM corr_sums)) r
  JOIN (SELECT series, sum(s ORDER BY pos) AS total FROM (
   SELECT series, pos, CASE WHEN vx > 0 AND vy > 0
    THEN abs(n * sxy - sy * sx) / (sqrt(vx) * sqrt(vy)) ELSE 0 END AS s
   FROM (SELECT *, n * sxx - sx * sx AS vx, n * syy - sy * sy AS vy FROM corr_sums))
   GROUP BY 1) t USING (series))""")

# ---------------------------------------------------------------- decisions
part("next_month", "forecast", """
 SELECT series, ts, forecast, lower_bound, upper_bound, forecast / total AS share,
  forecast / total * 100 AS share_pct
 FROM (SELECT * FROM forecast WHERE ts = (SELECT max(last_ds) FROM fitted) + INTERVAL 1 MONTH) f,
  (SELECT CAST(sum(CAST(forecast AS DECIMAL(28,4))) AS DOUBLE) AS total FROM forecast
   WHERE ts = (SELECT max(last_ds) FROM fitted) + INTERVAL 1 MONTH)""")
part("mean_forecast", "forecast", """
 SELECT series AS region, CAST(sum(CAST(forecast AS DECIMAL(28,4))) AS DOUBLE) / count(forecast)
  AS forecast FROM forecast GROUP BY 1""")
part("mean_share", "mean_forecast", """
 SELECT region, forecast, forecast / CAST(sum(CAST(forecast AS DECIMAL(28,4))) OVER () AS DOUBLE)
  AS share FROM mean_forecast""")
part("split", "mean_share", f"""
 SELECT region, forecast, {rounded("share * 100", 1)} AS share_pct,
  {rounded("share * 50000000", 0)} AS budget FROM mean_share""")
part("newest1", "mart1", """
 SELECT * FROM mart1 QUALIFY row_number() OVER (PARTITION BY region ORDER BY ym DESC) = 1""")
part("newest3", "mart3", """
 SELECT * FROM mart3 QUALIFY row_number() OVER (PARTITION BY region ORDER BY ym DESC) = 1""")
part("current2", "mart2 complete", "SELECT * FROM mart2 WHERE ym = (SELECT max(ym) FROM mart2"
     " WHERE ym <= (SELECT ym FROM complete))")
