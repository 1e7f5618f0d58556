import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from regiocast.plans import decide, quality, semantic


def forecast(spark):
    rows = [(s, dt.date(2024, m, 1), v, v - 10, v + 10)
            for s, v in [("A", 100.0), ("B", 100.0), ("C", 200.0)] for m in (1, 2, 3)]
    return spark.createDataFrame(rows, "series string, ts date, forecast double,"
                                 " lower_bound double, upper_bound double")


def test_shares_use_the_first_month_only(spark):
    rows = decide.next_month_share(forecast(spark)).collect()
    assert {r["series"]: (r["ts"].month, r["share"], r["share_pct"]) for r in rows} == {
        "A": (1, 0.25, 25.0), "B": (1, 0.25, 25.0), "C": (1, 0.5, 50.0)}


def test_equal_forecasts_share_a_rank(spark):
    ranks = {r["region"]: r["priority_rank"] for r in decide.horizon_share(forecast(spark)).collect()}
    assert ranks == {"A": 2, "B": 2, "C": 1}


def test_budget_and_channels(spark):
    split = decide.budget_split(forecast(spark), 1001.0)
    assert {r["region"]: (r["share_pct"], r["budget"]) for r in split.collect()} == {
        "A": (25.0, 250.0), "B": (25.0, 250.0), "C": (50.0, 501.0)}
    payload = {r["region"]: json.loads(r["payload"])
               for r in decide.split_json(split, 1001.0).collect()}
    assert payload["C"] == {"total_budget": 1001, "region": "C", "share_pct": 50.0, "budget": 501}
    mart = spark.createDataFrame([("A", "202401", 1, 1.0, 1, 1.0, 1.0),
                                  ("A", "202402", 2, 2.0, 2, 2.0, 2.0)],
                                 "region string, ym string, move_in int, total_sales double,"
                                 " net_move int, sales_per_pop double, avg_asset double")
    rows = decide.channel_split(mart, 1000.0).collect()
    assert {r["channel"]: r["budget"] for r in rows} == {
        "digital_capture": 250, "partner_referrals": 200, "b2b_outreach": 150,
        "experiential_offer": 150, "installation_buffer": 150, "test_reserve": 100}
    assert {r["ym"] for r in rows} == {"202402"}


def test_scenarios(spark):
    s = spark.createDataFrame([("x", "A", 60.0), ("x", "C", 40.0), ("y", "A", 10.0)],
                              "scenario string, region string, pct double")
    rows = {(r["scenario"], r["region"]): (r["budget"], r["expected_contracts"])
            for r in decide.scenario_projection(s, forecast(spark), 1000.0, rate=0.1).collect()}
    assert rows == {("x", "A"): (600.0, 6.0), ("x", "C"): (400.0, 8.0), ("y", "A"): (100.0, 1.0)}


def test_deviation_must_exceed_the_limit(spark):
    regions = spark.createDataFrame([("A",), ("B",), ("C",)], "region string")
    plan = spark.createDataFrame([("A", 40.0), ("B", 40.0)], "region string, pct double")
    user = spark.createDataFrame([("A", 55.0), ("B", 24.9), ("C", 60.0)],
                                 "region string, pct double")
    rows = {r["region"]: (r["plan_pct"], r["flag"])
            for r in decide.compare_plan(regions, plan, user, 100.0).collect()}
    assert rows == {"A": (40.0, "ok"), "B": (40.0, "under"), "C": (33.3, "over")}


def test_insights(spark):
    latest = spark.createDataFrame(
        [("A", 5, 3.5, 130.0, 90.0), ("B", -1, -4.0, 100.0, 10.0), ("C", 0, 3.0, 120.0, 60.0)],
        "region string, net_move int, sales_chg_pct double, tourism_demand_idx double,"
        " stability_score double")
    rows = {r["region"]: r["insight"] for r in decide.insights(latest).collect()}
    assert rows == {
        "A": "A: inflow lead | sales rising | tourism strong | stores stable",
        "B": "B: outflow lead | sales falling | stores unstable", "C": "C: steady overall"}


def test_context_records(spark):
    latest = spark.createDataFrame([("A", 3, float("nan"), 0.4), ("B", 1, 2.0, None)],
                                   "region string, holiday_days int, total_sales double,"
                                   " age_20_39_share double")
    shares = spark.createDataFrame([("A", 10.0, 100.0)],
                                   "series string, forecast double, share_pct double")
    imp = spark.createDataFrame([("A", i, f"f{i}", 1.0 / i) for i in range(1, 8)],
                                "series string, rank int, feature_name string,"
                                " importance_score double")
    rows = {r["region"]: json.loads(r["context"])
            for r in decide.context_json(shares, latest, imp).collect()}
    assert rows["A"]["scope"] == "A"
    assert "total_sales" not in rows["A"]["latest_snapshot"]  # NaN became NULL and is left out
    assert [f["rank"] for f in rows["A"]["top_features"]] == [1, 2, 3, 4, 5]
    assert rows["A"]["holiday"] == {"holiday_count": 3}
    assert rows["A"]["demographics"] == {"young_adult_share": 0.4}
    assert "top_features" not in rows["B"]


def test_metric_catalogue(spark):
    mart = spark.createDataFrame([("A", 10.0, 2.0), ("A", 20.0, 3.0), ("B", 5.0, 0.0)],
                                 "region string, total_sales double, total_pop double")
    rows = {r["region"]: (r["total_sales"], r["sales_per_pop"]) for r in semantic.run_metrics(
        {"mart": mart}, ["Revenue", "spending per head"], ["region"]).collect()}
    assert rows == {"A": (30.0, 6.0), "B": (5.0, None)}
    with pytest.raises(KeyError):
        semantic.resolve("unknown words")
    with pytest.raises(ValueError):
        semantic.run_metrics({"mart": mart}, ["sales", "outlook"], ["region"])
    terms = [t for t, _ in semantic.synonym_rows()]
    assert len(terms) == len(set(terms))


def test_trend_has_exactly_n_months(spark):
    mart = spark.createDataFrame([(ym, "A", 1.0, 2.0) for ym in
                                  ("202310", "202311", "202312", "202401", "202402")],
                                 "ym string, region string, total_sales double,"
                                 " sales_chg_pct double")
    assert sorted(r["ym"] for r in semantic.sales_trend(mart, 3).collect()) == [
        "202312", "202401", "202402"]


def test_quality_gates(spark):
    frame = spark.createDataFrame([("m1", "A"), ("m1", "A"), ("m2", "A"), ("m1", "B")],
                                  "ym string, region string")
    spine = spark.createDataFrame([(m, r) for m in ("m1", "m2") for r in ("A", "B")],
                                  "ym string, region string")
    keys = ["ym", "region"]
    assert [tuple(r) for r in quality.missing_cells(spine, frame, keys).collect()] == [("m2", "B")]
    assert [tuple(r) for r in quality.duplicate_keys(frame, keys).collect()] == [("m1", "A", 2)]
    assert quality.grain_report(frame, spine, keys).collect()[0].asDict() == {
        "row_count": 4, "key_count": 3, "expected": 4, "missing": 1, "complete": True}
    parent = spark.createDataFrame([("A",)], "region string")
    assert [tuple(r) for r in quality.orphans(frame, "region", parent, "region").collect()] == [
        ("B", 1)]
    cov = {r["column_name"]: r["pct"] for r in quality.coverage(
        spark.createDataFrame([(1, None), (2, 3)], "a int, b int"), ["a", "b"]).collect()}
    assert cov == {"a": 100.0, "b": 50.0}
    scale = quality.scale_check(spark.createDataFrame([(0.2, 40.0)], "a double, b double"),
                                {"a": (0, 1), "b": (0, 1)}).collect()
    assert {r["column_name"]: r["in_range"] for r in scale} == {"a": True, "b": False}


def test_terms_links_and_contracts(spark):
    docs = spark.createDataFrame([("Under LICENSE x",), ("none",), ("password license",)],
                                 "text string")
    assert {r["term"]: r["documents"] for r in quality.forbidden_terms(
        docs, "text", ["license", "password", "absent"]).collect()} == {
        "license": 2, "password": 1, "absent": 0}
    pages = spark.createDataFrame(
        [("http://a.x/p?q=1", '<a href="/q/">1</a><a href="/p#top">2</a><a href="mail">3</a>'),
         ("http://a.x/r/", '<a href="/r">1</a><a href="http://b.y/z">2</a><a href="/q">3</a>')],
        "url string, html string")
    assert {r["target"]: r["links"] for r in quality.broken_links(pages).collect()} == {
        "http://a.x/q": 2, "http://b.y/z": 1}
    bad = quality.contract_violations({"d": docs}, [("d", "text", 5)]).collect()[0]
    assert (bad["checked"], bad["violations"], bad["ok"]) == (3, 1, False)


def test_series_that_ended_early_keeps_its_share(spark):
    """One old series must not decide the month of all; an open last month takes no part."""
    from regiocast.plans import forecast as fc

    rows = [(f"{y}{m:02d}", name, 100.0 + m) for name, years in
            (("OLD", (1995, 1996)), ("A", (1999, 2000)), ("B", (1999, 2000)))
            for y in years for m in range(1, 13)] + [("200101", "A", 3.0)]
    mart = spark.createDataFrame(rows, "ym string, region string, total_sales double")
    days = spark.createDataFrame([("2000-12-31",), ("2001-01-01",)], "d string")
    through = fc.complete_through(days, "d")
    train = fc.training_frame(mart, through=through)
    shares = decide.next_month_share(fc.forecast(train)).collect()
    assert {r.series for r in shares} == {"OLD", "A", "B"}
    assert {str(r.ts)[:10] for r in shares} == {"2001-01-01"}
    assert abs(sum(r.share for r in shares) - 1) < 1e-9
