import datetime as dt

import duckdb
from pyspark.sql import functions as F

from regiocast.operators.reshape import overlay
from regiocast.plans import calendar, indices, mart


def mart_tiny(spark):
    pop = spark.createDataFrame(
        [("202401", "A", 100.0), ("202402", "A", 0.0), ("202403", "A", 120.0),
         ("202404", "A", 110.0), ("202401", "B", 50.0), ("202402", "B", 60.0),
         ("202403", "B", 70.0), ("202404", "B", 80.0)], "ym string, region string, total_pop double")
    card = spark.createDataFrame(
        [("202401", "A", 1000.0), ("202402", "A", 1100.0), ("202403", "A", 990.0),
         ("202404", "A", 1089.0), ("202401", "B", 500.0), ("202403", "B", 600.0),
         ("202404", "B", 660.0)], "ym string, region string, total_sales double")
    price = spark.createDataFrame(
        [("202401", "A", 10.0), ("202402", "A", 11.0), ("202404", "B", 9.0)],
        "ym string, region string, avg_sale_price double")
    asset = spark.createDataFrame(
        [("202401", "A", 5.0), ("202402", "A", 0.0), ("202404", "B", 3.0)],
        "ym string, region string, avg_asset double")
    wide = mart.left_join_all(pop, [(f, mart.KEY) for f in (card, price, asset)])
    return {(r["region"], r["ym"]): r for r in mart.add_changes(mart.add_ratios(wide)).collect()}


def test_left_joins_keep_the_spine_and_its_nulls(spark):
    rows = mart_tiny(spark)
    assert len(rows) == 8
    assert rows["B", "202402"]["total_sales"] is None
    assert rows["B", "202402"]["sales_per_pop"] is None
    assert rows["A", "202402"]["sales_per_pop"] == 0.0
    assert rows["A", "202401"]["price_to_asset_ratio"] == 2.0
    assert rows["A", "202402"]["price_to_asset_ratio"] is None


def test_change_is_zero_without_a_positive_previous_value(spark):
    rows = mart_tiny(spark)
    assert rows["A", "202401"]["sales_chg_pct"] == 0.0
    assert rows["A", "202401"]["prev_sales"] is None
    assert abs(rows["A", "202402"]["sales_chg_pct"] - 10.0) < 1e-12
    assert rows["A", "202403"]["pop_chg_pct"] == 0.0  # previous population was 0
    assert rows["B", "202403"]["sales_chg_pct"] == 0.0  # previous sales unknown
    assert rows["B", "202402"]["sales_chg_pct"] is None  # own sales unknown


def test_lag_is_the_previous_row_and_strict_is_the_previous_month(spark):
    df = spark.createDataFrame([("202401", "A", 10.0), ("202402", "A", 20.0), ("202404", "A", 30.0)],
                               "ym string, region string, total_sales double")
    w = df.withColumns({"total_pop": F.lit(1.0), "avg_sale_price": F.lit(1.0)})
    loose = {r["ym"]: r["prev_sales"] for r in mart.add_changes(w).collect()}
    assert loose == {"202401": None, "202402": 10.0, "202404": 20.0}
    strict = {r["ym"]: r["total_sales_strict_chg_pct"]
              for r in mart.add_strict_changes(df, "total_sales").collect()}
    assert strict == {"202401": None, "202402": 100.0, "202404": None}


def test_calendar_counts(spark):
    bounds = spark.createDataFrame([(dt.date(2024, 3, 5), dt.date(2024, 5, 2))], "lo date, hi date")
    rows = {r["ym"]: r for r in calendar.calendar_features(bounds).collect()}
    assert sorted(rows) == ["202403", "202404", "202405"]
    # Friday 1 March is a holiday next to a weekend: one long weekend
    assert rows["202403"].asDict() == {"ym": "202403", "holiday_days": 1,
                                       "long_weekend_cnt": 1, "business_days": 20}
    # Sunday 5 May is not a weekday holiday
    assert rows["202405"]["holiday_days"] == 0
    extra = calendar.calendar_features(bounds, dates=["20240506"])
    may = [r for r in extra.collect() if r["ym"] == "202405"][0]
    assert (may["holiday_days"], may["long_weekend_cnt"], may["business_days"]) == (1, 1, 22)


def test_long_weekend_across_the_edge_is_kept(spark):
    bounds = spark.createDataFrame([(dt.date(2021, 12, 1), dt.date(2021, 12, 31))],
                                   "lo date, hi date")
    row = calendar.calendar_features(bounds, ["0103"]).collect()[0]
    assert row["long_weekend_cnt"] == 0  # starts on Saturday 1 January
    row = calendar.calendar_features(bounds, ["1231"]).collect()[0]
    assert row["long_weekend_cnt"] == 1  # starts on Friday 31 December


def test_visitor_indices_of_the_base_period(spark):
    rows = [("A", m, 10.0 + (m == 14) * 2.345, 5.0, 100.0) for m in range(15)]
    rows += [("B", m, 0.0, 1.0, 1.0) for m in (0, 3)] + [("C", 13, 4.0, 4.0, 4.0)]
    df = spark.createDataFrame(
        rows, "region string, m int, visit_pop double, work_pop double, total_sales double")
    got = {(r["region"], r["m"]): r for r in indices.visitor_indices(df, F.lit(0)).collect()}
    last = got["A", 14]
    assert (last["domestic_visitor_idx"], last["foreign_visitor_idx"]) == (123.5, 100.0)
    assert last["tourism_demand_idx"] == 107.8  # (123.45 + 100 + 100) / 3
    assert got["B", 3]["domestic_visitor_idx"] is None  # nothing in the base period
    assert got["B", 3]["foreign_visitor_idx"] == 600.0  # mean of twelve months is 1/6
    assert got["B", 3]["tourism_demand_idx"] is None
    assert got["C", 13]["tourism_demand_idx"] is None  # starts after the base period


def test_marts_keep_one_row_per_key(tables):
    base = mart.base_mart(tables)
    signal = mart.signal_mart(tables)
    n = base.count()
    assert signal.count() == n
    assert signal.select(*mart.KEY).distinct().count() == n
    bad = signal.filter(F.col("net_move") != F.col("move_in") - F.col("move_out"))
    assert bad.isEmpty()


def test_first_months_start_at_zero(tables):
    path = f"{tables.path}/orders.parquet"
    first = duckdb.sql(f"SELECT strftime(min(o_orderdate),'%Y%m') FROM '{path}'").fetchall()[0][0]
    rows = mart.base_mart(tables).filter(F.col("ym") == first).collect()
    assert rows and all(r["sales_chg_pct"] == 0.0 for r in rows)


def test_overlay_keeps_dates_of_either_side(spark):
    df = spark.createDataFrame(
        [(1, "A", 10.0, None), (2, "A", 11.0, None), (3, "A", None, 12.0), (1, "B", 5.0, None)],
        "ds int, series string, actual double, forecast double")
    rows = {r["ds"]: r for r in overlay(df, "ds", "series", "actual", "forecast",
                                        ["A", "B"]).collect()}
    assert sorted(rows) == [1, 2, 3]
    assert rows[3]["A_forecast"] == 12.0 and rows[3]["A_actual"] is None
