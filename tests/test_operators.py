import datetime
import random

import pytest
from pyspark.sql import functions as F

from regiocast.functions import exact, text
from regiocast.operators import windows as ow
from regiocast.operators.topk import top_k_per_group, top_k_with_fallback
from regiocast.plans import staging
from regiocast.sources import first_usable, with_standard_names
from regiocast.sources.sinks import replace_partitions


@pytest.fixture
def many_slices(spark):
    """Keep every range partition, so that offsets between slices matter."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, before)


def test_global_rank_with_one_value_holding_a_third(spark, many_slices):
    random.seed(3)
    values = [7.0] * 200 + [float(random.randint(0, 300)) for _ in range(395)] + [None] * 5
    random.shuffle(values)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v double")
    got = {r["id"]: r["rnk"] for r in ow.global_rank(df.repartition(7), "rnk", "v").collect()}
    known = sorted((v for v in values if v is not None), reverse=True)
    for i, v in enumerate(values):
        assert got[i] == (len(known) + 1 if v is None else known.index(v) + 1)


def test_global_row_number_is_the_sorted_position(spark, many_slices):
    names = [f"k{random.randint(0, 10 ** 9)}-{i}" for i in range(500)]
    df = spark.createDataFrame([(n,) for n in names], "k string").repartition(9)
    assert ow._slices(df, F.col("k").asc()).select("_slice").distinct().count() > 1
    got = {r["k"]: r["rn"] for r in ow.global_row_number(df, "rn", F.col("k").asc()).collect()}
    assert got == {k: i for i, k in enumerate(sorted(names), start=1)}


def test_latest_per_key_hashes_and_orders_pairs(spark):
    day, low, high = datetime.date, -(1 << 63), (1 << 63) - 1
    rows = [(1, day(1969, 12, 31), high), (1, day(1970, 1, 1), low), (2, day(2020, 2, 2), -5),
            (2, day(2020, 2, 2), 7), (2, day(2020, 2, 1), high), (3, None, 4)]
    df = spark.createDataFrame(rows, "k int, d date, i bigint")
    order = ow.day_and_id("d", "i")
    last = ow.latest_per_key(df, ["k"], order)
    assert {tuple(r) for r in last.collect()} == {
        (1, day(1970, 1, 1), low), (2, day(2020, 2, 2), 7), (3, None, None)}
    assert {tuple(r) for r in ow.first_per_key(df, ["k"], order).collect()} == {
        (1, day(1969, 12, 31), high), (2, day(2020, 2, 1), high), (3, None, None)}
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Sort" not in plan


def test_latest_first_and_forward_fill(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, None), ("a", 3, 7.0), ("b", 1, None)],
                               "k string, o int, v double")
    assert {r["k"]: (r["o"], r["v"]) for r in ow.latest_per_key(df, ["k"], "o").collect()} == {
        "a": (3, 7.0), "b": (1, None)}
    assert {r["k"]: r["o"] for r in ow.first_per_key(df, ["k"], "o").collect()} == {"a": 1, "b": 1}
    text = df.withColumn("s", F.concat("k", F.col("o").cast("string")))
    assert {r["k"]: r["s"] for r in ow.latest_per_key(text, ["k"], "o").collect()} == {
        "a": "a3", "b": "b1"}
    filled = {(r["k"], r["o"]): r["v"] for r in ow.forward_fill(df, ["k"], "o", ["v"]).collect()}
    assert filled == {("a", 1): 5.0, ("a", 2): 5.0, ("a", 3): 7.0, ("b", 1): None}


def test_shares_add_up(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "k string, v double")
    assert {r["k"]: r["s"] for r in ow.share_of_total(df, "v", "s").collect()} == {
        "a": 0.25, "b": 0.75}


def test_top_k_prunes_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), "id")
    top = top_k_per_group(df, ["g"], 2, F.col("id").desc())
    assert sorted((r["g"], r["id"]) for r in top.collect()) == [
        (0, 996), (0, 999), (1, 994), (1, 997), (2, 995), (2, 998)]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_scope_without_rows_borrows(spark):
    df = spark.createDataFrame([("A", 1), ("A", 2), ("ALL", 9), ("ALL", 8), ("ALL", 7)],
                               "scope string, score int")
    scopes = spark.createDataFrame([("A",), ("B",)], "scope string")
    rows = top_k_with_fallback(df, scopes, "scope", "ALL", 2, F.col("score").desc()).collect()
    assert sorted((r["scope"], r["source_scope"], r["score"]) for r in rows) == [
        ("A", "A", 1), ("A", "A", 2), ("B", "ALL", 8), ("B", "ALL", 9)]


def test_exact_helpers(spark):
    df = spark.createDataFrame([(0.145, 1, 32, 0.29), (2.5, 0, 5, -1.1)],
                               "x double, a int, b int, c double")
    r = df.select(exact.round_half_up("x", 2).alias("r"),
                  exact.rounded_int_ratio("a", "b", 4).alias("q"),
                  exact.hundredths("c").alias("h")).collect()
    assert [tuple(x) for x in r] == [(0.15, 0.0313, 29), (2.5, 0.0, -110)]


def test_text_helpers(spark):
    df = spark.createDataFrame([(' "abc" ',), ("null",), (None,), ("",)], "s string")
    assert [r[0] for r in df.select(text.clean_label("s")).collect()] == [
        "abc", "ALL", "ALL", "ALL"]
    j = spark.createDataFrame([('so {"a": {"b": 1}} ok',), ("none",), ("} {",)], "s string")
    assert [r[0] for r in j.select(text.outer_braces("s")).collect()] == [
        '{"a": {"b": 1}}', None, None]
    n = spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),)], "x double")
    assert [r[0] for r in n.select(text.finite("x")).collect()] == [1.0, None, None]


def test_first_usable_prefers_rows(spark, tmp_path):
    empty, full = f"{tmp_path}/empty", f"{tmp_path}/full"
    spark.range(0).write.parquet(empty)
    spark.range(3).write.parquet(full)
    assert first_usable(spark, [f"{tmp_path}/none", empty, full]).count() == 3
    assert first_usable(spark, [empty]).count() == 0
    with pytest.raises(ValueError):
        first_usable(spark, [f"{tmp_path}/none"])


def test_standard_names_keep_existing_columns(spark):
    df = spark.createDataFrame([(1, 2)], "score int, importance_score int")
    assert with_standard_names(df, {"score": "importance_score"}).columns == [
        "score", "importance_score"]
    assert with_standard_names(df.drop("importance_score"), {"score": "importance_score"},
                               {"series": "ALL"}).collect()[0].asDict() == {
        "importance_score": 1, "series": "ALL"}


def test_partition_overwrite_replaces_only_what_it_holds(spark, tmp_path):
    path = f"{tmp_path}/t"
    replace_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), path, ["p"])
    replace_partitions(spark.createDataFrame([(3, "b")], "v int, p string"), path, ["p"])
    assert sorted((r["p"], r["v"]) for r in spark.read.parquet(path).collect()) == [
        ("a", 1), ("b", 3)]


def hot_tables(spark, tmp_path, rows=60000):
    """A third of all lines on one part, one supplier and one order; a third of the orders
    on one customer."""
    lines = spark.range(rows).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5000).alias("l_orderkey"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 700).alias("l_partkey"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 40).alias("l_suppkey"),
        F.lit(1).alias("l_linenumber"), F.lit(2.0).alias("l_quantity"),
        F.lit(10.5).alias("l_extendedprice"), F.lit(0.1).alias("l_discount"),
        F.lit(0.0).alias("l_tax"), F.lit("A").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        F.lit("2000-01-05").cast("timestamp_ntz").alias("l_shipdate"))
    orders = spark.range(5000).select(
        F.col("id").alias("o_orderkey"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 90).alias("o_custkey"),
        F.lit("O").alias("o_orderstatus"), F.lit(100.25).alias("o_totalprice"),
        F.lit("2000-01-02").cast("timestamp_ntz").alias("o_orderdate"),
        F.lit("1-URGENT").alias("o_orderpriority"))
    part = spark.range(700).select(
        F.col("id").alias("p_partkey"), F.lit("p").alias("p_name"), F.lit("b").alias("p_brand"),
        F.lit("PROMO").alias("p_type"), F.lit(1).alias("p_size"), F.lit(5.0).alias("p_retailprice"))
    customer = spark.range(90).select(
        F.col("id").alias("c_custkey"), F.lit("c").alias("c_name"),
        (F.col("id") % 4).cast("int").alias("c_nationkey"), F.lit(1.0).alias("c_acctbal"),
        F.lit("BUILDING").alias("c_mktsegment"))
    nation = spark.range(4).select(
        F.col("id").cast("int").alias("n_nationkey"),
        F.concat(F.lit("N"), F.col("id").cast("string")).alias("n_name"), F.lit(0).alias("n_regionkey"))
    for name, df in {"lineitem": lines, "orders": orders, "part": part, "customer": customer,
                     "nation": nation}.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_hot_keys_stay_exact_and_the_hot_part_is_split(spark, tmp_path):
    from regiocast.sources import Tables
    t = Tables(spark, hot_tables(spark, tmp_path))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        a = staging.customer_activity(t)
        got = {r["region"]: r for r in a.collect()}
        lines = staging.order_lines(t)
        lines.collect()
        plan = lines._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plan
    assert sum(r["total_tx_count"] for r in got.values()) == 60000
    assert sum(r["move_in"] for r in got.values()) == 5000
    assert abs(sum(r["promo_sales"] for r in got.values()) - 60000 * 10.5 * 0.9) < 1e-6


def test_top_k_above_the_threshold_of_spark(spark):
    df = spark.range(30_000).select((F.col("id") % 3 == 2).cast("int").alias("g"), "id")
    got = top_k_per_group(df, ["g"], 5000, F.col("id").desc())
    rows = {r.g: r for r in got.groupBy("g").agg(F.count("*").alias("n"), F.min("id").alias("lo"))
            .collect()}
    assert rows[0].n == rows[1].n == 5000
    assert rows[1].lo == 29_999 - 3 * 4999


def test_lines_of_unknown_parts_count(spark, tables):
    class Orphans:
        lineitem, part = tables.lineitem, tables.part.where("p_partkey % 2 = 0")

    for categories in (True, False):
        n = staging.order_lines(Orphans, categories).agg(F.sum("lines")).first()[0]
        assert n == tables.lineitem.count()


def test_totals_do_not_read_the_parts(spark, tables):
    from regiocast.catalog import forecasts

    plan = forecasts.training(tables)._jdf.queryExecution().optimizedPlan().toString()
    assert "p_partkey" not in plan and "l_orderkey" in plan


def test_cluster_needs_a_shared_folder(monkeypatch):
    import types

    from regiocast.session import shared_dir
    away = types.SimpleNamespace(
        conf=types.SimpleNamespace(get=lambda k, d=None: d, set=lambda k, v: None),
        sparkContext=types.SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError):
        shared_dir(away)
