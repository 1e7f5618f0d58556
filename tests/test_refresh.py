import datetime as dt

from pyspark.sql import functions as F

from regiocast.session import scratch_path
from regiocast.streaming import refresh as rf


def split_orders(spark, tables):
    root = scratch_path(spark, "split")
    for i in range(3):
        (tables.orders.filter(F.pmod("o_orderkey", F.lit(3)) == i)
         .coalesce(1).write.parquet(f"{root}/orders_{i}.parquet"))
    return root


def test_three_batches_equal_the_full_recomputation(spark, tables):
    root = split_orders(spark, tables)
    job = rf.OrderRefresh(spark, scratch_path(spark, "job"))
    job.run(root, files_per_trigger=1)
    batches = spark.read.parquet(job.partials).select("batch_id").distinct().count()
    assert batches == 3
    full = rf.merge_partials(rf.order_partials(tables.orders))
    got = job.read().select(*full.columns)
    assert got.exceptAll(full).isEmpty() and full.exceptAll(got).isEmpty()
    assert rf.compare(job.read(), full, ["ym", "series"]).filter("NOT same").isEmpty()
    assert abs(sum(r["share"] for r in job.read_shares().collect()) - 1) < 1e-9


def test_a_repeated_batch_changes_nothing(spark, tables):
    job = rf.OrderRefresh(spark, scratch_path(spark, "job"))
    first = tables.orders.filter("o_orderkey % 2 = 0")
    second = tables.orders.filter("o_orderkey % 2 = 1")
    job.apply(first, 0)
    job.apply(second, 1)
    before = sorted(map(tuple, job.read().collect()))
    job.apply(second, 1)
    assert sorted(map(tuple, job.read().collect())) == before
    full = rf.merge_partials(rf.order_partials(tables.orders))
    assert job.read().select(*full.columns).exceptAll(full).isEmpty()


def test_only_touched_months_are_rebuilt(spark, tables):
    job = rf.OrderRefresh(spark, scratch_path(spark, "job"))
    jan = tables.orders.filter("o_orderdate >= timestamp_ntz'1996-01-01' AND"
                               " o_orderdate < timestamp_ntz'1996-02-01'")
    feb = tables.orders.filter("o_orderdate >= timestamp_ntz'1996-02-01' AND"
                               " o_orderdate < timestamp_ntz'1996-03-01'")
    job.apply(jan, 0)
    files = {r[0] for r in spark.read.parquet(f"{job.mart}/ym=199601").select(
        F.input_file_name()).distinct().collect()}
    job.apply(feb, 1)
    after = {r[0] for r in spark.read.parquet(f"{job.mart}/ym=199601").select(
        F.input_file_name()).distinct().collect()}
    assert files == after
    assert sorted(r["ym"] for r in job.read().select("ym").distinct().collect()) == [
        "199601", "199602"]


def test_freshness(spark):
    log = spark.createDataFrame(
        [("mart", dt.datetime(2024, 1, 1, 10)), ("mart", dt.datetime(2024, 1, 1, 12)),
         ("share", dt.datetime(2024, 1, 1, 12, 30)), ("model", dt.datetime(2024, 1, 1, 9))],
        "component string, refreshed_at timestamp_ntz")
    rows = {r["component"]: (r["refreshes"], r["lag_seconds"], r["state"])
            for r in rf.freshness(log, 3600).collect()}
    assert rows == {"mart": (2, 1800, "OK"), "share": (1, 0, "OK"), "model": (1, 12600, "LATE")}


def test_full_build_and_health(spark, tables):
    from regiocast.plans.build import Build
    build = Build(tables, scratch_path(spark, "build")).run()
    health = {r["component"]: r["state"] for r in build.health().collect()}
    assert health == {name: "OK" for name in build.done}
    assert len(health) == 12
    rows = {r["component"]: r for r in build.health_rows().collect()}
    assert rows["signal_mart"]["component_type"] == "MART"
    assert rows["signal_mart"]["target_lag"] == "3600 seconds"
    assert rows["allocation"]["target_lag"] == "DOWNSTREAM"
    assert rows["exog_forecast"]["model_version"] == "v1"
    assert {r["task_state"] for r in rows.values()} == {"SUCCEEDED"}
    # what is written is what the queries of the catalogue give
    from regiocast.catalog import load_all
    for name in ("forecast_results", "best_model", "model_summary", "feature_importance"):
        want = load_all()[name](spark, tables.path)
        got = build.read(name).select(*want.columns)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty(), name
    late = build.health(60, as_of=dt.datetime(2999, 1, 1)).collect()
    assert {r["state"] for r in late} == {"LATE"}
    assert build.read("allocation").count() > 0


def test_daily_sums_of_several_batches_without_a_state_store(spark, tables, monkeypatch):
    import os
    root, made = scratch_path(spark, "split"), []
    for i in range(3):
        (tables.events.filter(F.pmod("event_id", F.lit(3)) == i)
         .coalesce(1).write.parquet(f"{root}/events_{i}.parquet"))

    def path(spark, name):
        made.append(scratch_path(spark, name))
        return made[-1]

    monkeypatch.setattr(rf, "scratch_path", path)
    got = rf.daily_activity(spark, root, files_per_trigger=1)
    full = rf.daily_sums(tables.events).selectExpr(
        "day", "event_type", "events", "cast(cents AS double) / 100D AS value")
    assert got.exceptAll(full).isEmpty() and full.exceptAll(got).isEmpty()
    assert not os.path.exists(f"{made[0]}/checkpoint/state")
    assert len(os.listdir(f"{made[0]}/checkpoint/commits")) >= 3
