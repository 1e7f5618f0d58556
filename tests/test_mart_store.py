import pytest
from pyspark.sql import functions as F

from regiocast.plans import mart
from regiocast.session import scratch_path
from regiocast.streaming import mart_store as ms
from regiocast.streaming import refresh as rf


def equal(store, tables, orders, lines):
    """The refreshed mart against the mart of the rows merged so far."""
    spark, root = tables.spark, scratch_path(tables.spark, "rows")
    orders.write.parquet(f"{root}/orders.parquet")
    lines.write.parquet(f"{root}/lineitem.parquet")
    for name in ("customer", "supplier", "part", "nation"):
        getattr(tables, name).write.parquet(f"{root}/{name}.parquet")
    full = mart.base_mart(type(tables)(spark, root))
    return rf.compare(store.read(), full, mart.KEY).filter("NOT same").isEmpty()


def thirds(df, key):
    return [df.filter(F.pmod(key, F.lit(3)) == i) for i in range(3)]


def test_late_repeated_and_unordered_batches(spark, tables, monkeypatch):
    monkeypatch.setattr(ms, "COMPACT", 3)
    o, l = thirds(tables.orders, "o_orderkey"), thirds(tables.lineitem, "l_linenumber")
    store = ms.MartStore(tables, scratch_path(spark, "store")).create()
    with pytest.raises(ValueError):
        store.read()
    store.apply("lineitem", l[0], 0)          # before any order
    assert store.read().isEmpty()
    store.apply("orders", o[1], 0)            # a third of them arrives
    store.apply("lineitem", l[1], 1)          # merged into a base after this
    assert store.current().base == 0 and store.current().deltas == ()
    assert equal(store, tables, o[1], l[0].unionByName(l[1]))
    before = sorted(map(tuple, store.read().collect()), key=repr)
    number = store.current().number
    for stream, batch, n in (("lineitem", l[1], 1), ("orders", o[1], 0), ("lineitem", l[0], 0)):
        store.apply(stream, batch, n)         # repeated
    assert store.current().number == number
    assert sorted(map(tuple, store.read().collect()), key=repr) == before
    store.apply("orders", o[0], 1)
    store.apply("orders", o[2], 2)
    store.apply("lineitem", l[2], 2)
    assert equal(store, tables, tables.orders, tables.lineitem)
    # nothing waits any more once the base is merged
    assert store.merged(store.current(), "waiting").filter("lines <> 0").isEmpty()


def test_readers_see_whole_versions(spark, tables, monkeypatch):
    o, l = thirds(tables.orders, "o_orderkey"), tables.lineitem
    store = ms.MartStore(tables, scratch_path(spark, "store")).create()
    store.apply("lineitem", l, 0)
    store.apply("orders", o[0], 0)
    pinned = store.current()
    table, shares = store.read("mart", pinned), store.read("shares", pinned)
    before = sorted(map(tuple, table.collect()), key=repr), sorted(map(tuple, shares.collect()))
    # a step that fails before its manifest leaves the old version in place
    commit = ms.MartStore._commit
    monkeypatch.setattr(ms.MartStore, "_commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        store.apply("orders", o[1], 1)
    monkeypatch.setattr(ms.MartStore, "_commit", commit)
    assert store.current() == pinned
    assert sorted(map(tuple, store.read().collect()), key=repr) == before[0]
    store.apply("orders", o[1], 1)
    store.apply("orders", o[2], 2)
    assert (sorted(map(tuple, table.collect()), key=repr),
            sorted(map(tuple, shares.collect()))) == before
    assert equal(store, tables, tables.orders, l)
    now = store.read("shares").collect()
    assert abs(sum(r["share"] for r in now) - 1) < 1e-9


def test_folders_do_not_grow_with_batches(spark, tables, monkeypatch):
    import os
    monkeypatch.setattr(ms, "COMPACT", 2)
    monkeypatch.setattr(ms, "KEEP", 1)
    store = ms.MartStore(tables, scratch_path(spark, "store")).create()
    counts = []
    for n in range(8):
        store.apply("orders", tables.orders.filter(F.pmod("o_orderkey", F.lit(8)) == n), n)
        if n >= 5:
            counts.append(sum(len(d) for _, d, _ in os.walk(store.root)))
    assert len(set(counts)) == 1
    assert store.current().merged("orders") == 7 and store.versions().count() <= 2


def test_one_pass_over_line_items(spark, tables):
    from regiocast.plans.staging import line_facts
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = line_facts(tables.lineitem, tables.part)._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    physical = plan[plan.index("== Physical Plan =="):]
    assert physical.count("lineitem.parquet") == 1
    assert physical.count("Exchange hashpartitioning(l_partkey") == 1
    for frame in (mart.base_mart(tables),):
        text = frame._jdf.queryExecution().toString()
        assert "lineitem.parquet" not in text[text.index("== Physical Plan =="):]


def test_wide_rows_move_once(spark, tables):
    """Customer months meet the customers without a second exchange; an order that came leaves
    the waiting rows by its count alone; late lines of known orders do not wait."""
    o, l = thirds(tables.orders, "o_orderkey"), tables.lineitem
    store = ms.MartStore(tables, scratch_path(spark, "store")).create()
    store.apply("lineitem", l, 0)
    store.apply("orders", o[0], 0)
    v = store.current()
    left = store.state(v, "waiting").filter("lines < 0")
    assert not left.isEmpty() and left.filter("net IS NOT NULL OR qty IS NOT NULL").isEmpty()
    came = o[0].join(store.merged(v, "waiting").filter("lines <> 0"),
                     F.col("o_orderkey") == F.col("l_orderkey"))
    assert came.isEmpty()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        months = ms.customer_activity(tables, months=store.merged(v, "customer", None, "o_custkey"))
        plan = months._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan[plan.index("== Physical Plan =="):].count("hashpartitioning(o_custkey") == 1


def test_first_orders_are_moved_for_their_sums_only(spark, tables):
    store = ms.MartStore(tables, scratch_path(spark, "store")).create()
    frames = store._orders(tables.orders, store.current())
    assert set(frames) == {"customer", "keys"}
    assert "Exchange" not in frames["keys"]._jdf.queryExecution().executedPlan().toString()
    store.apply("orders", tables.orders.unionByName(tables.orders), 0)
    keys = store.merged(store.current(), "keys", None, "o_orderkey")
    assert keys.count() == tables.orders.count()
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
