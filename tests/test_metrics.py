"""Metrics over related tables, on tables small enough to check by hand."""

import pytest

from regiocast.plans.metrics import (Catalogue, Dimension, Metric, Relationship, mart_metrics,
                                     shop_catalogue)


def shop(spark, orders=None, lines=None):
    frames = {
        "orders": spark.createDataFrame(orders if orders is not None else [
            (1, 10, 100.0), (2, 10, 50.0), (3, 11, 7.0), (4, None, 3.0), (5, 99, 1.0)],
            "ok bigint, ck bigint, price double"),
        "lines": spark.createDataFrame(lines if lines is not None else [
            (1, 2), (1, 3), (1, 4), (2, 1), (3, 1), (8, 100), (None, 1000)], "ok bigint, n int"),
        "customer": spark.createDataFrame(
            [(10, "a", 1), (11, "b", 2), (11, "b", 2), (11, "c", 1), (None, "x", 1)],
            "ck bigint, seg string, nk int"),
        "nation": spark.createDataFrame([(1, "N1"), (2, "N2")], "nk int, name string"),
        "weather": spark.createDataFrame([("N1", 5.0), ("N9", 8.0)], "place string, rain double"),
    }
    return Catalogue({k: (lambda f=f: f) for k, f in frames.items()}, [
        Relationship("lines", "orders", (("ok", "ok"),)),
        Relationship("orders", "customer", (("ck", "ck"),)),
        Relationship("customer", "nation", (("nk", "nk"),)),
    ], {
        "seg": Dimension({"customer": "seg"}, ("segment",)),
        "place": Dimension({"nation": "name", "weather": "place"}),
        "order": Dimension({"orders": "ok"}),
    }, {
        "value": Metric("total", "orders", "price", synonyms=("order value",)),
        "orders_": Metric("count", "orders", "ok"), "pieces": Metric("total", "lines", "n"),
        "lines_": Metric("count", "lines", "n"), "rain": Metric("total", "weather", "rain"),
        "per_line": Metric("ratio", of=("value", "lines_")),
        "part": Metric("share", of=("value",)),
    })


def rows(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_two_tables_without_double_counts(spark):
    """Order 1 has three lines and counts once; orphans and null keys group under null; a customer
    that occurs three times is one, the least."""
    got = rows(shop(spark).query(["Order  Value", "pieces", "per_line", "part"], ["segment"]))
    assert got == {"a": (150.0, 10.0, 37.5, 150 / 161), "b": (7.0, 1.0, 7.0, 7 / 161),
                   None: (4.0, 1100.0, 2.0, 4 / 161)}


def test_tables_meet_by_a_shared_dimension(spark):
    got = rows(shop(spark).query(["value", "orders_", "rain"], ["place"]))
    assert got == {"N1": (150.0, 2, 5.0), "N2": (7.0, 1, None), "N9": (None, 0, 8.0),
                   None: (4.0, 2, None)}


def test_conditions_and_grand_totals(spark):
    found = shop(spark)
    assert [tuple(r) for r in found.query(["value", "pieces"]).collect()] == [(161.0, 1111.0)]
    got = found.query(["value", "pieces"], where={"segment": lambda s: s == "a"})
    assert [tuple(r) for r in got.collect()] == [(150.0, 10.0)]
    assert rows(found.query(["value"], ["segment"], {"order": lambda o: o < 3})) == {"a": (150.0,)}


def test_empty_tables(spark):
    found = shop(spark, orders=[], lines=[])
    assert found.query(["value", "part"], ["seg"]).collect() == []
    assert [tuple(r) for r in found.query(["value", "orders_", "per_line"]).collect()] == [
        (None, 0, None)]


def test_sums_come_before_joins(spark):
    plan = shop(spark).query(["pieces"], ["place"])._jdf.queryExecution().optimizedPlan().toString()
    steps = [line.strip(" :+-") for line in plan.splitlines()]
    left = [i for i, s in enumerate(steps) if s.startswith("Join")]
    assert len(left) == 3
    for a, b in zip(left, [*left[1:], len(steps)]):
        assert any(s.startswith("Aggregate") for s in steps[a + 1:b])


def test_unknown_and_ambiguous(spark):
    found = shop(spark)
    with pytest.raises(KeyError):
        found.query(["no such thing"])
    with pytest.raises(ValueError, match="no way"):
        found.query(["rain"], ["segment"])
    with pytest.raises(ValueError, match="customer > nation"):
        found.relationships.append(Relationship("orders", "nation", (("ck", "nk"),)))
        found.query(["value"], ["place"])
    with pytest.raises(ValueError, match="names"):
        Catalogue({}, [], {"x": Dimension({}, ("same",))}, {"y": Metric("total", "t", "1",
                                                                        synonyms=("Same",))})


def test_mart_metrics():
    kinds = {n: m.kind for n, m in mart_metrics(["total_sales", "avg_income"]).items()}
    assert kinds == {"total_sales": "total", "avg_income": "ratio", "avg_income_total": "total",
                     "avg_income_rows": "count"}
    assert shop_catalogue(None).resolve("Market Segment") == "segment"
