"""Marts asked for some columns read what these need, and give them the same values."""

import os

import pytest

from regiocast.catalog import load_all
from regiocast.plans import mart
from regiocast.sources.tables import Tables

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("build, all_columns", [
    (mart.base_mart, mart.BASE_COLUMNS), (mart.extended_mart, mart.EXTENDED_COLUMNS)])
def test_same_values(spark, build, all_columns):
    t = Tables(spark, SF)
    used = [c for c in all_columns if c in mart.SALES_COLUMNS]
    some, whole = build(t, used), build(t).select(*used)
    assert some.dtypes == whole.dtypes
    assert sorted(map(str, some.collect())) == sorted(map(str, whole.collect()))


@pytest.mark.parametrize("name", [
    "sales_per_business_day", "why_one_region_leads", "sales_trend", "metrics_mart_and_forecast"])
def test_no_parts_and_no_line_sums_written(spark, monkeypatch, name):
    """The sums per order and supplier, which need parts, are not made for these."""
    def refused(*_):
        raise AssertionError("line sums are not needed")

    monkeypatch.setattr(mart, "line_facts", refused)
    read = []
    monkeypatch.setattr(Tables, "read", lambda self, table, plain=Tables.read: (
        read.append(table), plain(self, table))[1])
    load_all()[name](spark, SF).collect()
    assert read.count("lineitem") == 1 and not {"part", "supplier"} & set(read)
