"""Metrics over several related tables: join paths from declared relationships, sums before joins.

A query names metrics and dimensions. Every table that a metric is measured on is added up by
itself: first to the keys of its relationships and its own dimensions, then again behind every
join, so that a join meets sums and never raw rows, and a row is counted once whatever else is
asked. The tables' sums meet in one union grouped by the dimensions, not in a join.

Rows without a partner keep a null dimension. Null dimensions form a group. Keys that occur more
than once on the one side count as one row there, the least. Sums are decimals, so results do not
depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiocast.operators.windows import share_of_total
from regiocast.session import cut_lineage
from regiocast.sources.tables import Tables


@dataclass(frozen=True)
class Relationship:
    """Rows of ``many`` belong to at most one row of ``one``, by equal columns."""
    many: str
    one: str
    columns: tuple[tuple[str, str], ...]


@dataclass(frozen=True)
class Dimension:
    """A value to group by, as an expression over each table that holds it."""
    at: Mapping[str, str]
    synonyms: tuple[str, ...] = ()


@dataclass(frozen=True)
class Metric:
    """``total`` and ``count`` of an expression over a table, ``ratio`` of two other metrics, or
    ``share`` of another metric in its sum over the result."""
    kind: str
    table: str = ""
    expr: str = ""
    of: tuple[str, ...] = ()
    synonyms: tuple[str, ...] = ()


class Catalogue:
    """Tables (as functions, called when asked for), relationships, dimensions and metrics."""

    def __init__(self, tables: Mapping[str, Callable[[], DataFrame]],
                 relationships: Iterable[Relationship], dimensions: Mapping[str, Dimension],
                 metrics: Mapping[str, Metric]):
        self.tables, self.relationships = dict(tables), list(relationships)
        self.dimensions, self.metrics = dict(dimensions), dict(metrics)
        self._terms: dict[str, str] = {}
        for name, entry in [*self.dimensions.items(), *self.metrics.items()]:
            for term in (name, *entry.synonyms):
                if self._terms.setdefault(term.lower(), name) != name:
                    raise ValueError(f"{term!r} names {self._terms[term.lower()]} and {name}")

    def resolve(self, term: str) -> str:
        """Name of a metric or dimension by itself or by a synonym."""
        return self._terms[" ".join(term.lower().split())]

    def measured(self, name: str) -> set[str]:
        """The metrics measured on tables that a metric is made of."""
        metric = self.metrics[name]
        return {name} if metric.table else set().union(*map(self.measured, metric.of))

    def path(self, table: str, dimension: str) -> list[Relationship]:
        """The one way along relationships, many to one, from a table to a dimension."""
        at = self.dimensions[dimension].at
        if table in at:
            return []

        def ways(start: str, seen: tuple[str, ...]) -> list[list[Relationship]]:
            found = []
            for r in self.relationships:
                if r.many == start and r.one not in seen:
                    found += [[r]] if r.one in at else [
                        [r, *rest] for rest in ways(r.one, (*seen, r.one))]
            return found

        found = ways(table, (table,))
        if len(found) != 1:
            by = [" > ".join(r.one for r in way) for way in found] or "no way"
            raise ValueError(f"{table} to {dimension}: {by}")
        return found[0]

    def _summed(self, table: str, names: list[str], by: list[str],
                where: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
        asked = list(dict.fromkeys([*by, *where]))
        steps = list(dict.fromkeys(r for d in asked for r in self.path(table, d)))

        def giver(d: str) -> str:
            way = self.path(table, d)
            return way[-1].one if way else table

        def filtered(df: DataFrame, at: str) -> DataFrame:
            given = [d for d in where if giver(d) == at]
            for d in given:
                df = df.filter(where[d](F.col(f"d_{d}")))
            return df.drop(*[f"d_{d}" for d in given if d not in by])

        measures = [F.expr(self.metrics[n].expr).alias(f"m_{n}") for n in names]
        own = [F.expr(self.dimensions[d].at[table]).alias(f"d_{d}") for d in asked
               if giver(d) == table]
        own += [F.col(many).alias(f"k{i}_{j}") for i, r in enumerate(steps) if r.many == table
                for j, (many, _) in enumerate(r.columns)]
        df = filtered(self.tables[table]().select(*own, *measures), table)
        groups = [c for c in df.columns if not c.startswith("m_")]
        df = df.groupBy(*groups).agg(*[
            F.count(f"m_{n}").alias(f"m_{n}") if self.metrics[n].kind == "count" else
            F.sum(F.col(f"m_{n}").cast("decimal(28,6)")).alias(f"m_{n}") for n in names])
        for i, r in enumerate(steps):
            keys = [f"r{i}_{j}" for j in range(len(r.columns))]
            # of rows with one key the least by all that is declared, whatever is asked
            given = [F.expr(d.at[r.one]).alias(f"d_{n}") for n, d in self.dimensions.items()
                     if r.one in d.at]
            given += [F.col(c).alias(f"c_{c}") for c in dict.fromkeys(
                many for s in self.relationships if s.many == r.one for many, _ in s.columns)]
            one = self.tables[r.one]().select(
                *[F.col(c).alias(k) for k, (_, c) in zip(keys, r.columns)],
                F.struct(*given).alias("o")).groupBy(*keys).agg(F.min("o").alias("o")).select(
                *keys, *[F.col("o")[f"d_{d}"].alias(f"d_{d}") for d in asked if giver(d) == r.one],
                *[F.col("o")[f"c_{many}"].alias(f"k{m}_{j}") for m, s in enumerate(steps)
                  if s.many == r.one for j, (many, _) in enumerate(s.columns)])
            same = [F.col(f"k{i}_{j}") == F.col(k) for j, k in enumerate(keys)]
            df = df.join(one, reduce(lambda a, b: a & b, same), "left").drop(
                *keys, *[f"k{i}_{j}" for j in range(len(keys))])
            df = filtered(df, r.one)
            df = df.groupBy(*[c for c in df.columns if not c.startswith("m_")]).agg(
                *[F.sum(f"m_{n}").alias(f"m_{n}") for n in names])
        return df

    def query(self, metrics: Iterable[str], by: Iterable[str] = (),
              where: Mapping[str, Callable[[Column], Column]] | None = None) -> DataFrame:
        """One row per combination of the dimensions ``by``, one column per metric; both by name or
        synonym. ``where`` holds conditions by dimension, which must apply to every table measured.
        Counts of a table without rows for a combination are 0, totals null."""
        names, by = [self.resolve(m) for m in metrics], [self.resolve(d) for d in by]
        where = {self.resolve(d): condition for d, condition in (where or {}).items()}
        base = sorted(set().union(*map(self.measured, names)))
        tables = sorted({self.metrics[n].table for n in base})
        sums = [self._summed(table, [n for n in base if self.metrics[n].table == table], by, where)
                for table in tables]
        every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sums)
        df = every.groupBy(*[f"d_{d}" for d in by]).agg(*[F.sum(f"m_{n}").alias(f"m_{n}")
                                                          for n in base])

        def value(name: str) -> Column:
            metric = self.metrics[name]
            if metric.kind == "count":
                return F.coalesce(f"m_{name}", F.lit(0)).cast("bigint")
            if metric.kind == "total":
                return F.col(f"m_{name}").cast("double")
            a, b = (value(n).cast("double") for n in (*metric.of, *metric.of)[:2])
            return F.when(b != 0, a / b) if metric.kind == "ratio" else a

        df = df.select(*[F.col(f"d_{d}").alias(d) for d in by], *[value(n).alias(n) for n in names])
        shares = [n for n in names if self.metrics[n].kind == "share"]
        if shares:
            df = cut_lineage(df)  # read once more for every total
            for n in shares:
                df = share_of_total(df, n, n)
        return df.select(*by, *names)


MEAN_WORDS = ("avg", "share", "ratio", "idx", "pct", "score", "rate", "signal", "flag", "per",
              "prev", "next", "days", "weekend")


def mart_metrics(columns: Iterable[str]) -> dict[str, Metric]:
    """A metric for every measure of the mart: rates, indices and flags as mean, the rest as total."""
    found = {}
    for c in columns:
        if set(c.split("_")) & set(MEAN_WORDS):
            found |= {f"{c}_total": Metric("total", "mart", c), f"{c}_rows": Metric("count", "mart", c),
                      c: Metric("ratio", of=(f"{c}_total", f"{c}_rows"))}
        else:
            found[c] = Metric("total", "mart", c)
    return found


def shop_catalogue(t: Tables, mart: Callable[[], DataFrame] | None = None,
                   mart_columns: Iterable[str] = (),
                   forecast: Callable[[], DataFrame] | None = None) -> Catalogue:
    """Orders, line items, their customers, suppliers and parts; the mart and the forecast where
    given. Nations are a table of their own in each part they play."""
    tables = {name: (lambda name=name: t.read(name)) for name in (
        "orders", "lineitem", "customer", "supplier", "part")}
    tables |= {"customer_nation": lambda: t.nation, "supplier_nation": lambda: t.nation}
    region = {"customer_nation": "n_name", "mart": "region", "forecast": "series"}
    month = {"orders": "date_format(o_orderdate, 'yyyyMM')", "mart": "ym"}
    money = "l_extendedprice * (1 - l_discount)"
    metrics = {
        "order_value": Metric("total", "orders", "o_totalprice", synonyms=("order volume",)),
        "orders": Metric("count", "orders", "o_orderkey", synonyms=("number of orders",)),
        "value_per_order": Metric("ratio", of=("order_value", "orders")),
        "order_value_share": Metric("share", of=("order_value",), synonyms=("share of orders",)),
        "net_sales": Metric("total", "lineitem", money, synonyms=("discounted sales",)),
        "returned_sales": Metric("total", "lineitem", f"CASE WHEN l_returnflag = 'R' THEN {money} END"),
        "return_rate": Metric("ratio", of=("returned_sales", "net_sales"), synonyms=("returns",)),
        "net_sales_share": Metric("share", of=("net_sales",)),
        "lines": Metric("count", "lineitem", "l_linenumber"),
        "lines_per_order": Metric("ratio", of=("lines", "orders")),
    }
    if mart is not None:
        tables["mart"] = mart
        metrics |= mart_metrics(mart_columns)
    if forecast is not None:
        tables["forecast"] = forecast
        metrics |= {"next_forecast": Metric("total", "forecast", "forecast", synonyms=("outlook",)),
                    "forecast_share": Metric("share", of=("next_forecast",),
                                             synonyms=("share of the outlook",))}
    return Catalogue(tables, [
        Relationship("lineitem", "orders", (("l_orderkey", "o_orderkey"),)),
        Relationship("lineitem", "part", (("l_partkey", "p_partkey"),)),
        Relationship("lineitem", "supplier", (("l_suppkey", "s_suppkey"),)),
        Relationship("orders", "customer", (("o_custkey", "c_custkey"),)),
        Relationship("customer", "customer_nation", (("c_nationkey", "n_nationkey"),)),
        Relationship("supplier", "supplier_nation", (("s_nationkey", "n_nationkey"),)),
    ], {
        "region": Dimension(region, ("district", "customer region")),
        "month": Dimension(month, ("year month", "order month")),
        "segment": Dimension({"customer": "c_mktsegment"}, ("market segment",)),
        "priority": Dimension({"orders": "o_orderpriority"}, ("order priority",)),
        "brand": Dimension({"part": "p_brand"}),
        "supplier_region": Dimension({"supplier_nation": "n_name"}, ("region of the supplier",)),
    }, metrics)
