"""Readers: typed Parquet tables, first usable candidate, schema normalisation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


class Tables:
    """Lazy access to one directory of Parquet tables: ``Tables(spark, path).orders``.

    Every table is read with its declared schema, so no footer is opened for inference, and
    column pruning and filter pushdown reach the scan.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.path}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in SCHEMAS:
            return self.read(name)
        raise AttributeError(name)


def first_usable(spark: SparkSession, candidates: Iterable[str]) -> DataFrame:
    """First candidate path that exists and holds rows; else the first that exists."""
    empty = None
    for path in candidates:
        try:
            df = spark.read.parquet(path)
        except AnalysisException:
            continue
        if not df.isEmpty():
            return df
        empty = df if empty is None else empty
    if empty is None:
        raise ValueError("no candidate source can be read")
    return empty


def with_standard_names(df: DataFrame, variants: Mapping[str, str],
                        defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Rename known variants (only where the standard name is absent), add missing keys."""
    for variant, standard in variants.items():
        if variant in df.columns and standard not in df.columns:
            df = df.withColumnRenamed(variant, standard)
    for name, value in (defaults or {}).items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(value))
    return df


def present(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Subset of ``columns`` that the frame really has, in the asked order."""
    return df.select(*[c for c in columns if c in df.columns])


def empty_like(spark: SparkSession, schema: str) -> DataFrame:
    """Typed table without rows."""
    return spark.createDataFrame([], schema)
