"""Full build: marts, forecasts, comparison and shares written as tables, each step logged."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiocast.plans import backtest as bt, decide, exog, fixed, forecast as fc, mart
from regiocast.plans.calendar import order_calendar
from regiocast.sources.sinks import replace_table
from regiocast.sources.tables import Tables
from regiocast.streaming.refresh import freshness, health_rows

LOG = ("component string, component_type string, row_count bigint, refreshed_at timestamp_ntz")
KINDS = {"signal_mart": "MART", "allocation": "DOWNSTREAM", "actual_vs_forecast": "DOWNSTREAM"}


@dataclass
class Build:
    """Writes every table below ``root``; later steps read what earlier ones wrote."""
    tables: Tables
    root: str
    done: list[str] = field(default_factory=list)

    def _write(self, name: str, df: DataFrame, layout: list[str] | None = None) -> DataFrame:
        """``layout`` range-partitions and sorts the files, so that a filter on these columns
        skips files and row groups without a directory per value."""
        if layout:
            df = df.repartitionByRange(*layout).sortWithinPartitions(*layout)
        written = replace_table(df, f"{self.root}/{name}")
        (written.agg(F.count(F.lit(1)).alias("row_count"))
         .select(F.lit(name).alias("component"),
                 F.lit(KINDS.get(name, "MODEL")).alias("component_type"), "row_count",
                 F.current_timestamp().cast("timestamp_ntz").alias("refreshed_at"))
         .write.mode("append").parquet(f"{self.root}/refresh_log"))
        self.done.append(name)
        return written

    def run(self) -> Build:
        """Marts once from the raw tables, everything else from the written mart."""
        features = self._write("signal_mart", mart.signal_mart(self.tables), ["ym", "region"])
        through = fc.complete_through(self.tables.orders, "o_orderdate")
        train = fc.training_frame(features, through=through)
        result = self._write("forecast_results", fc.forecast(train))
        self._write("actual_vs_forecast", fc.actual_and_forecast(train, result))
        self._compare_models(train)
        self._with_features(exog.panel(features, through=through))
        self._write("allocation", decide.next_month_share(result))
        return self

    def _compare_models(self, train: DataFrame) -> None:
        """Rolling backtest of the plain models and what follows from it."""
        keys = ["model_name", "series"]
        predictions = self._write("backtest_predictions", bt.backtest(train, models=bt.LADDER))
        metrics = self._write("evaluation_metrics", bt.evaluation_metrics(predictions, keys))
        wide = bt.wide_metrics(metrics, keys)
        self._write("model_summary", bt.model_summary(
            wide, {m: i for i, m in enumerate(bt.LADDER, start=1)}))
        self._write("best_model", bt.best_model(wide))

    def _with_features(self, panel: DataFrame) -> None:
        """Importance, forecast with exogenous features, and nested feature sets."""
        self._write("feature_importance", exog.feature_importance(panel))
        calendar = order_calendar(self.tables, extra_months=fixed.HORIZON)
        self._write("exog_forecast", exog.exog_forecast(panel, exog.future_exog(panel, calendar)))
        ablation = self._write("ablation_results", exog.ablation_wide(panel))
        self._write("ablation_summary", bt.model_summary(
            ablation.drop("feature_set"), {m: i for i, m in enumerate(exog.STEPS, start=1)}))

    def read(self, name: str) -> DataFrame:
        return self.tables.spark.read.parquet(f"{self.root}/{name}")

    def log(self) -> DataFrame:
        return self.tables.spark.read.schema(LOG).parquet(f"{self.root}/refresh_log")

    def health(self, target_seconds: int = 3600, as_of=None) -> DataFrame:
        """Freshness of each component against the refresh target."""
        return freshness(self.log(), target_seconds, as_of)

    def health_rows(self, target_seconds: int = 3600, as_of=None) -> DataFrame:
        """A health row per component, see :func:`regiocast.streaming.refresh.health_rows`."""
        return health_rows(self.log(), target_seconds, as_of)

