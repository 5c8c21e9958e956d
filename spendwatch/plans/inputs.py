"""All domain inputs of one scale factor, derived lazily from the test tables."""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import DataFrame, SparkSession

from spendwatch.operators import alerts, backtest, baseline, pricing, scoring, sinks, usage
from spendwatch.params import Params
from spendwatch.session import pin_utc, scratch_path
from spendwatch.sources import fixtures as fx


class Inputs:
    """Domain frames for ``sf_dir``; every accessor returns a lazy DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        pin_utc(spark)
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.rules = fx.exclusion_rules()

    # raw domain tables --------------------------------------------------------
    @functools.cached_property
    def usage(self) -> DataFrame:
        return fx.usage(self.spark, self.sf_dir)

    @functools.cached_property
    def prices(self) -> DataFrame:
        return fx.prices(self.spark)

    @functools.cached_property
    def history(self) -> DataFrame:
        return fx.clusters_history(self.spark, self.sf_dir)

    @functools.cached_property
    def card(self) -> DataFrame:
        return fx.rate_card(self.spark, self.sf_dir)

    @functools.cached_property
    def aliases(self) -> DataFrame:
        return fx.fleet_aliases(self.spark)

    @functools.cached_property
    def inventory(self) -> DataFrame:
        return fx.inventory(self.spark, self.sf_dir)

    @functools.cached_property
    def inventory_workers(self) -> DataFrame:
        return fx.inventory_workers(self.spark, self.sf_dir)

    @functools.cached_property
    def directory(self) -> DataFrame:
        return fx.directory(self.spark, self.sf_dir)

    def send_log(self, p: Params = fx.ALERT_PARAMS) -> DataFrame:
        return fx.send_log(self.spark, self.sf_dir, p)

    # derived stages -------------------------------------------------------------
    def excluded(self, p: Params, days: int) -> DataFrame:
        active = usage.active_clusters(self.usage, p, days)
        return usage.resolve_exclusions(self.rules, self.history, active, p.broadcast_max_rows)

    def excluded_keys(self, p: Params) -> DataFrame:
        return usage.exclusion_keys(self.rules, self.history, p.broadcast_max_rows)

    def priced(self, p: Params = fx.USAGE_PARAMS) -> DataFrame:
        return usage.priced_usage(self.usage, self.prices, self.excluded_keys(p), p)

    def baseline(self, p: Params = fx.USAGE_PARAMS) -> DataFrame:
        return baseline.workspace_baseline(self.priced(p), p)

    def customer_rates(self, p: Params = fx.USAGE_PARAMS) -> DataFrame:
        return pricing.customer_rates(self.priced(p))

    def rates(self, p: Params = fx.SCORING_PARAMS) -> DataFrame:
        return pricing.pricing_rates(self.card, self.customer_rates(p), self.aliases, p)

    # tables written by the daily refresh and read by the monitor -----------------
    def _refresh(self, p: Params) -> None:
        """The daily refresh: one pass over priced usage, summed and written,
        feeds both ``pricing_rates`` and ``workspace_baseline``."""
        cache = self.__dict__.setdefault("_tables", {})
        if ("rates", p) in cache:
            return
        daily = self._written("priced-daily", usage.priced_daily(self.priced(p)))
        rates = pricing.pricing_rates(self.card, pricing.customer_rates(daily), self.aliases, p)
        cache[("rates", p)] = self._written("refresh-rates", rates)
        cache[("baseline", p)] = self._written("refresh-baseline", baseline.workspace_baseline(daily, p))

    def table(self, name: str, frame: DataFrame) -> DataFrame:
        """``frame`` written once for several readers."""
        return self._written(name, frame)

    def _written(self, name: str, frame: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, name)
        sinks.overwrite(frame, path)
        return self.spark.read.parquet(path)

    def rates_table(self, p: Params = fx.SCORING_PARAMS) -> DataFrame:
        self._refresh(p)
        return self._tables[("rates", p)]

    def baseline_table(self, p: Params = fx.SCORING_PARAMS) -> DataFrame:
        self._refresh(p)
        return self._tables[("baseline", p)]

    def scores(self, p: Params = fx.SCORING_PARAMS) -> DataFrame:
        """The monitor reads the refreshed ``pricing_rates`` and
        ``workspace_baseline`` tables, as the scheduled jobs do."""
        return scoring.score_inventory(self.inventory, self.rates_table(p), self.baseline_table(p), self.rules, p)

    def alerts(self, p: Params = fx.ALERT_PARAMS) -> DataFrame:
        return alerts.alerts_latest(self.scores(), p)

    def to_send(self, p: Params = fx.ALERT_PARAMS) -> DataFrame:
        return alerts.alerts_to_send(self.alerts(p), self.send_log(p), p)

    def hourly(self, p: Params = fx.BACKTEST_PARAMS) -> DataFrame:
        return usage.hourly_spend(self.usage, self.prices, self.excluded_keys(p), p)

    def backtest(self, p: Params = fx.BACKTEST_PARAMS) -> DataFrame:
        return backtest.backtest(self.usage, self.prices, self.excluded_keys(p), p)


def older(p: Params, days: int) -> Params:
    return p.replace(as_of=p.as_of - dt.timedelta(days=days))
