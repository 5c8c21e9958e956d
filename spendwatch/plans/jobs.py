"""The scheduled jobs, as functions over a table location.

Jobs meet only through tables (parquet under ``Tables.base``):

* ``baseline_refresh`` (daily): ``pricing_rates`` and ``workspace_baseline``
  from ``priced_daily``, the sums of one pass over priced usage;
* ``monitor`` (every 15 minutes): scores an inventory snapshot and adds it as
  the run ``p.as_of`` to ``cluster_scores`` (partitioned by ``snapshot_date``);
* ``route_alerts`` (every 30 minutes): latest alerts minus suppressed ones
  become the run's part of ``alert_outbox`` and of ``alert_send_log``;
* ``run_backtest`` (manual): replaces ``backtest_results``.

All but the outbox and the log change in one step (``operators.published``): a job
that reads while another writes sees the version before or after, a failed job
leaves the tables as they were, and a repeated run replaces its own rows.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from spendwatch import schemas as S
from spendwatch.functions.columns import instant
from spendwatch.functions.rules import ExclusionRules
from spendwatch.operators import alerts, backtest, baseline, pricing, published, scoring, sinks, usage
from spendwatch.params import Params
from spendwatch.session import require_utc, written


@dataclasses.dataclass(frozen=True)
class Tables:
    base: str

    def path(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/{name}"


def baseline_refresh(spark: SparkSession, t: Tables, usage_df: DataFrame, prices: DataFrame,
                     history: DataFrame, card: DataFrame, aliases: DataFrame, rules: ExclusionRules,
                     p: Params) -> dict[str, int]:
    require_utc(spark)
    excluded = usage.exclusion_keys(rules, history, p.broadcast_max_rows)
    counts = Observation("priced")
    priced = usage.priced_usage(usage_df, prices, excluded, p).observe(counts, F.count(F.lit(1)).alias("rows"))
    # SC8: both tables read the sums from the shared table, not the usage again.
    priced_daily = usage.priced_daily(priced)
    published.publish(priced_daily, t.path("priced_daily"))
    daily = published.current(spark, t.path("priced_daily"), priced_daily.schema)
    rows = {"priced_rows": counts.get["rows"]}
    for name, frame in (("workspace_baseline", baseline.workspace_baseline(daily, p)),
                        ("pricing_rates", pricing.pricing_rates(card, pricing.customer_rates(daily), aliases, p))):
        # AG14: counted while written.
        seen = Observation(name)
        published.publish(frame.observe(seen, F.count(F.lit(1)).alias("rows")), t.path(name))
        rows[f"{name}_rows"] = seen.get["rows"]
    return rows


def monitor(spark: SparkSession, t: Tables, inventory: DataFrame, rules: ExclusionRules, p: Params) -> None:
    """Stops without a baseline: a mistyped path must not mark every cluster
    as unknown.  Repeated with one ``as_of`` it replaces that run's rows."""
    require_utc(spark)
    rates = published.current(spark, t.path("pricing_rates"), S.PRICING_RATES)
    base = published.current(spark, t.path("workspace_baseline"), S.WORKSPACE_BASELINE)
    if base.limit(1).count() == 0:
        raise ValueError(f"no baseline rows under {t.path('workspace_baseline')}; run baseline_refresh first")
    scores = scoring.score_inventory(inventory, rates, base, rules, p)
    published.append_run(scores, t.path("cluster_scores"), run_name(p), "snapshot_date")


def run_name(p: Params) -> str:
    return f"{p.as_of:%Y%m%dT%H%M%S%f}"


def read_scores(spark: SparkSession, t: Tables) -> DataFrame:
    return published.current_runs(spark, t.path("cluster_scores"), S.CLUSTER_SCORES).drop(published.RUN)


def route_alerts(spark: SparkSession, t: Tables, directory: DataFrame, p: Params) -> DataFrame:
    """Writes this run's outbox and its part of the send log, both keyed by
    ``p.as_of`` and overwritten; returns the outbox.  A run repeated with the
    same ``as_of`` ignores its own log rows, so both come out identical."""
    require_utc(spark)
    if not p.alert_channel:
        raise ValueError("route_alerts needs Params.alert_channel")
    run = run_name(p)
    scores = read_scores(spark, t)
    log = sinks.read_send_log(spark, t.path("alert_send_log")).where(F.col("sent_at") != instant(p.as_of))
    base = published.current(spark, t.path("workspace_baseline"), S.WORKSPACE_BASELINE)
    to_send = alerts.alerts_to_send(alerts.alerts_latest(scores, p), log, p)
    outbox_path = t.path(f"alert_outbox/run={run}")
    sinks.overwrite(alerts.alert_outbox(to_send, base, directory, p), outbox_path)
    outbox = spark.read.parquet(outbox_path)
    sinks.overwrite(alerts.outbox_to_log(outbox), t.path(f"alert_send_log/run={run}"))
    return outbox


def run_backtest(spark: SparkSession, t: Tables, usage_df: DataFrame, prices: DataFrame, history: DataFrame,
                 rules: ExclusionRules, p: Params) -> DataFrame:
    require_utc(spark)
    excluded = usage.exclusion_keys(rules, history, p.broadcast_max_rows)
    raw = written(backtest.backtest(usage_df, prices, excluded, p))
    results = backtest.enrich(raw, backtest.meta_for(raw, history))
    published.publish(results, t.path("backtest_results"))
    return published.current(spark, t.path("backtest_results"), results.schema)
