"""Latest alerts, suppression, routing, rendering, outbox and audits."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendwatch import schemas as S
from spendwatch.functions import text
from spendwatch.functions.columns import instant, py_str
from spendwatch.operators.baseline import baseline_latest
from spendwatch.operators.joins import broadcast_if_fits
from spendwatch.params import Params

ALERT_SIGNALS = ("WARNING", "CRITICAL")
KEYS = ["workspace_id", "cluster_id"]

# Deterministic order for equal snapshot_ts (D12): newest first, then the
# remaining columns.
SCORE_TIEBREAK = ["signal", "reason", "node_type", "driver_node_type", "num_workers", "photon",
                  "cluster_source", "cluster_name", "creator"]


def latest_by(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """WN1/WN2/SO3: the first row per key under ``order``.  ``row_number() = 1``
    lets Spark insert a WindowGroupLimit, so each task keeps one row per key
    before the shuffle and a hot key costs no more than a cold one."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def score_order(columns: list[str] | None = None) -> list:
    """Newest first; ties broken by the remaining score columns present."""
    ties = [c for c in SCORE_TIEBREAK if columns is None or c in columns]
    return [F.col("snapshot_ts").desc_nulls_last()] + [F.col(c).asc_nulls_first() for c in ties]


def recency_cutoff(p: Params) -> dt.datetime:
    return p.as_of - p.alert_recency


def alerts_latest(scores: DataFrame, p: Params) -> DataFrame:
    """SK5: latest snapshot per cluster if it is WARNING/CRITICAL and recent.

    R1: the recency predicate (and the matching ``snapshot_date`` bound, which
    prunes date partitions) goes below the ranking -- if any row of a cluster
    is recent, its latest row is.  The signal filter stays above the rank.
    """
    cutoff = recency_cutoff(p)
    recent = scores.where((F.col("snapshot_date") >= F.lit(cutoff.date()))
                          & (F.col("snapshot_ts") >= instant(cutoff)))
    latest = latest_by(recent, KEYS, score_order())
    return latest.where(F.col("signal").isin(*ALERT_SIGNALS)).select(*S.ALERT_COLUMNS)


def heartbeat(scores: DataFrame, p: Params) -> DataFrame:
    """AG15: last snapshot per workspace and whether it is older than the
    recency window."""
    last = scores.groupBy("workspace_id").agg(F.max("snapshot_ts").alias("last_snapshot_ts"))
    return last.withColumn("stale", F.col("last_snapshot_ts") < instant(recency_cutoff(p)))


def last_send(log: DataFrame) -> DataFrame:
    """AG13: the newest send per (workspace, cluster, signal)."""
    return (log.where(F.col("signal").isin(*ALERT_SIGNALS))
            .groupBy("workspace_id", "cluster_id", "signal")
            .agg(F.max("sent_at").alias("last_sent_at")))


def _suppressing_sends(log: DataFrame, p: Params) -> DataFrame:
    crit = p.as_of - dt.timedelta(hours=p.critical_suppression_hours)
    warn = p.as_of - dt.timedelta(hours=p.warning_suppression_hours)
    cond = (((F.col("signal") == "CRITICAL") & (F.col("sent_at") >= instant(crit)))
            | ((F.col("signal") == "WARNING") & (F.col("sent_at") >= instant(warn))))
    return log.where(cond).select("workspace_id", "cluster_id", "signal")


def alerts_to_send(alerts: DataFrame, log: DataFrame, p: Params) -> DataFrame:
    """JN17 via R2: keep an alert unless a send for the same (workspace,
    cluster, signal) happened within its tier's window.  ``max(sent) < T or
    none`` equals ``no send >= T``, so this is one anti join against the log
    rows of the window (only recent log rows take part)."""
    kept = alerts.join(_suppressing_sends(log, p), ["workspace_id", "cluster_id", "signal"], "left_anti")
    return kept.select(*alerts.columns)


def directory_lookup(directory: DataFrame, p: Params) -> DataFrame:
    """One user id per e-mail address, broadcast behind a size check."""
    d = directory.groupBy("email").agg(F.min("user_id").alias("creator_user_id"))
    return broadcast_if_fits(d, p.broadcast_max_rows)


def route(alerts: DataFrame, directory: DataFrame, p: Params) -> DataFrame:
    """JN18 + PR24: trim the owner, resolve it to a messaging id (e-mails
    only) and choose recipient and routing for the mode."""
    if not p.alert_channel:
        raise ValueError("routing needs Params.alert_channel")
    df = alerts.withColumn(
        "creator", F.nullif(F.regexp_replace(F.col("creator"), r"^\s+|\s+$", ""), F.lit("")))
    df = df.join(directory_lookup(directory, p),
                 F.col("creator").contains("@") & (F.col("creator") == F.col("email")), "left").drop("email")
    channel = F.lit(p.alert_channel)
    if p.routing_mode == "dm_with_fallback":
        has_id = F.col("creator_user_id").isNotNull() & (F.col("creator_user_id") != "")
        recipient = F.when(has_id, F.col("creator_user_id")).otherwise(channel)
        routing = F.when(has_id, F.lit("dm")).otherwise(F.lit("fallback_channel"))
    else:
        recipient, routing = channel, F.lit("channel_only")
    return df.withColumn("recipient", recipient).withColumn("routing", routing)


def workspace_host(p: Params) -> str:
    """PR28: strip a scheme if a full URL was configured."""
    host = p.workspace_host.strip()
    if host.startswith("http"):
        from urllib.parse import urlparse
        return urlparse(host).netloc
    return host


def render(routed: DataFrame, baseline: DataFrame, p: Params) -> DataFrame:
    """PR22-PR27: headline, body, plain text and deep link per alert, using
    the newest raw baseline mean of the workspace (D15, D16)."""
    means = baseline_latest(baseline).select("workspace_id", F.col("mean_daily_dollars").alias("_mean"))
    df = routed.join(means, "workspace_id", "left")
    projected = F.col("projected_daily_dollars")
    dollars = text.format_dollars(projected)
    percent = text.format_percent_above(projected, F.col("_mean"))
    name = py_str(F.col("cluster_name"))
    greet = text.greeting(F.col("recipient"), F.col("creator"), F.col("creator_user_id"))
    host = workspace_host(p)
    return df.select(
        "*",
        text.headline(F.col("signal")).alias("headline"),
        text.fill(text.BODY, greeting=greet, cluster_name=name, dollars=dollars, percent=percent).alias("body"),
        text.fill(text.PLAIN, severity=py_str(F.col("signal")), cluster_name=name, dollars=dollars,
                  percent=percent).alias("plain"),
        text.fill(text.LINK, host=F.lit(host), cluster_id=py_str(F.col("cluster_id"))).alias("link"),
    ).drop("_mean")


def alert_outbox(to_send: DataFrame, baseline: DataFrame, directory: DataFrame, p: Params) -> DataFrame:
    """D14: the messages to send, keyed (workspace, cluster, signal, sent_at)
    so a retry is idempotent; the sender appends them to the send log."""
    rendered = render(route(to_send, directory, p), baseline, p)
    return rendered.select(
        instant(p.as_of).alias("sent_at"), "workspace_id", "cluster_id", "signal",
        "recipient", "routing", "plain", "link")


def outbox_to_log(outbox: DataFrame) -> DataFrame:
    """Send-log rows for an outbox (message ids are filled in by the sender)."""
    return outbox.select("sent_at", "workspace_id", "cluster_id", "signal", "recipient", "routing",
                         F.lit(None).cast("string").alias("message_ts"))


def send_audit(log: DataFrame) -> DataFrame:
    """AG16: sends per cluster, signal, recipient and routing."""
    return log.groupBy("workspace_id", "cluster_id", "signal", "recipient", "routing").agg(
        F.count(F.lit(1)).alias("n_sends"),
        F.min("sent_at").alias("first_sent_at"),
        F.max("sent_at").alias("last_sent_at"))


def exclusion_audit(scores: DataFrame) -> DataFrame:
    """AG17: excluded rows and distinct clusters per reason, in two grouped
    passes (both with map-side partial aggregation) instead of a DISTINCT
    aggregate."""
    per_cluster = (scores.where(F.col("signal") == "EXCLUDED")
                   .groupBy("reason", "workspace_id", "cluster_id").agg(F.count(F.lit(1)).alias("_n")))
    return per_cluster.groupBy("reason").agg(
        F.sum("_n").alias("n_rows"), F.count(F.lit(1)).alias("n_clusters"))
