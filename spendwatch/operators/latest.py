"""WN1/SK5 as a table: the newest score of every cluster, kept up to date poll by poll.

A poll adds a run of its own size.  Runs that are merged keep only the newest row of
a cluster, so the table holds a cluster at most FAN times a level, whatever the number
of polls, and a read ranks these rows instead of the history.  A row is rewritten once a
level: log(polls) times in all, where an upsert into buckets of clusters would rewrite
the silent clusters of every touched bucket at each poll.

Polls may come late or be repeated.  A repeated poll has to hold at least the clusters
of its earlier attempt: older rows of theirs may have gone when that one was merged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from spendwatch import schemas as S
from spendwatch.operators import alerts, published


def _newest(scores: DataFrame) -> DataFrame:
    return alerts.latest_by(scores, alerts.KEYS, alerts.score_order(scores.columns))


def add_poll(scores: DataFrame, path: str, poll: str, fan: int = published.FAN) -> None:
    """Add the scores of one poll; polls sort by name in time order."""
    published.append_run(_newest(scores), path, poll, fan=fan, reduce=_newest)


def latest_state(spark: SparkSession, path: str, schema: T.StructType = S.CLUSTER_SCORES) -> DataFrame:
    """The newest row of every (workspace, cluster) over all polls."""
    return _newest(published.current(spark, path, schema))
