"""SM5/AG9 kept up to date: each day's moments stored once, baselines from the stored days.

A day of usage is reduced to one row per workspace and added to a table of runs, so
a new day reads its own cluster-days only, and the baseline of an as-of day merges the
N stored rows before it.  The window moves by which rows are read: nothing is
subtracted from a running sum, whose rounding errors would stay for good.  A run that
is repeated (late usage) replaces its days; the N days after them are then due again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendwatch import schemas as S
from spendwatch.operators import published
from spendwatch.operators.baseline import day_moments, window_baselines
from spendwatch.params import Params


def add_days(day_totals: DataFrame, path: str, run: str, p: Params) -> None:
    """Store the moments of the days of ``day_totals``, as the run ``run``."""
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in S.DAY_MOMENTS.fields]
    published.append_run(day_moments(day_totals, p).select(*columns), path, run)


def baselines_between(spark: SparkSession, path: str, first: dt.date, last: dt.date, p: Params) -> DataFrame:
    """``rolling_baseline`` of the as-of days ``first`` to ``last``; reads these days and the N before."""
    earliest = first - dt.timedelta(days=p.baseline_lookback_days)
    moments = published.current(spark, path, S.DAY_MOMENTS).where(F.col("usage_date").between(F.lit(earliest), F.lit(last)))
    return window_baselines(moments, p).where(F.col("as_of_date") >= F.lit(first))
