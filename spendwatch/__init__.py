"""Spend-anomaly analytics on Spark.

Every public function maps DataFrames plus an explicit :class:`Params` (which
carries the clock) to a DataFrame.  Nothing is collected to the driver; all the
work is joins, aggregations, windows and column expressions that Catalyst plans.
"""

from spendwatch.params import Params

__all__ = ["Params"]
