"""One frozen parameter object for every stage (thresholds, windows, clock)."""

from __future__ import annotations

import dataclasses
import datetime as dt


# Largest dimension (in rows) that is broadcast.
BROADCAST_MAX_ROWS = 2_000_000


@dataclasses.dataclass(frozen=True)
class Params:
    # The clock.  Every "now" / "today" in the pipeline is derived from it, so a
    # run is reproducible and a replay is just another value.  Without a time
    # zone it is UTC; one with a zone is converted.
    as_of: dt.datetime = dt.datetime(2024, 1, 31, 0, 0, 0)

    # Scoring thresholds (all strict ">").
    budget_daily_dollars: float = 5000.0
    z_warning: float = 2.0
    z_critical: float = 3.0

    # History windows, in days.
    baseline_lookback_days: int = 30
    backtest_lookback_days: int = 90
    # Extra days read before the replay window so the first replayed days see
    # a full rolling baseline (0 = behave like the original job).
    warmup_days: int = 0
    # Take rolling-baseline days from every day instead of weekdays only.
    weekend_baseline: bool = False
    # Budget rule in the replay tiers; False measures the z rule alone.
    use_budget_rule: bool = True

    # Alerting.
    alert_recency: dt.timedelta = dt.timedelta(minutes=30)
    warning_suppression_hours: int = 24
    critical_suppression_hours: int = 4
    routing_mode: str = "channel_only"  # or "dm_with_fallback"
    alert_channel: str = ""  # required for routing
    workspace_host: str = "workspace.example.com"

    # Pricing.
    cloud: str = "AWS"
    normalise_gcp: bool = False

    # Largest dimension (in rows) that may be broadcast; beyond it the
    # operators switch to a shuffle plan with the same result.
    broadcast_max_rows: int = BROADCAST_MAX_ROWS

    def __post_init__(self) -> None:
        if self.as_of.tzinfo is not None:
            object.__setattr__(self, "as_of", self.as_of.astimezone(dt.timezone.utc).replace(tzinfo=None))

    @property
    def as_of_date(self) -> dt.date:
        return self.as_of.date()

    def replace(self, **changes) -> "Params":
        return dataclasses.replace(self, **changes)
