"""Run parameters of one reservation-shift run."""

from __future__ import annotations

import datetime as _dt
import zoneinfo
from dataclasses import dataclass

from reshift.functions.cpu import CPU_RULES


@dataclass(frozen=True)
class RunParams:
    """Scalar inputs of a run.

    ``run_date`` closes the look-back window: usage whose start date lies in
    ``(run_date - lookback_days, run_date]`` is read, exactly
    ``lookback_days`` calendar days.
    """

    run_date: _dt.date = _dt.date(2024, 1, 30)
    lookback_days: int = 14
    # share of observed hours with spare capacity (percent) a pool needs
    # before it is offered for a move; the test is inclusive
    cutoff_pct: float = 80.0
    # a pool may give away strictly less than its average unused count;
    # True relaxes the cap to "at most"
    allow_full_use: bool = False
    # Date partition column of the usage table, if any (values formatted with
    # ``usage_partition_format``, e.g. '2024-01-30' or '20240130', or a date
    # column). When set, the window also prunes partitions, widened by
    # ``usage_partition_margin_days`` on each side so that lines filed under a
    # neighbouring day are still read; the exact timestamp range still applies.
    usage_partition_column: str | None = None
    usage_partition_format: str = "%Y-%m-%d"
    usage_partition_margin_days: int = 1
    # Zone whose wall clock the billing hours and the window follow. TIMESTAMP columns are
    # converted to it whatever the session's zone; stamps without a zone are taken as they are.
    time_zone: str = "UTC"
    # Ordered CPU rules (kind, key, weight), first hit wins; see ``functions.cpu``. A table of rules
    # (kind, key, weight, rank) takes their place.
    cpu_rules: tuple[tuple[str, str, int], ...] = CPU_RULES
    cpu_rules_table: str | None = None
    # Also offer pools nobody used in the window (the job shows used pools only); they carry
    # ``idle_product`` as their product.
    include_idle_pools: bool = False
    idle_product: str = "Amazon Elastic Compute Cloud"
    # First-fit order of a pool's reservations: "id" (raw inventory key) or "fewest" (fewest
    # active instances first, then the key).
    reservation_order: str = "id"
    # Salted slices of a (pool, shift) group in the first pass of the
    # first-fit pruning: raise it when one pool holds a large share of the
    # inventory, so that pass spreads over more tasks. Results do not change.
    first_fit_salt_buckets: int = 32

    def __post_init__(self):
        if isinstance(self.run_date, str):
            object.__setattr__(self, "run_date", parse_run_date(self.run_date))
        if self.lookback_days < 1:
            raise ValueError("lookback_days must be >= 1")
        if self.reservation_order not in ("id", "fewest"):
            raise ValueError(f"unknown reservation order: {self.reservation_order!r}")
        zoneinfo.ZoneInfo(self.time_zone)
        object.__setattr__(self, "cpu_rules", tuple(map(tuple, self.cpu_rules)))

    @property
    def window_start(self) -> _dt.datetime:
        """First instant inside the window (inclusive)."""
        first_day = self.run_date - _dt.timedelta(days=self.lookback_days - 1)
        return _dt.datetime.combine(first_day, _dt.time())

    @property
    def window_end(self) -> _dt.datetime:
        """First instant after the window (exclusive)."""
        return _dt.datetime.combine(self.run_date + _dt.timedelta(days=1), _dt.time())

    @property
    def partition_bounds(self) -> tuple[str, str]:
        """Inclusive (low, high) partition values that cover the window."""
        margin = _dt.timedelta(days=self.usage_partition_margin_days)
        low = self.window_start.date() - margin
        high = self.run_date + margin
        fmt = self.usage_partition_format
        return low.strftime(fmt), high.strftime(fmt)

    @property
    def dt(self) -> str:
        """Partition value of the outputs, ``yyyyMMdd``."""
        return self.run_date.strftime("%Y%m%d")


def parse_run_date(value: str) -> _dt.date:
    """Accept ``yyyyMMdd`` (the scheduler's form) or ISO ``yyyy-MM-dd``."""
    value = value.strip()
    fmt = "%Y%m%d" if len(value) == 8 and value.isdigit() else "%Y-%m-%d"
    return _dt.datetime.strptime(value, fmt).date()
