"""Every stage of the job as a lazily built DataFrame.

One ``Stages`` object wires the operators together for one pair of inputs;
each attribute is built on first access, so asking for an early stage never
builds a later one.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from reshift.functions import cpu
from reshift.operators import balance, firstfit, greedy, inventory, moves, usage
from reshift.params import RunParams


class Stages:
    def __init__(self, usage_df: DataFrame, reservations: DataFrame,
                 params: RunParams = RunParams(), materialize=None, hourly: DataFrame | None = None,
                 by: tuple[str, ...] = ()):
        # further key columns of the hourly usage that all later stages carry (``plans.backfill``)
        self.by = by
        self.usage = usage_df
        # the window's hourly usage, if it is kept elsewhere (``sources.hourly_store``)
        self._kept_hourly = hourly
        self.reservations = reservations
        self.params = params
        # materialize(df) -> df: identity for a lazy plan, checkpoint in run()
        self._materializing = materialize is not None
        self._materialize = materialize or (lambda df: df)

    # usage side
    @cached_property
    def window_filter(self) -> DataFrame:
        return usage.window_filter(self.usage, self.params)

    @cached_property
    def hourly_usage(self) -> DataFrame:
        """Both branches in one aggregate, materialised: one scan serves both."""
        if self._kept_hourly is not None:
            return self._kept_hourly
        return self._materialize(usage.hourly_usage(self.usage, self.params))

    def _hourly(self, branch: str) -> DataFrame:
        if self._materializing or self._kept_hourly is not None:
            return self.hourly_usage
        # a lazy plan reads only the columns and rows of the branch it needs
        return usage.hourly_usage(self.usage, self.params, (branch,))

    @cached_property
    def reserved_hourly(self) -> DataFrame:
        return usage.reserved_hourly(self._hourly(usage.RESERVED), self.by)

    @cached_property
    def ondemand_hourly(self) -> DataFrame:
        return usage.ondemand_hourly(self._hourly(usage.ON_DEMAND), self.by)

    @cached_property
    def ondemand_daily(self) -> DataFrame:
        return usage.ondemand_daily(self.ondemand_hourly, self.by)

    @cached_property
    def ondemand_window(self) -> DataFrame:
        return usage.ondemand_window(self.ondemand_hourly, self.by)

    # inventory side
    @cached_property
    def reservation_list(self) -> DataFrame:
        return inventory.reservation_list(self.reservations)

    @cached_property
    def active_pools(self) -> DataFrame:
        return inventory.active_pools(self.reservation_list)

    @cached_property
    def offered_pools(self) -> DataFrame:
        """The pools as idle ones are looked for (of every run date, in a back-fill)."""
        return self.active_pools

    # reserved balance
    @cached_property
    def pool_match(self) -> DataFrame:
        return balance.pool_match(self.reserved_hourly, self.active_pools, self.by)

    @cached_property
    def hourly_balance(self) -> DataFrame:
        return balance.hourly_balance(self.pool_match, self.by)

    @cached_property
    def unused_daily(self) -> DataFrame:
        return balance.unused_daily(self.hourly_balance, self.by)

    @cached_property
    def unused_window(self) -> DataFrame:
        window = balance.unused_window(self.hourly_balance, self.by)
        if self.params.include_idle_pools:
            window = balance.with_idle_pools(window, self.offered_pools, self.params, self.by)
        return window

    @cached_property
    def unused_rollups(self) -> DataFrame:
        """Window and days of every pool from one aggregate over the hours."""
        return balance.unused_rollups(self.hourly_balance, self.by)

    @cached_property
    def high_unused(self) -> DataFrame:
        return balance.high_unused(self.unused_window, self.params.cutoff_pct)

    # moves and allocation
    @cached_property
    def cpu_weight(self) -> DataFrame:
        return moves.instance_types(self.window_filter, self.reservations, self.cpu_rules)

    @cached_property
    def cpu_rules(self) -> DataFrame:
        """The rules of the parameters' table, or their list."""
        spark = self.usage.sparkSession
        if self.params.cpu_rules_table:
            return cpu.rule_table(spark, self.params.cpu_rules_table)
        return cpu.rule_rows(spark, self.params.cpu_rules)

    @cached_property
    def candidate_moves(self) -> DataFrame:
        return moves.candidate_moves(self.high_unused, self.ondemand_window, self.cpu_rules, self.by)

    @cached_property
    def walk_candidates(self) -> DataFrame:
        """What the walk reads: all candidates where demands may be cut, else those within a pool's reach."""
        if self.params.allow_full_use:
            return self.candidate_moves
        return moves.walk_candidates(self.high_unused, self.ondemand_window, self.cpu_rules, self.by)

    @cached_property
    def picks(self) -> DataFrame:
        picked = greedy.greedy_picks(self.walk_candidates, self.params.allow_full_use, self.by)
        if not self._materializing:
            return picked
        # run(): stored once, partitioned on the pool key first fit groups
        # by, and read by both outputs
        return self._materialize(picked.repartition(*self.by, *firstfit.POOL))

    @cached_property
    def suggestions(self) -> DataFrame:
        return greedy.suggestions(self.picks, self.by)

    @cached_property
    def reservation_shift(self) -> DataFrame:
        return firstfit.reservation_shift(self.picks, self.reservation_list,
                                          self.params.first_fit_salt_buckets, self.params.reservation_order, self.by)
