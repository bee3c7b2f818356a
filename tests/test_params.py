"""Run parameters: date forms, window bounds, partition bounds."""

import datetime as dt

import pytest

from reshift.params import RunParams


def test_date_forms_and_window():
    for value in ("20240130", "2024-01-30", dt.date(2024, 1, 30)):
        p = RunParams(run_date=value, lookback_days=14)
        assert p.run_date == dt.date(2024, 1, 30)
        assert p.window_start == dt.datetime(2024, 1, 17)
        assert p.window_end == dt.datetime(2024, 1, 31)
        assert p.dt == "20240130"


def test_one_day_window():
    p = RunParams(run_date="20240229", lookback_days=1)
    assert (p.window_start, p.window_end) == (dt.datetime(2024, 2, 29), dt.datetime(2024, 3, 1))


def test_partition_bounds_cover_the_window_with_margin():
    p = RunParams(run_date="20240130", lookback_days=14, usage_partition_format="%Y%m%d")
    assert p.partition_bounds == ("20240116", "20240131")
    p = RunParams(run_date="2024-01-30", lookback_days=14, usage_partition_margin_days=0)
    assert p.partition_bounds == ("2024-01-17", "2024-01-30")


def test_invalid_lookback():
    with pytest.raises(ValueError):
        RunParams(lookback_days=0)
