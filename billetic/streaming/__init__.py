"""Trailing-window refresh (the reference's late-data mechanism): recompute
the last execution dates in one job and write them repeatably. Beside it, the
refresh of older dates that late files touch, kept last-seen state and kept distinct taps."""

from billetic.streaming.distinct import distinct_by_period, merge_taps, recount_days, refresh_counts
from billetic.streaming.last_seen import refresh_last_seen
from billetic.streaming.late import LATE_JOBS, refresh_late
from billetic.streaming.refresh import JOBS, refresh, refresh_all, refresh_by_age, replace_from

__all__ = ["JOBS", "LATE_JOBS", "distinct_by_period", "merge_taps", "recount_days", "refresh", "refresh_all",
           "refresh_by_age", "refresh_counts", "refresh_last_seen", "refresh_late", "replace_from"]
