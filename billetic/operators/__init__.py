"""Reusable DataFrame operators: execution-date window (T1-T4), day filters
(P4-P7), joins (N6, N7), aggregates (A4, A9), first row per group (W2)."""

from billetic.operators.aggregates import (
    conditional_distinct,
    count_at_least,
    last_day_histogram,
    last_seen,
    last_seen_histogram,
    with_zero_rows,
)
from billetic.operators.asof import next_row_join
from billetic.operators.bitmaps import count_words, id_words, merge_words
from billetic.operators.filters import (
    day_range,
    in_key_range,
    lookback,
    on_day_set,
    on_days,
    since_account_start,
)
from billetic.operators.intervals import covered_months, interval_join
from billetic.operators.joins import shift_join, spine_join
from billetic.operators.ranking import first_per_group
from billetic.operators.window import (
    DateWindow,
    add_months,
    broadcast_spine,
    date_spine,
    with_period_bounds,
)

__all__ = [
    "DateWindow",
    "add_months",
    "broadcast_spine",
    "conditional_distinct",
    "count_at_least",
    "count_words",
    "covered_months",
    "date_spine",
    "day_range",
    "first_per_group",
    "id_words",
    "in_key_range",
    "interval_join",
    "last_day_histogram",
    "last_seen",
    "last_seen_histogram",
    "lookback",
    "merge_words",
    "next_row_join",
    "on_day_set",
    "on_days",
    "shift_join",
    "since_account_start",
    "spine_join",
    "with_period_bounds",
    "with_zero_rows",
]
