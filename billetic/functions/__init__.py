"""Column helpers (F1-F21 of the survey): dates, labels, arithmetic."""

from billetic.functions.arith import int_div, nullif_zero, safe_ratio
from billetic.functions.dates import (
    covers,
    day_diff,
    month_start,
    to_day,
    week_diff,
    year_diff,
)
from billetic.functions.labels import (
    AGE_BAND_OTHER,
    AGE_BANDS,
    EQUIPMENT_LABELS,
    SUPPORT_LABELS,
    age_band,
    equipment_label,
    label_map,
    support_label,
)

__all__ = [
    "AGE_BANDS",
    "AGE_BAND_OTHER",
    "EQUIPMENT_LABELS",
    "SUPPORT_LABELS",
    "age_band",
    "covers",
    "day_diff",
    "equipment_label",
    "int_div",
    "label_map",
    "month_start",
    "nullif_zero",
    "safe_ratio",
    "support_label",
    "to_day",
    "week_diff",
    "year_diff",
]
