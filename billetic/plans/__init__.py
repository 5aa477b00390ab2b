"""The eleven KPI jobs (pure DataFrame functions) and the registry of
queries run by the driver contract."""

from billetic.plans.clients import (
    active_clients,
    active_contract_clients,
    avg_weekly_validations,
    clients_by_line,
)
from billetic.plans.sales import sales_by_channel, title_sales_by_support, total_clients
from billetic.plans.validations import (
    purchase_to_validation_delay,
    validation_counts_yoy,
    validation_rate_per_user,
    validations_by_age,
)

__all__ = [
    "active_clients",
    "active_contract_clients",
    "avg_weekly_validations",
    "clients_by_line",
    "purchase_to_validation_delay",
    "sales_by_channel",
    "title_sales_by_support",
    "total_clients",
    "validation_counts_yoy",
    "validation_rate_per_user",
    "validations_by_age",
]
