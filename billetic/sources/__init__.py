"""Sources (logical tables, fixtures over the test data) and sinks (targets,
writers, table-changing operators)."""

from billetic.sources.catalog import CatalogSources, load
from billetic.sources.fixtures import FixtureSources
from billetic.sources.sinks import (
    delete_from,
    delete_where,
    duplicate_keys,
    ensure_target,
    read_target,
    replace_dates,
    update_from,
    update_into,
    upsert,
    upsert_into,
    write_target,
)
from billetic.sources.targets import ALL_TARGETS, Target, conform

__all__ = [
    "ALL_TARGETS",
    "CatalogSources",
    "FixtureSources",
    "Target",
    "conform",
    "delete_from",
    "delete_where",
    "duplicate_keys",
    "ensure_target",
    "load",
    "read_target",
    "replace_dates",
    "update_from",
    "update_into",
    "upsert",
    "upsert_into",
    "write_target",
]
