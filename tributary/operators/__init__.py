"""DataFrame -> DataFrame operators of the silver and gold layers."""

from tributary.operators.calendar import calendar, calendar_covering, calendar_from_dates
from tributary.operators.checks import orphan_rows, unique_violations
from tributary.operators.dedup import conform_dimension, latest_version, top_one_per_key
from tributary.operators.facts import attainment, item_totals, sales_fact
from tributary.operators.marts import (kpi_overview, monthly_vs_indicator, store_ranking,
                                       target_plan)
from tributary.operators.series import align_series, align_series_long
from tributary.operators.staging import (parse_series, project, stage_customers, stage_items,
                                         stage_products, stage_sales, stage_stores,
                                         stage_targets)

__all__ = [
    "align_series", "align_series_long", "attainment", "calendar",
    "calendar_covering", "calendar_from_dates", "conform_dimension", "item_totals",
    "kpi_overview", "latest_version", "monthly_vs_indicator", "orphan_rows",
    "parse_series", "project", "sales_fact", "stage_customers", "stage_items",
    "stage_products", "stage_sales", "stage_stores", "stage_targets", "store_ranking",
    "target_plan", "top_one_per_key", "unique_violations",
]
