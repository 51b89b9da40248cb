"""The daily run: ingest the three sources into bronze, then bring silver
and gold up to date.

Same order as the original schedule (series first, then the relational and
file sources, then the transformation), but as one driver program that
submits Spark jobs; every step is restartable: tables change by commits
(``storage``), a run that is lost leaves the tables before or after a step, and
the next one goes on from the versions that each table says it was made from.
The first run builds gold whole, later ones follow what changed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tributary.operators.calendar import DEFAULT_DAYS, DEFAULT_START
from tributary.plans.erp import ErpBinding, merge_logs
from tributary.plans.layers import Build, build_gold, refresh_gold
from tributary.session import path_exists, size_shuffle_partitions
from tributary.sources.files import ingest_files
from tributary.sources.relational import ERP_TABLES, TableSpec, ingest_incremental
from tributary.sources.rest_series import SERIES, ingest_series


@dataclass
class DailyRun:
    run_date: dt.date
    bronze_root: str
    warehouse_root: str
    # ISO stamp of this run; defaults to the current UTC time, fixed once.
    loaded_at: str | None = None
    # Returns the current content of a source table (JDBC, files, ...).
    erp_source: Callable[[TableSpec], DataFrame] | None = None
    landing_dir: str | None = None
    # Series API URL template with {code}, {start}, {end}.
    series_url: str | None = None
    series: dict[str, int] | None = None
    # Also materialize the dashboard marts (KPIs, sales vs dollar, ranking).
    marts: bool = True
    # Expose the gold tables as gold.<model> in the session catalog.
    register: bool = True
    # Write the data-quality tables (quality layer).
    checks: bool = True
    # Keep the newest version per id of the append logs and merge only what is new.
    stored_state: bool = True
    # Compare sources with the newest loaded cursor instead of the last run's clock.
    watermark_on_cursor: bool = False
    # Look again this far behind the watermark for rows that were committed late.
    late: dt.timedelta | None = None
    # Share of a landed file's records that may be malformed; they go to a table of rejects.
    most_rejected: float = 0.0
    # Dates of the aligned series: "first_two" or "all" (see operators.series).
    key_mode: str = "first_two"
    # Calendar range; days of sales beyond it are added unless switched off.
    calendar_start: str | dt.date = DEFAULT_START
    calendar_days: int = DEFAULT_DAYS
    calendar_covers_sales: bool = True


def run_daily(spark: SparkSession, run: DailyRun) -> Build:
    loaded_at = run.loaded_at or dt.datetime.now(dt.timezone.utc).replace(
        tzinfo=None).isoformat()
    bronze = run.bronze_root.rstrip("/")
    series = SERIES if run.series is None else run.series
    if run.series_url:
        ingest_series(spark, series, run.run_date, run.series_url, f"{bronze}/series",
                      loaded_at)
    if run.erp_source is not None:
        ingest_incremental(spark, run.erp_source, bronze, loaded_at, ERP_TABLES,
                           watermark_on_cursor=run.watermark_on_cursor, late=run.late)
    if run.landing_dir:
        ingest_files(spark, run.landing_dir, bronze, loaded_at, most_rejected=run.most_rejected)
    if path_exists(spark, bronze):
        size_shuffle_partitions(spark, [bronze])
        if run.stored_state:
            merge_logs(spark, bronze)
    binding = ErpBinding(spark, bronze, series=series, key_mode=run.key_mode,
                         calendar_start=run.calendar_start, calendar_days=run.calendar_days,
                         calendar_covers_sales=run.calendar_covers_sales,
                         stored_state=run.stored_state)
    build = refresh_gold if run.stored_state else build_gold
    return build(binding, run.warehouse_root, marts=run.marts, register=run.register, checks=run.checks)
