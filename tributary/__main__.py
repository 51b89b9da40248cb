"""Command line: one daily run of the pipeline.

    python -m tributary --run-date 2024-02-01 --bronze s3a://lake/bronze \\
        --warehouse s3a://lake/warehouse --landing s3a://lake/landing \\
        --series-url 'https://<series-api>/series/{code}?start={start}&end={end}' \\
        --jdbc-url jdbc:postgresql://host/db --jdbc-user etl --jdbc-password-env PGPASSWORD

Every source is optional; without any the run rebuilds silver and gold from
the bronze tables already present.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os

from tributary.plans.daily import DailyRun, run_daily
from tributary.session import build_session
from tributary.sources.relational import jdbc_source


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tributary")
    ap.add_argument("--run-date", type=dt.date.fromisoformat, default=dt.date.today())
    ap.add_argument("--bronze", required=True)
    ap.add_argument("--warehouse", required=True)
    ap.add_argument("--landing")
    ap.add_argument("--series-url")
    ap.add_argument("--jdbc-url")
    ap.add_argument("--jdbc-user")
    ap.add_argument("--jdbc-password-env", help="environment variable holding the password")
    ap.add_argument("--jdbc-partitions", type=int, default=16)
    ap.add_argument("--watermark-on-cursor", action="store_true",
                    help="compare with the newest loaded cursor, not the last run's clock")
    ap.add_argument("--late-hours", type=float, help="look again this far behind the watermark for late rows")
    ap.add_argument("--most-rejected", type=float, default=0.0,
                    help="share of a landed file's records that may be malformed")
    ap.add_argument("--key-mode", choices=["first_two", "all"], default="first_two")
    args = ap.parse_args(argv)

    spark = build_session(app_name="tributary-daily")
    source = None
    if args.jdbc_url:
        props = {}
        if args.jdbc_user:
            props["user"] = args.jdbc_user
        if args.jdbc_password_env:
            props["password"] = os.environ[args.jdbc_password_env]
        source = jdbc_source(spark, args.jdbc_url, props, args.jdbc_partitions)
    build = run_daily(spark, DailyRun(
        run_date=args.run_date, bronze_root=args.bronze, warehouse_root=args.warehouse,
        erp_source=source, landing_dir=args.landing, series_url=args.series_url,
        watermark_on_cursor=args.watermark_on_cursor,
        late=None if args.late_hours is None else dt.timedelta(hours=args.late_hours), most_rejected=args.most_rejected, key_mode=args.key_mode))
    for name, df in build.gold.items():
        print(f"{name}: {df.count()} rows")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
