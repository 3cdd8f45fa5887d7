"""Command-line entry: ``python -m gaugeflow <job> --warehouse DIR ...``.

Jobs (landed inputs are Parquet folders with the library's schemas):

* ``update``  --pages DIR --as-of DATE [--days 30]: incremental update + marts
* ``reset``   --pages DIR [--station ID [--regex]]: replace the archives of the
  stations in the pages (of one station, or of ids that match)
* ``chain``   --nav DIR --ranges DIR --archive DIR --pages DIR --as-of DATE: refresh
  with backfill, then update, marts included
* ``manifest`` --out DIR --as-of DATE [--days 30]: links and start texts to fetch
* ``refresh`` --nav DIR --ranges DIR [--archive DIR]: station dimension,
  and (with ``--archive``) the archives of the stations that are new
* ``marts``   --as-of DATE: rebuild daily and hourly_recent from scratch
* ``full-reset`` --nav DIR --ranges DIR --archive DIR --as-of DATE [--buckets N]: all
  tables anew, with N station buckets (by default as many as before)
"""

from __future__ import annotations

import argparse
import datetime as dt

from gaugeflow.plans import jobs
from gaugeflow.session import build_session
from gaugeflow.sources.tables import Warehouse, read_nav_pages, read_pages, read_series_ranges


def main(argv=None) -> None:
    """Parse the command line and run one job."""
    ap = argparse.ArgumentParser(prog="gaugeflow")
    ap.add_argument("job", choices=["update", "reset", "refresh", "marts", "full-reset", "chain", "manifest"])
    ap.add_argument("--warehouse", required=True)
    ap.add_argument("--pages")
    ap.add_argument("--nav")
    ap.add_argument("--ranges")
    ap.add_argument("--archive")
    ap.add_argument("--as-of", type=dt.date.fromisoformat, default=dt.date.today())
    ap.add_argument("--days", type=int, default=30)
    ap.add_argument("--base-url", default="")
    ap.add_argument("--station")
    ap.add_argument("--regex", action="store_true")
    ap.add_argument("--out")
    ap.add_argument("--buckets", type=int)
    ap.add_argument("--profile", choices=["local", "cluster"], default="cluster")
    args = ap.parse_args(argv)

    spark = build_session(profile=args.profile)
    wh = Warehouse(args.warehouse)
    if args.job == "update":
        jobs.run_update(spark, wh, read_pages(spark, args.pages), args.as_of, args.days, args.base_url)
    elif args.job == "reset":
        jobs.run_reset(spark, wh, read_pages(spark, args.pages), args.base_url, args.as_of, args.station,
                       args.regex)
    elif args.job == "chain":
        jobs.run_chain(spark, wh, read_nav_pages(spark, args.nav), read_series_ranges(spark, args.ranges),
                       read_pages(spark, args.archive), read_pages(spark, args.pages), args.as_of, args.days, args.base_url)
    elif args.job == "manifest":
        jobs.run_manifest(spark, wh, args.out, args.as_of, args.days, args.base_url)
    elif args.job == "refresh":
        nav, ranges = read_nav_pages(spark, args.nav), read_series_ranges(spark, args.ranges)
        if args.archive:
            jobs.refresh_and_backfill(spark, wh, nav, ranges, read_pages(spark, args.archive), args.base_url)
        else:
            jobs.run_refresh(spark, wh, nav, ranges, args.base_url)
    elif args.job == "marts":
        jobs.run_marts(spark, wh, args.as_of)
    else:
        jobs.full_reset(spark, wh, read_nav_pages(spark, args.nav), read_series_ranges(spark, args.ranges),
                        read_pages(spark, args.archive), args.as_of, args.base_url, args.buckets)
    spark.stop()


if __name__ == "__main__":
    main()
