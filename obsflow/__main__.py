"""Jobs from the command line: ``spark-submit ... -m obsflow <job> --root <folder> ...``."""

from __future__ import annotations

import argparse

from obsflow.operators import paging
from obsflow.plans import jobs
from obsflow.session import build_session
from obsflow.sources.jdbc import HashSplit, Split, read_database


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="obsflow")
    parser.add_argument("--root", required=True, help="folder of all tables")
    job = parser.add_subparsers(dest="job", required=True)

    raw = job.add_parser("load-raw", help="load the observation export")
    raw.add_argument("--csv", required=True)
    raw.add_argument("--no-embedded-newlines", action="store_true", help="split large files over tasks")
    raw.add_argument("--in-parts", action="store_true")

    backfill = job.add_parser("backfill", help="archive reports into bronze")
    live = job.add_parser("ingest", help="landed payloads into bronze")
    full = job.add_parser("refresh-all", help="backfill, silver and gold")
    tick = job.add_parser("refresh", help="payloads through to contaminated_obs")
    for p, last in ((backfill, 2017), (full, 2016)):
        p.add_argument("--reports", required=True)
        p.add_argument("--start-year", type=int, default=2010)
        p.add_argument("--end-year", type=int, default=last)
    for p in (live, tick):
        p.add_argument("--landing", required=True)
    for p in (full, tick):
        p.add_argument("--dsn", help="copy refreshed gold tables into this database")
        p.add_argument("--target-schema", default="public")

    observations = job.add_parser("observations", help="silver observations")
    observations.add_argument("--dsn", help="read the raw table from this database")
    observations.add_argument("--source-table", default="public.observations")
    observations.add_argument("--split-column", help="scan in parallel, by hash of this column")
    observations.add_argument("--split-range", type=int, nargs=2, help="by ranges of it instead")
    observations.add_argument("--split-count", type=int, default=16)

    job.add_parser("flares", help="silver flares")
    gold = job.add_parser("gold", help="one gold table")
    gold.add_argument("name", choices=jobs.GOLD)
    serve = job.add_parser("serve", help="one gold table into its serving table")
    serve.add_argument("name", choices=jobs.GOLD)
    serve.add_argument("--dsn", required=True)
    serve.add_argument("--target-table", required=True)

    page = job.add_parser("page", help="one page of a gold table as JSON")
    page.add_argument("name", choices=jobs.GOLD)
    for option in ("--from", "--to", "--limit", "--offset"):
        page.add_argument(option)
    return parser.parse_args()


def main() -> None:
    args = _arguments()
    spark = build_session(f"obsflow-{args.job}")
    layout = jobs.Layout(args.root.rstrip("/"))
    if args.job == "load-raw":
        done = jobs.load_raw(spark, layout, args.csv, not args.no_embedded_newlines, args.in_parts)
    elif args.job == "backfill":
        done = jobs.backfill(spark, layout, args.reports, args.start_year, args.end_year)
    elif args.job == "ingest":
        done = jobs.ingest_live(spark, layout, args.landing)
    elif args.job == "observations":
        raw = None
        if args.dsn:
            split = None
            if args.split_column and args.split_range:
                split = Split(args.split_column, *args.split_range, args.split_count)
            elif args.split_column:
                split = HashSplit(args.split_column, args.split_count)
            raw = read_database(spark, args.dsn, args.source_table, split)
        done = jobs.refresh_observations(spark, layout, raw)
    elif args.job == "flares":
        done = jobs.refresh_flares(spark, layout)
    elif args.job == "gold":
        done = jobs.refresh_gold(spark, layout, args.name)
    elif args.job == "serve":
        done = jobs.serve(spark, layout, args.name, args.dsn, args.target_table)
    elif args.job == "refresh-all":
        done = jobs.refresh_all(
            spark, layout, args.reports, args.start_year, args.end_year, after_gold=_server(spark, layout, args)
        )
    elif args.job == "refresh":
        done = jobs.refresh_incremental(spark, layout, args.landing, _server(spark, layout, args))
    else:
        done = _page(spark, layout, args)
    print(done, flush=True)
    spark.stop()


def _server(spark, layout: jobs.Layout, args: argparse.Namespace):
    """What copies a refreshed gold table into the database, if one is named."""
    if args.dsn:
        return lambda name: jobs.serve(spark, layout, name, args.dsn, f"{args.target_schema}.{name}")
    return None


def _page(spark, layout: jobs.Layout, args: argparse.Namespace) -> str:
    table = jobs.read_gold(spark, layout, args.name)
    page = paging.Page.of(args.limit, args.offset)
    return paging.gold_json_page(
        table, args.name, page, getattr(args, "from"), args.to
    ).first()["page"]


if __name__ == "__main__":
    main()
