"""Jobs: ``python -m tidemark load|build|check`` (or through spark-submit)."""

from __future__ import annotations

import argparse
from datetime import UTC, datetime

from pyspark.errors import AnalysisException

from tidemark.plans.build import all_passed, check_report, models_to_check, publish, raw_tables
from tidemark.session import get_session, shared_dir
from tidemark.sources.load import load_resource
from tidemark.sources.pages import BASE_DATE
from tidemark.sources.raw_store import RawStore
from tidemark.sources.resources import RESOURCES, notes_rows
from tidemark.streaming import stream_resource


def main() -> int:
    parser = argparse.ArgumentParser(prog="tidemark")
    parser.add_argument("job", choices=("load", "build", "check"))
    parser.add_argument("--raw", required=True, help="folder of the raw tables")
    parser.add_argument("--landing", help="folder with one subfolder of pages per resource")
    parser.add_argument("--source", default="", help="resource name prefix, such as fitbit")
    parser.add_argument("--initial-date", default=BASE_DATE)
    parser.add_argument("--end-date")
    parser.add_argument("--full-refresh", action="store_true")
    parser.add_argument("--lines", action="store_true", help="one page per line, not per file")
    parser.add_argument("--stream", action="store_true", help="as a stream, in batches")
    parser.add_argument(
        "--notes-table", action="append", metavar="ID=NAME", default=[],
        help="table of a data source of the notes workspace, in place of the known ones",
    )
    parser.add_argument("--files-per-batch", type=int, help="with --stream")
    parser.add_argument("--load-id", help="give the same id again to repeat a load")
    parser.add_argument("--database")
    parser.add_argument("--tables", help="folder for the built tables (default: the warehouse)")
    args = parser.parse_args()

    spark = get_session(f"tidemark-{args.job}")
    store = RawStore(spark, args.raw)
    if args.job == "load":
        if not args.landing:
            parser.error("load needs --landing")
        if args.stream and args.full_refresh:
            parser.error("a full refresh reads all pages at once")
        load_id = args.load_id or datetime.now(UTC).strftime("%Y%m%dT%H%M%S%f")
        window = {"start": args.initial_date, "end": args.end_date}
        resources = dict(RESOURCES)
        if args.notes_table:
            own = notes_rows(dict(pair.split("=", 1) for pair in args.notes_table))
            resources[own.name] = own
        for resource in resources.values():
            if not resource.name.startswith(args.source):
                continue
            landing = f"{args.landing}/{resource.name}"
            if args.stream:
                checkpoint = f"{args.raw}/_checkpoints/{resource.name}/stream"
                try:
                    query = stream_resource(
                        store, resource, landing, checkpoint, not args.lines, args.files_per_batch, **window
                    )
                except AnalysisException as error:
                    if "PATH_NOT_FOUND" not in str(error):
                        raise
                else:
                    query.awaitTermination()
            else:
                load_resource(
                    store, resource, landing, load_id, not args.lines, args.full_refresh, **window
                )
        return 0
    raw = raw_tables(store)
    if args.job == "build":
        publish(spark, raw, args.database, args.tables)
        return 0
    results = check_report(raw, models_to_check(raw, shared_dir(spark, "models"))).cache()
    results.show(1000, truncate=False)
    return 0 if all_passed(results) else 1


if __name__ == "__main__":
    raise SystemExit(main())
