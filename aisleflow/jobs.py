"""The three jobs from the command line.

    python -m aisleflow.jobs stream --messages IN --racks R --category C --root OUT
    python -m aisleflow.jobs archive --messages IN --root OUT
    python -m aisleflow.jobs allergens --profile P --output OUT
"""

from __future__ import annotations

import argparse
from functools import reduce

from pyspark.sql import SparkSession, functions as F

from aisleflow.plans.allergens import allergen_profile
from aisleflow.session import build_session
from aisleflow.sources.dimensions import load_dimensions
from aisleflow.sources.events import GENERATIONS
from aisleflow.sources.streams import read_event_stream
from aisleflow.sources.tables import append_table, read_table
from aisleflow.streaming.retail import TRIGGER, RetailStream, archive_raw_messages, for_each_batch

ALLERGEN_COLUMNS = "orgId STRING, storeId STRING, userId STRING, Allergen STRING"


def run_stream(spark: SparkSession, args: argparse.Namespace) -> None:
    dims = load_dimensions(read_table(spark, args.racks), read_table(spark, args.category))
    indicators = read_table(spark, args.indicators) if args.indicators else None
    stream = RetailStream(
        spark, args.root, dims, args.events, not args.all_events, args.legacy, indicators, args.state,
        GENERATIONS[args.generation],
    )
    if args.compact is not None:
        stream.compact(args.compact, args.into)
        return
    lines = read_event_stream(spark, args.messages)
    if args.chained:
        archiving = stream.start_archive(lines, args.once, args.every)
        if args.once:
            archiving.awaitTermination()
        stream.start_from_archive(args.once, args.every).awaitTermination()
    else:
        stream.start(lines, args.once, args.every).awaitTermination()


def run_archive(spark: SparkSession, args: argparse.Namespace) -> None:
    lines = read_event_stream(spark, args.messages)
    keep = lambda batch, batch_id: archive_raw_messages(batch, args.root, batch_id)
    for_each_batch(lines, keep, f"{args.root}/checkpoint", args.once, args.every).awaitTermination()


def run_allergens(spark: SparkSession, args: argparse.Namespace) -> None:
    """Append the profile rows the output does not hold yet, so a second run adds nothing."""
    found = allergen_profile(read_table(spark, args.profile), args.min_orders)
    stored = read_table(spark, args.output, ALLERGEN_COLUMNS)
    same = reduce(lambda a, b: a & b, [F.col(f"f.{c}").eqNullSafe(F.col(f"s.{c}")) for c in found.columns])
    append_table(found.alias("f").join(stored.alias("s"), same, "left_anti"), args.output)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="aisleflow")
    top.add_argument("--master")
    jobs = top.add_subparsers(dest="job", required=True)
    stream, archive = jobs.add_parser("stream"), jobs.add_parser("archive")
    for job in (stream, archive):
        job.add_argument("--messages", required=True)
        job.add_argument("--root", required=True)
        job.add_argument("--every", default=TRIGGER)
        job.add_argument("--once", action="store_true", help="process what is there and stop")
    stream.add_argument("--racks", required=True)
    stream.add_argument("--category", required=True)
    stream.add_argument("--events", help="table of all location events, for first visits")
    stream.add_argument("--indicators", help="table of allergen indicator products")
    stream.add_argument("--state", help="folder of the state logs, after a compaction")
    stream.add_argument("--all-events", action="store_true", help="count exits too")
    stream.add_argument("--legacy", action="store_true", help="months from 0, years from 1900")
    stream.add_argument("--generation", choices=list(GENERATIONS), default="current", help="of the messages")
    stream.add_argument("--compact", type=int, help="merge the state up to this batch into --into, and stop")
    stream.add_argument("--chained", action="store_true", help="archive by a stream of its own and make products from its archive")
    stream.add_argument("--into", help="new folder for the state logs")
    stream.set_defaults(run=run_stream)
    archive.set_defaults(run=run_archive)
    allergens = jobs.add_parser("allergens")
    allergens.add_argument("--profile", required=True)
    allergens.add_argument("--output", required=True)
    allergens.add_argument("--min-orders", type=int, default=3)
    allergens.set_defaults(run=run_allergens)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(spark or build_session(f"aisleflow-{args.job}", args.master), args)


if __name__ == "__main__":
    main()
