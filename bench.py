"""Time the headline queries and print one JSON line.

Each query is run once to warm up and then timed twice over whole tables, the
better time kept, its rows written to Spark's noop sink. ``stream_batch`` is one micro-batch of the retail
stream over every message, from text to written products.
"""

from __future__ import annotations

import json
import os
import time

from aisleflow.catalog import QUERIES
from aisleflow.session import build_session, work_folder
from aisleflow.sources import star_schema as star
from aisleflow.sources.dimensions import load_dimensions
from aisleflow.streaming.retail import RetailStream

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "daily_category_footfall",
    "daily_category_sale_summary",
    "daily_visitors",
    "daily_visitors_category_wise",
    "store_conversion",
    "daily_visit",
    "daily_visitors_by_count",
    "monthly_repeat_visitors",
    "user_visit_type",
    "visits_with_first_visit",
    "user_profile",
    "daily_product_count",
    "allergen_profile",
    "allergy_notifications",
    "parse_location_events",
    "parse_checkout_events",
]


def seconds(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = build_session(
        "aisleflow-bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in HEADLINE:
        run = lambda: QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()  # noqa: E731, B023
        run()
        timings[name] = min(seconds(run), seconds(run))

    root = work_folder(spark, "bench")
    star.message_lines(spark, SF_DIR).repartition(int(CPUS)).write.text(f"{root}/messages")
    star.location_events(spark, SF_DIR).write.parquet(f"{root}/events")
    dims = load_dimensions(star.racks(spark, SF_DIR), star.category(spark, SF_DIR))
    stream = RetailStream(spark, f"{root}/stream", dims, events_path=f"{root}/events")
    lines = spark.read.text(f"{root}/messages")
    stream.process(lines, 0)
    timings["stream_batch"] = seconds(lambda: stream.process(lines, 0))

    total = round(sum(timings.values()), 3)
    sf = os.path.basename(os.path.normpath(SF_DIR)).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": timings, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
