import os
import random

import pytest
from pyspark.sql import functions as F

from aisleflow.plans import conversion, footfall, sales, visitors
from aisleflow.sources.events import LEGACY, MIXED, STRING_IDS, checkout_rows, location_rows, parse_messages
from aisleflow.sources.streams import read_event_stream
from aisleflow.streaming.retail import RetailStream, dead_letters, distinct_daily_visitors, footfall_30s_counts, raw_messages, write_complete
from tests.conftest import checkout, leading_zeros, lines_frame, location, rows, two_days, two_users_one_day

PRODUCTS = (
    "dailyCategoryFootfall", "dailyCategorySaleWithCountAgg", "dailyVisitors",
    "dailyVisitorsCategoryWise", "dailyVisit",
)


def write_files(folder, lines, files):
    folder.mkdir(exist_ok=True)
    for n in range(files):
        (folder / f"part-{n}.txt").write_text("\n".join(lines[n::files]) + "\n")


def events_table(spark, path, lines):
    location_rows(parse_messages(lines_frame(spark, lines))).write.parquet(path)
    return path


def run_stream(spark, tmp_path, dims, lines, files, **settings):
    write_files(tmp_path / "in", lines, files)
    stream = RetailStream(spark, str(tmp_path / "out"), dims, **settings)
    source = read_event_stream(spark, str(tmp_path / "in"), max_files_per_trigger=1)
    stream.start(source, available_now=True).awaitTermination()
    return stream


def batch_products(spark, lines, dims):
    parsed = parse_messages(lines_frame(spark, lines))
    seen, items = visitors.entry_events(location_rows(parsed)), sales.order_items(checkout_rows(parsed))
    return {
        "dailyCategoryFootfall": footfall.daily_category_footfall(seen, dims),
        "dailyCategorySaleWithCountAgg": sales.daily_category_sale_summary(items, dims),
        "dailyVisitors": visitors.daily_visitors(seen, seen),
        "dailyVisitorsCategoryWise": conversion.daily_visitors_category_wise(seen, items, dims),
        "dailyVisit": visitors.daily_visit(seen),
    }


def contents(stream, names=PRODUCTS):
    return {name: rows(stream.product(name)) for name in names}


@pytest.fixture(scope="module")
def streamed(spark, tmp_path_factory, dims):
    """Three scenarios and some noise in four batches."""
    tmp_path = tmp_path_factory.mktemp("stream")
    lines = two_users_one_day() + two_days() + leading_zeros() + ["noise", '{"eventType":"LocationEvent"}']
    events = events_table(spark, str(tmp_path / "events"), lines)
    return run_stream(spark, tmp_path, dims, lines, 4, events_path=events), lines


def test_stream_equals_batch(spark, streamed, dims):
    stream, lines = streamed
    for name, product in batch_products(spark, lines, dims).items():
        assert rows(stream.product(name)) == rows(product), name


def test_archive_and_dead_letters_keep_lines(spark, streamed):
    stream, lines = streamed
    assert sorted(r.msg for r in raw_messages(spark, stream.root).collect()) == sorted(lines)
    assert rows(dead_letters(spark, stream.root)) == [
        ("noise", "unreadable"), ('{"eventType":"LocationEvent"}', "no payload")
    ]


def test_replayed_batch_changes_nothing(spark, streamed):
    stream, _ = streamed
    before = contents(stream)
    last = [r.msg for r in spark.read.parquet(f"{stream.root}/message/batch_id=3").collect()]
    stream.process(lines_frame(spark, last), 3)
    assert contents(stream) == before


def test_compaction_keeps_products(spark, streamed, dims):
    stream, lines = streamed
    before = contents(stream)
    stream = stream.compact(3, f"{stream.root}/state-2")
    late = location("9", 1, "2022-07-14 10:00:00")
    stream.process(lines_frame(spark, [late]), 4)
    after = contents(stream)
    assert after["dailyCategorySaleWithCountAgg"] == before["dailyCategorySaleWithCountAgg"]
    whole = batch_products(spark, [*lines, late], dims)
    for name in ("dailyCategoryFootfall", "dailyVisitorsCategoryWise", "dailyVisit"):
        assert after[name] == rows(whole[name]), name
    log = stream.log("dailyCategoryFootFallTemp")
    assert log.as_of(3).agg(F.sum("footfall")).first()[0] == sum(r[-1] for r in before["dailyCategoryFootfall"])


def test_one_batch_counts_its_events_once(spark, tmp_path, dims):
    lines = leading_zeros()[:2]
    stream = RetailStream(spark, str(tmp_path), dims)
    for _ in range(2):
        stream.process(lines_frame(spark, lines), 0)
        assert rows(stream.product("dailyCategorySaleWithCountAgg"), "saleCountAgg", "saleAmountAgg") == [(5, 40.0)]
        assert rows(stream.product("dailyVisitorsCategoryWise"), "total", "converted") == [(1, 1)]


def test_late_event_changes_its_own_day_only(spark, tmp_path, dims):
    stream = RetailStream(spark, str(tmp_path), dims)
    stream.process(lines_frame(spark, [location("1", 1, "2016-12-09 09:00:00")]), 0)
    stream.process(lines_frame(spark, [location("1", 2, "2016-12-10 09:00:00")]), 1)
    stream.process(lines_frame(spark, [location("2", 1, "2016-12-09 11:00:00")]), 2)
    assert rows(stream.product("dailyCategoryFootfall"), "day", "categoryId", "footfallCount") == [(10, 2, 1), (9, 1, 2)]
    assert rows(stream.product("dailyVisitors"), "day", "new_visitors", "repeated_visitors") == [(10, 0, 1), (9, 2, 0)]


def test_first_visits_from_own_state(spark, tmp_path, dims):
    """Without an events table the stream remembers first visits itself."""
    stream = run_stream(spark, tmp_path, dims, two_days(), 1)
    assert rows(stream.product("dailyVisitors"), "day", "new_visitors", "repeated_visitors") == [(14, 2, 0), (15, 0, 2)]
    stream = stream.compact(0, str(tmp_path / "state-2"))
    stream.process(lines_frame(spark, [location(31, 1, "2022-07-16 09:00:00"), location(88, 1, "2022-07-16 09:00:00")]), 1)
    assert rows(stream.product("dailyVisitors").filter("day = 16"), "new_visitors", "repeated_visitors") == [(1, 1)]


def test_notifications_for_buyers_of_the_batch(spark, tmp_path, dims):
    indicators = spark.createDataFrame([(10,)], "productId BIGINT")
    stream = RetailStream(spark, str(tmp_path), dims, indicators=indicators)
    buy = lambda user, order, product: checkout(user, [(product, 1, 1, 5.0)], "2016-12-09 09:00:00", order=order)
    stream.process(lines_frame(spark, [buy("u1", 1, 10), buy("u2", 2, 10), buy("u3", 3, 11)]), 0)
    stream.process(lines_frame(spark, [buy("u1", 4, 10)]), 1)
    quiet = "no allergy detected uptil now"
    assert rows(stream.notifications(), "batch_id", "userId", "purchasedCount", "Allergy") == [
        (0, "u1", 1, quiet), (0, "u2", 1, quiet), (1, "u1", 2, "allergy detected")
    ]


def test_thirty_second_counts_close_behind_the_watermark(spark, tmp_path):
    times = ["09:17:03", "09:17:29", "09:17:30", "09:17:58", "09:21:00", "09:21:11"]
    (tmp_path / "in").mkdir()
    for n, t in enumerate([*times, "09:17:20"]):
        (tmp_path / "in" / f"{n}.txt").write_text(location("u1", 1, f"2020-05-06 {t}") + "\n")
        os.utime(tmp_path / "in" / f"{n}.txt", (1_500_000_000 + n, 1_500_000_000 + n))
    lines = read_event_stream(spark, str(tmp_path / "in"), max_files_per_trigger=1)
    counts = footfall_30s_counts(location_rows(parse_messages(lines)), "1 minute")
    (
        counts.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ckpt"))
        .trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    )
    closed = spark.read.parquet(str(tmp_path / "out"))
    assert [tuple(r) for r in closed.orderBy("bucket").select(F.date_format("bucket", "mm:ss"), "footfall").collect()] == [
        ("17:00", 2), ("17:30", 2)
    ]


def text_location(org, user, rack):
    return (
        f'{{"eventType":"LocationEvent","event":{{"eventId":"1","userId":"{user}","orgId":"{org}","storeId":"k2",'
        f'"rackId":"{rack}","locEventType":"0","createdStamp":"2019-08-20 16:00:01"}}}}'
    )


def test_string_id_messages_keep_organisations_apart(spark, tmp_path):
    dims = spark.createDataFrame([("shelf5", "tea", "Tea")], "rackId STRING, categoryId STRING, categoryName STRING")
    sale = (
        '{"eventType":"CheckOutEvent","event":{"userId":"kim","orgId":"north","storeId":"k2","orderId":"b77",'
        '"orderItems":[{"productId":"sku-9","categoryId":"tea","quantity":"5","unitPrice":3.75}],'
        '"createdStamp":"2019-08-20 16:30:00"}}'
    )
    lines = [text_location("north", "kim", "shelf5"), text_location("south", "lee", "shelf5"), text_location("south", "kim", "none"), sale]
    stream = RetailStream(spark, str(tmp_path), dims, generation=STRING_IDS)
    stream.process(lines_frame(spark, lines), 0)
    assert rows(stream.product("dailyCategoryFootfall"), "orgId", "storeId", "categoryId", "footfallCount") == [
        ("north", "k2", "tea", 1), ("south", "k2", "tea", 1)
    ]
    assert rows(stream.product("dailyCategorySaleWithCountAgg"), "orgId", "categoryId", "saleCountAgg") == [("north", "tea", 5)]
    assert rows(stream.product("dailyVisitors"), "orgId", "new_visitors") == [("north", 1), ("south", 2)]
    assert dead_letters(spark, stream.root).count() == 0


def test_replay_of_a_compacted_batch_changes_nothing(spark, tmp_path, dims):
    days = [[location("a", 1, "2022-07-14 09:00:00"), location("b", 1, "2022-07-14 10:00:00")], [location("a", 2, "2022-07-14 11:00:00")]]
    stream = RetailStream(spark, str(tmp_path / "out"), dims)
    for n, lines in enumerate(days):
        stream.process(lines_frame(spark, lines), n)
    stream = stream.compact(1, str(tmp_path / "state-2"))
    before = contents(stream)
    stream.process(lines_frame(spark, days[1]), 1)
    assert contents(stream) == before
    more = [location("c", 1, "2022-07-14 12:00:00")]
    stream.process(lines_frame(spark, more), 2)
    whole = batch_products(spark, [*days[0], *days[1], *more], dims)
    assert contents(stream) == {name: rows(whole[name]) for name in PRODUCTS}


@pytest.mark.parametrize("outside", [False, True])
def test_late_first_visit_corrects_the_day_it_was_on(spark, tmp_path, dims, outside):
    first, late = location("a", 1, "2022-07-15 09:00:00"), location("a", 1, "2022-07-14 09:00:00")
    events = events_table(spark, str(tmp_path / "events"), [first, late]) if outside else None
    stream = RetailStream(spark, str(tmp_path / "out"), dims, events_path=events)
    stream.process(lines_frame(spark, [first]), 0)
    stream.process(lines_frame(spark, [late]), 1)
    assert rows(stream.product("dailyVisitors"), "day", "new_visitors", "repeated_visitors") == [(14, 1, 0), (15, 0, 1)]


def test_oldest_generation(spark, tmp_path):
    dims = spark.createDataFrame([("shelf5", "tea", "Tea")], "rackId STRING, categoryId STRING, categoryName STRING")
    seen = lambda user, rack: f'{{"eventType":"LocationEvent","Event":{{"userId":"{user}","orgId":"north","storeId":"k2","rackId":"{rack}","time":"2019-08-20 16:00:01"}}}}'
    sold = lambda name: '{"eventType":"CheckOutEvent","Event":{"userId":"kim","orgId":"north","storeId":"k2","orderId":"b7","cart":[{"productId":"sku","quantity":5,"categoryId":"tea","price":"3.75"}],"%s":"2019-08-20 16:30:00"}}' % name
    lines = [seen("kim", "shelf5"), seen("lee", "none"), sold("checkOutTime"), sold("checkOuttime"), "noise", '{"eventType":"LocationEvent"}', '{"eventType":"LocationEvent","Event":{"userId":"x"}}']
    stream = RetailStream(spark, str(tmp_path), dims, generation=LEGACY)
    for _ in range(2):
        stream.process(lines_frame(spark, lines), 0)
    assert rows(stream.product("dailyCategoryFootfall"), "orgId", "categoryId", "footfallCount") == [("north", "tea", 1)]
    assert rows(stream.product("dailyCategorySaleWithCountAgg"), "saleAmountAgg", "saleCountAgg") == [(37.5, 10)]
    assert rows(stream.product("dailyVisitorsCategoryWise"), "total", "converted", "failed") == [(1, 1, 0)]
    assert rows(stream.product("dailyVisitors"), "new_visitors", "repeated_visitors", "total") == [(2, 0, 2)]
    assert sorted(p for _, p in rows(dead_letters(spark, stream.root))) == ["missing field", "no payload", "unreadable"]


def test_lines_of_three_generations_in_one_batch(spark, tmp_path):
    """Each line is read by its own envelope; numbers become text and lose leading zeros."""
    dims = spark.createDataFrame([("2", "4", "Four"), ("shelf5", "tea", "Tea")], "rackId STRING, categoryId STRING, categoryName STRING")
    oldest = lambda event: '{"eventType":"%s","Event":{"userId":"kim","orgId":"north","storeId":"k2",%s}}' % event
    lines = [
        location("ann", 2, "2019-08-20 09:00:00", org="07"),
        checkout("ann", [(10, 4, 3, 2.5)], "2019-08-20 09:30:00", org="07"),
        text_location("north", "kim", "shelf5"),
        oldest(("LocationEvent", '"rackId":"shelf5","time":"2019-08-20 17:00:01"')),
        oldest(("CheckOutEvent", '"orderId":"b7","cart":[{"productId":"sku","quantity":5,"categoryId":"tea","price":"3.75"}],"checkOuttime":"2019-08-20 16:30:00"')),
    ]
    bad = [
        "noise",
        '{"eventType":"LocationEvent"}',
        '{"eventType":"LocationEvent","Event":{"userId":"x"}}',
        oldest(("LocationEvent", '"rackId":"r","time":"some day"')),
        location("ann", 2, "some day"),
        checkout("ann", [], "2019-08-20 09:30:00").replace('"orderItems":[]', '"orderItems":[{"productId":"p","categoryId":"c","quantity":"many"}]'),
    ]
    stream = RetailStream(spark, str(tmp_path), dims, generation=MIXED)
    for _ in range(2):
        stream.process(lines_frame(spark, lines + bad + ['{"eventType":"Heartbeat","Event":{}}']), 0)
    assert rows(stream.product("dailyCategoryFootfall"), "orgId", "storeId", "categoryId", "footfallCount") == [
        ("7", "1", "4", 1), ("north", "k2", "tea", 2)
    ]
    assert rows(stream.product("dailyCategorySaleWithCountAgg"), "orgId", "categoryId", "saleAmountAgg", "saleCountAgg") == [
        ("7", "4", 7.5, 3), ("north", "tea", 18.75, 5)
    ]
    assert rows(stream.product("dailyVisit"), "userId", "VisitCount") == [("ann", 1), ("kim", 2)]
    problems = {v: p for v, p in rows(dead_letters(spark, stream.root))}
    assert [problems.get(line) for line in bad] == [
        "unreadable", "no payload", "missing field", "unreadable", "unreadable", "bad item"
    ]
    assert len(problems) == len(bad)


@pytest.mark.parametrize("generation, lines", [(LEGACY, "legacy_lines"), (STRING_IDS, "string_id_lines")])
def test_a_mixed_stream_reads_one_generation_as_its_own_does(spark, generation, lines):
    from aisleflow.sources import star_schema

    text = getattr(star_schema, lines)(spark, "/root/testdata/sf0.001")
    own, mixed = parse_messages(text, generation), parse_messages(text, MIXED)
    assert own.columns == mixed.columns
    assert own.exceptAll(mixed).count() == mixed.exceptAll(own).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_any_dealing_of_messages_to_batches_gives_the_same_products(spark, tmp_path, dims, seed):
    """Messages in random batches, some batches run twice, products as of one batch over all of them."""
    own = random.Random(seed)
    lines = two_users_one_day() + two_days() + leading_zeros()
    own.shuffle(lines)
    cut = sorted(own.sample(range(1, len(lines)), 2))
    stream = RetailStream(spark, str(tmp_path), dims)
    for n, (a, b) in enumerate(zip([0, *cut], [*cut, len(lines)])):
        for _ in range(own.randint(1, 2)):
            stream.process(lines_frame(spark, lines[a:b]), n)
    for name, product in batch_products(spark, lines, dims).items():
        assert rows(stream.product(name)) == rows(product), name


def test_a_batch_takes_few_jobs_and_one_write_for_all_products(spark, tmp_path, dims):
    stream = RetailStream(spark, str(tmp_path), dims)
    stream.process(lines_frame(spark, two_users_one_day()), 0)
    files = [f for f in (tmp_path / "product").rglob("*.parquet")]
    assert len(files) == len({f.parent for f in files}) == 1  # one day, one file of all products
    assert len(list((tmp_path / "state" / "facts").rglob("*.parquet"))) == 1


def test_products_without_rows_can_be_read(spark, tmp_path, dims):
    stream = RetailStream(spark, str(tmp_path), dims)
    assert stream.product("dailyVisitors").count() == 0
    stream.process(lines_frame(spark, [location("a", 1, "2022-07-15 09:00:00")]), 0)
    assert stream.product("dailyCategorySaleWithCountAgg").count() == 0


def test_more_than_a_thousand_days_in_a_batch(spark, tmp_path, dims):
    lines = [location("a", 1, f"{2000 + n // 300}-{n % 300 // 25 + 1:02d}-{n % 25 + 1:02d} 09:00:00") for n in range(1100)]
    stream = RetailStream(spark, str(tmp_path), dims)
    stream.process(lines_frame(spark, lines), 0)
    assert stream.product("dailyCategoryFootfall").agg(F.sum("footfallCount")).first()[0] == 1100


def test_monthly_and_flagged_visits_of_the_stream(spark, tmp_path, dims):
    stream = run_stream(spark, tmp_path, dims, two_days(), 2, monthly=True)
    months = stream.monthly_visits()
    assert rows(visitors.repeat_by_count(months), "userId", "month", "VisitCount") == [("31", 7, 4), ("45", 7, 3)]
    flags = stream.product("newRepeatDaily").groupBy("time").agg(F.sum("New").alias("n"), F.sum("Repeat").alias("r"))
    assert sorted((r.n, r.r) for r in flags.collect()) == [(1, 1), (1, 1)]


def test_a_batch_does_not_read_the_logs_of_earlier_batches(spark, tmp_path, dims):
    """Earlier logs are spoilt; the merged days and the batch's own log are all that the next batch needs."""
    lines = two_users_one_day() + two_days() + leading_zeros()
    stream = RetailStream(spark, str(tmp_path), dims, monthly=True)
    for n in range(2):
        stream.process(lines_frame(spark, lines[n::4]), n)
    for log in (tmp_path / "state" / "facts").rglob("*.parquet"):
        log.write_bytes(b"spoilt")
    again = RetailStream(spark, str(tmp_path), dims, monthly=True)  # as after a restart
    for n in range(2, 4):
        again.process(lines_frame(spark, lines[n::4]), n)
    for name, product in batch_products(spark, lines, dims).items():
        assert rows(again.product(name)) == rows(product), name


def test_merged_days_keep_two_versions_and_equal_the_log(spark, tmp_path, dims):
    lines = two_users_one_day() + two_days() + leading_zeros()
    stream = RetailStream(spark, str(tmp_path), dims)
    for n in range(4):
        stream.process(lines_frame(spark, lines[n::4]), n)
    slots = list((tmp_path / "state" / "days").glob("event_date=*/slot=*"))
    assert len(slots) <= 2 * len({s.parent for s in slots})
    columns = ["table", "orgId", "storeId", "userId", "categoryId", "time", "n", "amount", "firstTime"]
    from aisleflow.plans.facts import merged

    assert rows(stream.days.newest(), *columns) == rows(merged(stream.log("facts").as_of(3)), *columns)


def test_an_older_batch_run_again_leaves_newer_days_alone(spark, tmp_path, dims):
    days = [[location("a", 1, "2022-07-14 09:00:00")], [location("b", 1, "2022-07-14 10:00:00")], [location("c", 2, "2022-07-14 11:00:00")]]
    stream = RetailStream(spark, str(tmp_path), dims)
    for n in (0, 1, 0, 2):
        stream.process(lines_frame(spark, days[n]), n)
    whole = batch_products(spark, sum(days, []), dims)
    assert contents(stream) == {name: rows(whole[name]) for name in PRODUCTS}


def test_a_second_stream_reads_the_archive_of_the_first(spark, tmp_path, dims):
    lines = two_users_one_day() + two_days() + ["noise"]
    write_files(tmp_path / "in", lines[:6], 2)
    stream = RetailStream(spark, str(tmp_path / "out"), dims)
    source = lambda: read_event_stream(spark, str(tmp_path / "in"), max_files_per_trigger=1)
    stream.start_archive(source(), available_now=True).awaitTermination()
    assert stream.product("dailyVisit").count() == 0  # archived, not yet looked at
    stream.start_from_archive(available_now=True).awaitTermination()
    (tmp_path / "in" / "more.txt").write_text("\n".join(lines[6:]) + "\n")
    stream.start_archive(source(), available_now=True).awaitTermination()
    stream.start_from_archive(available_now=True).awaitTermination()
    assert sorted(r.msg for r in stream.archived().collect()) == sorted(lines)
    for name, product in batch_products(spark, lines, dims).items():
        assert rows(stream.product(name)) == rows(product), name
    assert rows(dead_letters(spark, stream.root)) == [("noise", "unreadable")]


def test_native_distinct_visitors_across_batches(spark, tmp_path):
    times = [("u1", "06 09:00"), ("u1", "06 21:00"), ("u2", "06 22:00"), ("u1", "07 08:00"), ("u1", "06 09:00"), ("u2", "07 23:00"), (None, "07 23:30")]
    (tmp_path / "in").mkdir()
    for n, (user, t) in enumerate(times):
        line = location(user or "x", 1, f"2020-05-{t}:00")
        (tmp_path / "in" / f"{n}.txt").write_text((line if user else line.replace('"x"', "null")) + "\n")
        os.utime(tmp_path / "in" / f"{n}.txt", (1_500_000_000 + n, 1_500_000_000 + n))
    lines = read_event_stream(spark, str(tmp_path / "in"), max_files_per_trigger=1)
    counts = distinct_daily_visitors(location_rows(parse_messages(lines)))
    write_complete(counts, str(tmp_path / "out"), str(tmp_path / "ckpt"), available_now=True).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out")).select(F.dayofmonth("time"), "visitors")) == [(6, 2), (7, 2)]


def test_messages_of_one_row_group_keep_all_cores_busy(spark):
    """The events are one file of one row group; its lines are made, stored and read by as many tasks as there are cores."""
    from aisleflow import catalog
    from aisleflow.sources import star_schema

    d = "/root/testdata/sf0.001"
    folder = catalog._message_folder(spark, d)
    written = [f for f in os.listdir(folder) if f.endswith(".txt") and os.path.getsize(f"{folder}/{f}")]
    assert len(written) >= spark.sparkContext.defaultParallelism
    assert spark.read.text(folder).exceptAll(star_schema.message_lines(spark, d)).count() == 0
    assert spark.read.text(folder).count() == spark.read.parquet(f"{d}/events.parquet").count()


def test_dealt_lines_are_whole(spark):
    from aisleflow import catalog

    lines = spark.createDataFrame([(t,) for t in ("a", "a", "b", "c", "", None, None)], "value STRING")
    parts = [[r.value for r in part.collect()] for part in catalog._dealt(spark, lines, 3)]
    assert sorted(sum(parts, []), key=str) == sorted(["a", "a", "b", "c", "", None, None], key=str)
    assert sum("a" in part for part in parts) == 1


def test_mixed_lines_are_those_of_each_generation(spark):
    from aisleflow.sources import star_schema as star

    d = "/root/testdata/sf0.001"
    mixed, own = star.mixed_lines(spark, d), star.message_lines(spark, d).unionAll(star.string_id_lines(spark, d)).unionAll(star.legacy_lines(spark, d))
    assert mixed.exceptAll(own).count() == own.exceptAll(mixed).count() == 0


def test_a_large_archive_file_is_read_by_many_tasks(spark, tmp_path):
    import pyarrow.parquet as pq

    from aisleflow.streaming.retail import archive_raw_messages

    lines = spark.range(0, 400_000, 1, 1).select(F.concat(F.sha2(F.col("id").cast("string"), 512), F.sha2(F.col("id").cast("string"), 256)).alias("value"))
    folder = archive_raw_messages(lines, str(tmp_path), 0)
    file, = [f for f in os.listdir(folder) if f.endswith(".parquet")]
    assert pq.ParquetFile(f"{folder}/{file}").metadata.num_row_groups >= 3
    assert raw_messages(spark, str(tmp_path)).count() == 400_000


def test_a_batch_parses_its_lines_in_one_job_before_the_others(spark, tmp_path, dims, monkeypatch):
    """Jobs that run side by side find the parsed lines stored; before, each of them could parse."""
    from aisleflow.streaming import retail

    seen, together = [], retail.run_together
    stored = lambda: sum(i.numCachedPartitions() for i in spark.sparkContext._jsc.sc().getRDDStorageInfo())
    before = stored()
    monkeypatch.setattr(retail, "run_together", lambda s, jobs: (seen.append(stored() - before), together(s, jobs)))
    RetailStream(spark, str(tmp_path), dims).process(lines_frame(spark, two_days() + ["no json"]), 0)
    assert seen[0] > 0
    assert [r.value for r in dead_letters(spark, str(tmp_path)).collect()] == ["no json"]
