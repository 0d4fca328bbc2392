from aisleflow.plans.sales import order_items
from aisleflow.sources import events
from tests.conftest import at, checkout, leading_zeros, lines_frame, location, rows, two_users_one_day


def test_every_sample_line_is_read(spark):
    parsed = events.parse_messages(lines_frame(spark, two_users_one_day() + leading_zeros()))
    assert parsed.filter("problem IS NULL").count() == 15
    assert events.location_rows(parsed).count() == 11
    assert events.checkout_rows(parsed).count() == 4


def test_leading_zeros_and_numeric_user_ids(spark):
    parsed = events.parse_location_events(lines_frame(spark, [location(7, 5, "2020-05-06 07:08:09", org="04")]))
    assert rows(parsed, "eventId", "userId", "orgId", "rackId", "createdStamp") == [
        ("0", "7", 4, 5, at("2020-05-06 07:08:09"))
    ]


def test_event_type_and_routes(spark):
    lines = lines_frame(spark, two_users_one_day() + ['{"eventType":"Other"}', "{}"])
    assert sorted(map(str, (r.eventType for r in events.event_type(lines).collect()))) == (
        ["CheckOutEvent"] * 2 + ["LocationEvent"] * 5 + ["None", "Other"]
    )
    assert events.route_location(lines).count() == 5
    assert events.route_checkout(lines).count() == 2


def test_items_take_the_order_time_and_keep_their_own(spark):
    lines = lines_frame(spark, [checkout("u", [(81, 2, 1, 19.5), (82, 3, 2, 6)], "2021-03-04 17:45:10"),
                                checkout("u", [], "2021-03-04 17:45:10")])
    items = order_items(events.parse_checkout_events(lines))
    assert rows(items, "productId", "quantity", "unitPrice", "createdStamp", "orderTimestamp") == [
        (81, 1, "19.5", at("2021-03-04 17:45:10"), at("2021-03-01")),
        (82, 2, "6", at("2021-03-04 17:45:10"), at("2021-03-01")),
    ]


MALFORMED = {
    "note to self": "unreadable",
    location("u", '"r1"', "2020-05-06 12:00:00"): "unreadable",
    location("u", 1, "yesterday"): "unreadable",
    location("u", 1, "2020-05-06 12:00:00")[:60]: "unreadable",
    '{"eventType":"LocationEvent","Event":{"userId":"kim","rackId":"shelf5","time":"2019-08-20 16:00:01"}}': "no payload",
    location("u", 1, "2020-05-06 12:00:00").replace('"eventType"', '"kind"'): "no event type",
    location("u", 1, "2020-05-06 12:00:00").replace('"storeId":1,', ""): "missing field",
}


def test_malformed_lines_end_in_dead_letters(spark):
    good = location("u", 1, "2020-05-06 12:00:00")
    parsed = events.parse_messages(lines_frame(spark, [*MALFORMED, "", "   ", good, '{"eventType":"Other","x":1}']))
    assert dict(rows(events.dead_letter(parsed))) == MALFORMED
    assert events.location_rows(parsed).count() == 1


def test_a_stray_field_of_the_other_type_costs_nothing(spark):
    """orderId is text and invoiceAmount an object, but a location event has neither field."""
    line = location("u", 3, "2020-05-06 12:00:00").replace('"rackId"', '"orderId":"x","invoiceAmount":{},"rackId"')
    parsed = events.parse_messages(lines_frame(spark, [line]))
    assert rows(parsed, "problem") == [(None,)]
    assert rows(events.location_rows(parsed), "userId", "rackId", "createdStamp") == [("u", 3, at("2020-05-06 12:00:00"))]


def test_string_id_generation(spark):
    lines = lines_frame(spark, [
        '{"eventType":"LocationEvent","event":{"eventId":"31","userId":"kim","orgId":"north","storeId":"k2","rackId":"shelf5",'
        '"locEventType":0,"createdStamp":"2019-08-20 16:00:01"}}',
        '{"eventType":"CheckOutEvent","event":{"userId":"kim","orgId":"8","storeId":"k2","orderId":"b77",'
        '"orderItems":[{"productId":"sku-9","categoryId":"tea","quantity":5,"unitPrice":3.75}],'
        '"createdStamp":"2019-08-20 16:30:00"}}',
    ])
    seen = events.parse_string_id_location(lines)
    assert rows(seen, "orgId", "rackId", "locEventType") == [("north", "shelf5", "0")]
    assert rows(events.to_current_location(seen), "orgId", "rackId", "locEventType") == [("north", "shelf5", 0)]
    sold = events.to_current_checkout(events.parse_string_id_checkout(lines))
    item = order_items(sold).first()
    assert (item.orgId, item.orderId, item.productId, item.categoryId, item.quantity, item.unitPrice) == (
        "8", "b77", "sku-9", "tea", 5, "3.75"
    )


def test_items_without_a_field_and_bad_numbers_end_in_dead_letters(spark):
    whole = checkout("u", [(81, 2, 1, 19.5), (82, 3, 2, 6)], "2021-03-04 17:45:10")
    bad = [whole.replace('"categoryId":3,', ""), whole.replace('"quantity":2,', ""), whole.replace('"productId":82,', "")]
    parsed = events.parse_messages(lines_frame(spark, [whole, *bad]))
    assert dict(rows(events.dead_letter(parsed))) == {line: "bad item" for line in bad}
    text = (
        '{"eventType":"LocationEvent","event":{"eventId":"1","userId":"u","orgId":"o","storeId":"s","rackId":"r",'
        '"locEventType":"in","createdStamp":"2019-08-20 16:00:01"}}'
    )
    parsed = events.parse_messages(lines_frame(spark, [text]), events.STRING_IDS)
    assert rows(events.dead_letter(parsed)) == [(text, "bad number")]


def test_legacy_generation_in_both_time_spellings(spark):
    body = '"userId":"kim","orgId":"north","storeId":"k2","cart":[{"productId":"sku-9","quantity":5,"price":3.75}]'
    lines = lines_frame(spark, [
        f'{{"eventType":"CheckOutEvent","Event":{{{body},"checkOutTime":"2019-08-20 16:30:00"}}}}',
        f'{{"eventType":"CheckOutEvent","Event":{{{body},"checkOuttime":"2019-08-23 08:15:30"}}}}',
        '{"eventType":"LocationEvent","Event":{"userId":"lee","orgId":"north","storeId":"k2","rackId":"shelf5",'
        '"time":"2019-08-20 16:00:01"}}',
    ])
    sold = events.parse_legacy_checkout(lines)
    assert [r.createdStamp for r in sold.orderBy("createdStamp").collect()] == [
        at("2019-08-20 16:30:00"), at("2019-08-23 08:15:30")
    ]
    assert sold.first().orderItems[0].asDict() == {
        "productId": "sku-9", "quantity": 5, "categoryId": None, "unitPrice": "3.75"
    }
    assert rows(events.parse_legacy_location(lines), "rackId", "createdStamp") == [("shelf5", at("2019-08-20 16:00:01"))]
