from datetime import datetime

import pytest

from aisleflow.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "aisleflow-tests",
        "local[*]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "6g",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


@pytest.fixture(scope="session")
def dims(spark):
    """Racks 1 to 4, each in the category of its number."""
    rows = [(n, n, f"cat{n}") for n in range(1, 5)]
    return spark.createDataFrame(rows, "rackId INT, categoryId INT, categoryName STRING")


def location(user, rack, time, org="1", store=1, event_id=0, kind=0):
    """A location message; ``org`` is given as its digits, leading zeros and all."""
    user = f'"{user}"' if isinstance(user, str) else user
    return (
        f'{{"event":{{"eventId":{event_id},"orgId":{org},"storeId":{store},"userId":{user},"rackId":{rack},'
        f'"locEventType":{kind},"createdStamp":"{time}"}},"eventType":"LocationEvent"}}'
    )


def checkout(user, items, time, org="1", store=1, order=1, item_time="2021-03-01 00:00:00"):
    """A checkout message; items are (product, category, quantity, price)."""
    lines = ",".join(
        f'{{"orderItemId":{n},"productId":{p},"categoryId":{c},"quantity":{q},"unitPrice":{price},'
        f'"discountApplied":0.0,"createdStamp":"{item_time}"}}'
        for n, (p, c, q, price) in enumerate(items, 17)
    )
    return (
        f'{{"event":{{"orderId":{order},"userId":"{user}","orgId":{org},"storeId":{store},"orderItems":[{lines}],'
        f'"invoiceAmount":{sum(i[2] * i[3] for i in items)},"invoiceQuantity":{sum(i[2] for i in items)},'
        f'"createdStamp":"{time}"}},"eventType":"CheckOutEvent"}}'
    )


def two_users_one_day():
    seen = [("ann", 2, "08:05:11"), ("ann", 4, "08:07:30"), ("bob", 2, "10:40:02"), ("bob", 2, "10:55:40"), ("bob", 3, "11:01:19")]
    return [
        *(location(user, rack, f"2021-03-04 {time}", event_id=40 + n) for n, (user, rack, time) in enumerate(seen)),
        checkout("bob", [(201, 2, 3, 12.5), (305, 3, 1, 8.0)], "2021-03-04 11:20:00", order=7),
        checkout("ann", [(201, 2, 1, 12.5)], "2021-03-04 09:00:45", order=8),
    ]


def two_days():
    """Two users on two days, numeric user ids, one event that is no entry."""
    visits = [
        (45, 3, "14 12:00:05"),
        (45, 3, "14 12:30:00"),
        (31, 1, "14 13:10:44"),
        (31, 2, "15 09:00:00"),
        (31, 3, "15 09:02:10"),
        (31, 1, "15 18:45:59"),
        (45, 4, "15 20:15:00"),
    ]
    entries = [location(u, r, f"2022-07-{t}", event_id=70 + n) for n, (u, r, t) in enumerate(visits)]
    return [*entries, location(31, 1, "2022-07-14 13:25:00", event_id=90, kind=1)]


def leading_zeros():
    """Organisation 07, rack 880 without a category, three days."""
    place = {"org": "07", "store": 30}
    basket = [(61, 2, 4, 2.5), (62, 2, 1, 30.0)]
    seen = lambda rack, time: location("K9Z", rack, f"2023-02-{time}", **place)
    sold = lambda time: checkout("K9Z", basket, f"2023-02-{time}", order=91, **place)
    return [
        seen(2, "10 10:10:10"),
        sold("10 10:30:00"),
        seen(880, "10 11:00:00"),
        seen(880, "12 09:00:00"),
        seen(2, "13 15:00:00"),
        seen(2, "13 15:20:00"),
        sold("13 15:30:00"),
        seen(880, "13 16:00:00"),
    ]


def lines_frame(spark, lines):
    return spark.createDataFrame([(line,) for line in lines], "value STRING")


def rows(df, *columns):
    """Rows as a sorted list of tuples, of the given columns or all."""
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)
