"""JSON messages to typed event rows.

The event type is read first, then the payload by the fields of that type
alone. Lines that cannot be used end in the dead letters.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from aisleflow.model import (
    CHECKOUT_EVENT,
    CHECKOUT_FIELDS,
    LEGACY_FIELDS,
    LEGACY_OTHER_TIME,
    LOCATION_EVENT,
    LOCATION_FIELDS,
    STRING_CHECKOUT_FIELDS,
    STRING_LOCATION_FIELDS,
    with_text_ids,
)

CORRUPT = "_corrupt"

JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
    "allowNumericLeadingZeros": "true",
}


@dataclass(frozen=True)
class Generation:
    """One generation of messages: the payload fields of its two event types, and whether ids are text.

    The oldest one has an envelope and names of its own; they are read into those of the text ids.
    Where generations are mixed each line is read by its own envelope, and ids are text.
    """

    location: str
    checkout: str
    text_ids: bool = False
    oldest: bool = False
    mixed: bool = False

    def fields(self, event_type: str) -> str:
        return self.location if event_type == LOCATION_EVENT else self.checkout


CURRENT = Generation(LOCATION_FIELDS, CHECKOUT_FIELDS)
STRING_IDS = Generation(STRING_LOCATION_FIELDS, STRING_CHECKOUT_FIELDS, text_ids=True)
LEGACY = Generation(STRING_LOCATION_FIELDS, STRING_CHECKOUT_FIELDS, text_ids=True, oldest=True)
MIXED = Generation(STRING_LOCATION_FIELDS, STRING_CHECKOUT_FIELDS, text_ids=True, mixed=True)
GENERATIONS = {"current": CURRENT, "string-ids": STRING_IDS, "legacy": LEGACY, "mixed": MIXED}

# Column of a parsed line that holds the payload of an event type.
PAYLOAD = {LOCATION_EVENT: "location", CHECKOUT_EVENT: "checkout"}

# Without these a row belongs to no store, day or visitor.
REQUIRED = {
    LOCATION_EVENT: ["orgId", "storeId", "userId", "rackId", "createdStamp"],
    CHECKOUT_EVENT: ["orgId", "storeId", "userId", "createdStamp"],
}

# Without these an item is no sale.
REQUIRED_OF_ITEM = ["productId", "categoryId", "quantity"]


@lru_cache(maxsize=None)
def _schema(fields: str) -> StructType:
    return StructType.fromDDL(fields)


def _names(fields: str) -> list[str]:
    return _schema(fields).names


def _envelope(fields: str) -> str:
    return f"event STRUCT<{fields}>, {CORRUPT} STRING"


def _computed_once(*columns: Column) -> Column:
    """Columns as the output of a generator.

    Filters on them stay above it; pushed below a projection they would carry
    the parsing of the text along and repeat it for every condition.
    """
    return F.inline(F.array(F.struct(*columns)))


def parse_messages(lines: DataFrame, generation: Generation = CURRENT) -> DataFrame:
    """``value`` lines to (value, eventType, location, checkout, problem); blank lines are skipped.

    ``location`` and ``checkout`` hold the payload of a line of their type.
    ``problem`` is null for usable lines and for event types nobody handles.
    """
    filled = lines.filter(F.trim("value") != "")
    head = F.from_json("value", f"eventType STRING, {CORRUPT} STRING", JSON_OPTIONS).alias("head")
    typed = filled.select("value", _computed_once(head)).select("value", "head.*")
    if generation.mixed:
        parsed = _mixed_payloads(typed)
    elif generation.oldest:
        parsed = _oldest_payloads(typed, F.col("value"))
    else:
        parsed = _payloads(typed, generation)
    return parsed.select(
        "value",
        "eventType",
        *[F.col(f"{column}.event").alias(column) for column in PAYLOAD.values()],
        _problem().alias("problem"),
    )


def _payloads(typed: DataFrame, generation: Generation) -> DataFrame:
    payloads = [
        F.when(
            F.col("eventType") == event_type,
            F.from_json("value", _envelope(generation.fields(event_type)), JSON_OPTIONS),
        ).alias(column)
        for event_type, column in PAYLOAD.items()
    ]
    return typed.select("value", "eventType", CORRUPT, _computed_once(*payloads))


def _mixed_payloads(typed: DataFrame) -> DataFrame:
    """Payloads of lines of all generations under the names of the text-id one.

    Current messages have the same names, so their numbers are read as text. Only a line that
    holds no payload by these names is read a second time, as one of the oldest generation.
    """
    newer = _payloads(typed, MIXED).select("value", "eventType", CORRUPT, F.struct(*PAYLOAD.values()).alias("newer"))
    found = [F.col(f"newer.{c}.{part}").isNotNull() for c in PAYLOAD.values() for part in ("event", CORRUPT)]
    left = F.when(~reduce(lambda a, b: a | b, found), F.col("value"))
    read = _oldest_payloads(newer, left)
    return read.select(
        "value", "eventType", CORRUPT,
        *[F.when(left.isNull(), F.col(f"newer.{c}")).otherwise(F.col(c)).alias(c) for c in PAYLOAD.values()],
    )


def _oldest_payloads(typed: DataFrame, text: Column) -> DataFrame:
    """Payloads of the oldest generation, read from ``text``, under the names of the text-id one.

    Its location events all mark an entry, its cart becomes the order items.
    """
    own = F.from_json(text, f"Event STRUCT<{LEGACY_FIELDS}>, {CORRUPT} STRING", JSON_OPTIONS).alias("m")
    other = F.from_json(text, f"Event STRUCT<{LEGACY_OTHER_TIME}>", JSON_OPTIONS)["Event"]["checkOuttime"].alias("late")
    read = typed.select("*", _computed_once(own, other))
    m = F.col("m.Event")
    given = {
        LOCATION_EVENT: {"locEventType": F.lit("0"), "createdStamp": m["time"]},
        CHECKOUT_EVENT: {
            "createdStamp": F.coalesce(m["checkOutTime"], F.col("late")),
            "orderItems": F.transform(
                m["cart"],
                lambda i: _named(
                    STRING_CHECKOUT_FIELDS, "orderItems",
                    {"productId": i["productId"], "categoryId": i["categoryId"], "quantity": i["quantity"], "unitPrice": i["price"]},
                ),
            ),
        },
    }
    has = {n: m[n] for n in _names(LEGACY_FIELDS)}
    columns = []
    for event_type, column in PAYLOAD.items():
        fields = LEGACY.fields(event_type)
        event = F.when(m.isNotNull(), _named(fields, None, {**has, **given[event_type]}))
        payload = F.struct(event.alias("event"), F.col(f"m.{CORRUPT}").alias(CORRUPT))
        columns.append(F.when(F.col("eventType") == event_type, payload).alias(column))
    return read.select(*typed.columns, *columns)


def _named(fields: str, inside: str | None, values: dict[str, Column]) -> Column:
    """A struct of the fields (or of the items of one of them), from the values there are; the others are null."""
    kind = _schema(fields) if inside is None else _schema(fields)[inside].dataType.elementType
    return F.struct(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in kind])


def _problem() -> Column:
    problem = F.when(F.col(CORRUPT).isNotNull(), F.lit("unreadable")).when(
        F.col("eventType").isNull(), F.lit("no event type")
    )
    for event_type, column in PAYLOAD.items():
        missing = reduce(lambda a, b: a | b, [F.col(f"{column}.event.{n}").isNull() for n in REQUIRED[event_type]])
        problem = problem.when(
            F.col("eventType") == event_type,
            F.when(F.col(f"{column}.{CORRUPT}").isNotNull(), F.lit("unreadable"))
            .when(F.col(f"{column}.event").isNull(), F.lit("no payload"))
            .when(missing, F.lit("missing field"))
            .when(_bad_number(event_type, column), F.lit("bad number"))
            .when(_bad_item(event_type, column), F.lit("bad item")),
        )
    return problem


def _no_number(text: Column) -> Column:
    """Whether a field that is counted or compared as a number is given and is none."""
    return text.isNotNull() & text.try_cast("int").isNull()


def _bad_number(event_type: str, column: str) -> Column:
    if event_type != LOCATION_EVENT:
        return F.lit(False)
    return _no_number(F.col(f"{column}.event.locEventType"))


def _bad_item(event_type: str, column: str) -> Column:
    if event_type != CHECKOUT_EVENT:
        return F.lit(False)
    bad = lambda i: reduce(lambda a, b: a | b, [i[n].isNull() for n in REQUIRED_OF_ITEM], _no_number(i["quantity"]))
    return F.coalesce(F.exists(f"{column}.event.orderItems", bad), F.lit(False))


def event_type(lines: DataFrame) -> DataFrame:
    """Each line with its event type; the payload is not looked at."""
    own = F.from_json("value", "eventType STRING", JSON_OPTIONS)["eventType"].alias("eventType")
    return lines.select("value", _computed_once(own))


def route_location(lines: DataFrame) -> DataFrame:
    return event_type(lines).filter(F.col("eventType") == LOCATION_EVENT).select("value")


def route_checkout(lines: DataFrame) -> DataFrame:
    return event_type(lines).filter(F.col("eventType") == CHECKOUT_EVENT).select("value")


def location_rows(parsed: DataFrame, generation: Generation = CURRENT) -> DataFrame:
    return _rows(parsed, LOCATION_EVENT, generation)


def checkout_rows(parsed: DataFrame, generation: Generation = CURRENT) -> DataFrame:
    return _rows(parsed, CHECKOUT_EVENT, generation)


def _rows(parsed: DataFrame, event_type: str, generation: Generation) -> DataFrame:
    usable = (F.col("eventType") == event_type) & F.col("problem").isNull()
    column = PAYLOAD[event_type]
    return parsed.filter(usable).select(*[f"{column}.{n}" for n in _names(generation.fields(event_type))])


def parse_location_events(lines: DataFrame) -> DataFrame:
    return location_rows(parse_messages(lines))


def parse_checkout_events(lines: DataFrame) -> DataFrame:
    return checkout_rows(parse_messages(lines))


def dead_letter(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("problem").isNotNull()).select("value", "problem")


def parse_string_id_location(lines: DataFrame) -> DataFrame:
    return location_rows(parse_messages(lines, STRING_IDS), STRING_IDS)


def parse_string_id_checkout(lines: DataFrame) -> DataFrame:
    return checkout_rows(parse_messages(lines, STRING_IDS), STRING_IDS)


def parse_legacy_location(lines: DataFrame) -> DataFrame:
    """Oldest location messages under the current names; they all mark an entry."""
    return _legacy(lines, LOCATION_EVENT).select(
        F.lit(None).cast("string").alias("eventId"),
        "userId",
        "orgId",
        "storeId",
        "rackId",
        F.lit("0").alias("locEventType"),
        F.col("time").alias("createdStamp"),
    )


def parse_legacy_checkout(lines: DataFrame) -> DataFrame:
    """Oldest checkout messages under the current names, the cart as order items."""
    other = F.from_json("value", f"Event STRUCT<{LEGACY_OTHER_TIME}>", JSON_OPTIONS)
    return _legacy(lines, CHECKOUT_EVENT).select(
        "userId",
        "orgId",
        "storeId",
        "orderId",
        F.transform(
            "cart",
            lambda i: F.struct(
                i["productId"].alias("productId"),
                i["quantity"].alias("quantity"),
                i["categoryId"].alias("categoryId"),
                i["price"].alias("unitPrice"),
            ),
        ).alias("orderItems"),
        F.coalesce("checkOutTime", other["Event"]["checkOuttime"]).alias("createdStamp"),
    )


def _legacy(lines: DataFrame, event_type: str) -> DataFrame:
    envelope = F.from_json(
        "value", f"eventType STRING, Event STRUCT<{LEGACY_FIELDS}>, {CORRUPT} STRING", JSON_OPTIONS
    )
    parsed = lines.select("value", _computed_once(envelope.alias("m"))).select("value", "m.*")
    usable = (F.col("eventType") == event_type) & F.col(CORRUPT).isNull() & F.col("Event").isNotNull()
    return parsed.filter(usable).select("value", "Event.*")


def to_current_location(rows: DataFrame) -> DataFrame:
    """String-id location rows under the current columns; ids stay text."""
    return _cast_like(rows, with_text_ids(CURRENT.location))


def _cast_like(rows: DataFrame, fields: str) -> DataFrame:
    return rows.select(*[
        F.col(f.name).try_cast(f.dataType).alias(f.name) for f in _schema(fields)
    ])


def to_current_checkout(rows: DataFrame) -> DataFrame:
    """String-id checkout rows under the current columns; ids stay text."""
    fields = with_text_ids(CURRENT.checkout)
    item = _schema(fields)["orderItems"].dataType.elementType
    items = F.transform(
        "orderItems",
        lambda i: F.struct(*[i[f.name].try_cast(f.dataType).alias(f.name) for f in item]),
    )
    return _cast_like(rows.withColumn("orderItems", items), fields)
