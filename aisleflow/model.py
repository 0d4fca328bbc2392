"""Event schemas, table schemas and the key lists products are grouped by.

Event times carry no zone in the messages, so they are ``timestamp_ntz``: the
calendar day of an event never depends on a session or machine time zone.
Order, item and product ids are 64-bit because they grow with the data.
"""

from __future__ import annotations

import re

STORE_USER = ["orgId", "storeId", "userId"]
STORE_DAY = ["orgId", "storeId", "time"]
CATEGORY_DAY = ["orgId", "storeId", "time", "categoryId"]
CALENDAR = ["day", "month", "year"]

LOCATION_EVENT = "LocationEvent"
CHECKOUT_EVENT = "CheckOutEvent"

# Fields of one message generation, written as DDL so they read like the tables.
LOCATION_FIELDS = (
    "eventId STRING, userId STRING, orgId INT, storeId INT, rackId INT, "
    "locEventType INT, createdStamp TIMESTAMP_NTZ"
)
ITEM_FIELDS = (
    "orderItemId BIGINT, productId BIGINT, categoryId INT, quantity INT, "
    "unitPrice STRING, discountApplied DOUBLE, createdStamp TIMESTAMP_NTZ"
)
CHECKOUT_FIELDS = (
    "userId STRING, orgId INT, storeId INT, orderId BIGINT, "
    f"orderItems ARRAY<STRUCT<{ITEM_FIELDS}>>, invoiceAmount DOUBLE, "
    "invoiceQuantity INT, createdStamp TIMESTAMP_NTZ"
)

# The string-id generation: same names, every id, event type and quantity text.
STRING_LOCATION_FIELDS = (
    "eventId STRING, userId STRING, orgId STRING, storeId STRING, rackId STRING, "
    "locEventType STRING, createdStamp TIMESTAMP_NTZ"
)
STRING_ITEM_FIELDS = (
    "orderItemId STRING, productId STRING, categoryId STRING, quantity STRING, "
    "unitPrice STRING, discountApplied DOUBLE, createdStamp TIMESTAMP_NTZ"
)
STRING_CHECKOUT_FIELDS = (
    "userId STRING, orgId STRING, storeId STRING, orderId STRING, "
    f"orderItems ARRAY<STRUCT<{STRING_ITEM_FIELDS}>>, invoiceAmount DOUBLE, "
    "invoiceQuantity INT, createdStamp TIMESTAMP_NTZ"
)

# The oldest generation: envelope key "Event", a "cart" instead of order items.
LEGACY_FIELDS = (
    "userId STRING, orgId STRING, storeId STRING, rackId STRING, time TIMESTAMP_NTZ, "
    "orderId STRING, "
    "cart ARRAY<STRUCT<productId: STRING, quantity: INT, categoryId: STRING, price: STRING>>, "
    "checkOutTime TIMESTAMP_NTZ"
)
# It spells the checkout time in two ways; names differing only in case cannot
# share one struct.
LEGACY_OTHER_TIME = "checkOuttime TIMESTAMP_NTZ"

# State logs: what a batch adds, merged with what earlier batches added by the products.
# All facts share one log; its rows say by ``table`` what they are.
STATE_TABLES = {
    "facts":
        "orgId INT, storeId INT, userId STRING, categoryId INT, time TIMESTAMP_NTZ, "
        "n BIGINT, amount DOUBLE, firstTime TIMESTAMP_NTZ",
    "userIndicatorPurchases":
        "userId STRING, time TIMESTAMP_NTZ, purchasedCount BIGINT",
    "userProfile":
        "userId STRING, orgId INT, storeId INT, orderId BIGINT, productId BIGINT, quantity INT, "
        "unitPrice STRING, discountApplied DOUBLE, orderItemId BIGINT, "
        "orderTimestamp TIMESTAMP_NTZ, categoryId INT, day INT, month INT, year INT",
}

# The logs of single facts: which rows of the fact log they are, and their columns.
FACT_VIEWS = {
    "dailyCategoryFootFallTemp": ("footfall", ["orgId", "storeId", "time", "categoryId", "n AS footfall"]),
    "dailyCategorySale": ("sale", ["orgId", "storeId", "time", "categoryId", "n AS sale", "amount AS saleAmount"]),
    "converted_static": ("buyer", ["orgId", "storeId", "userId", "categoryId", "time"]),
    "userVisit": ("visit", ["orgId", "storeId", "userId", "time", "n AS visitCount"]),
    "userFirstVisit": ("visit", ["orgId", "storeId", "userId", "firstTime"]),
}

PRODUCT_TABLES = {
    "dailyCategoryFootfall":
        "orgId INT, storeId INT, day INT, month INT, year INT, time TIMESTAMP_NTZ, categoryId INT, footfallCount BIGINT",
    "dailyCategorySaleWithCountAgg":
        "orgId INT, storeId INT, day INT, month INT, year INT, time TIMESTAMP_NTZ, categoryId INT, "
        "saleAmountAgg DOUBLE, saleCountAgg BIGINT",
    "dailyVisitors":
        "orgId INT, storeId INT, day INT, month INT, year INT, time TIMESTAMP_NTZ, "
        "new_visitors BIGINT, repeated_visitors BIGINT, total BIGINT",
    "dailyVisitorsCategoryWise":
        "orgId INT, storeId INT, day INT, month INT, year INT, time TIMESTAMP_NTZ, categoryId INT, "
        "converted BIGINT, failed BIGINT, total BIGINT",
    "dailyVisit": "orgId INT, storeId INT, time TIMESTAMP_NTZ, userId STRING, VisitCount BIGINT",
    "newRepeatDaily":
        "orgId INT, storeId INT, time TIMESTAMP_NTZ, userId STRING, VisitCount BIGINT, New INT, Repeat INT",
}
MONTHLY_VISIT = "orgId INT, storeId INT, month INT, year INT, userId STRING, VisitCount BIGINT"
# All products are one table; each row has the columns of its own.
PRODUCT_COLUMNS = ", ".join(dict.fromkeys(c for fields in PRODUCT_TABLES.values() for c in fields.split(", ")))

ID_COLUMNS = ["orgId", "storeId", "rackId", "categoryId", "orderId", "productId", "orderItemId"]


def with_text_ids(fields: str) -> str:
    """Columns written as DDL, with every id but the user's and the event's as text."""
    return re.sub(rf"\b({'|'.join(ID_COLUMNS)}) (INT|BIGINT)\b", r"\1 STRING", fields)


EVENTS_TABLE = (
    "eventId STRING, orgId INT, storeId INT, userId STRING, rackId INT, "
    "locEventType INT, createdStamp TIMESTAMP_NTZ"
)
