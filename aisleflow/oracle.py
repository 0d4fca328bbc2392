"""Each query of the catalog as SQL over the same star schema tables."""

from __future__ import annotations

SECOND = "strftime(ts, '%Y-%m-%d %H:%M:%S')"
K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
PRICE = "CAST(value AS DECIMAL(18,2))"
SPLIT_EVENTS = "TIMESTAMP '2024-01-16'"
FUTURE = "(ts + to_days(CAST(event_id % 366 AS INTEGER)))"

_TABLES = f"""
racks AS (
  SELECT n_nationkey * 3 + CAST(j AS INTEGER) AS rackId
  FROM nation, (SELECT unnest(range(3)) AS j)),
category AS (
  SELECT rackId, rackId % 45 + 1 AS categoryId, 'cat' || (rackId % 45 + 1) AS categoryName FROM racks),
dims AS (SELECT rackId, categoryId, categoryName FROM racks JOIN category USING (rackId)),
known AS (SELECT DISTINCT categoryId FROM dims),
loc AS (
  SELECT CAST(event_id AS VARCHAR) AS eventId, 1 AS orgId, CAST(event_id % 3 AS INTEGER) AS storeId,
         CAST(user_id AS VARCHAR) AS userId, {K} AS rackId,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS locEventType, ts AS createdStamp
  FROM events WHERE event_type <> 'purchase'),
entries AS (SELECT * FROM loc WHERE locEventType = 0),
buy AS (
  SELECT CAST(user_id AS VARCHAR) AS userId, 1 AS orgId, CAST(event_id % 3 AS INTEGER) AS storeId,
         event_id AS orderId, ts AS createdStamp, CAST({K} AS BIGINT) AS productId, 1 AS quantity,
         {K} % 50 + 1 AS categoryId, {PRICE} AS unitPrice
  FROM events WHERE event_type = 'purchase'),
items AS (
  SELECT CAST(o_custkey AS VARCHAR) AS userId, 1 AS orgId, CAST(o_custkey % 3 AS INTEGER) AS storeId,
         l_orderkey AS orderId, o_orderdate AS createdStamp, l_partkey AS productId,
         CAST(l_quantity AS INTEGER) AS quantity, CAST(l_partkey % 50 + 1 AS INTEGER) AS categoryId,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS unitPrice, l_discount AS discountApplied,
         CAST(l_linenumber AS BIGINT) AS orderItemId, l_shipdate AS orderTimestamp
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
sold AS (SELECT * FROM items WHERE categoryId IN (SELECT categoryId FROM known)),
cart AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS userId, CAST(l_suppkey % 3 AS INTEGER) AS storeId,
         l_orderkey AS orderId, CAST(n AS BIGINT) AS orderItemId, l_partkey + n AS productId,
         CAST((l_partkey + n) % 50 + 1 AS INTEGER) AS categoryId, CAST(l_quantity AS INTEGER) AS quantity,
         l_shipdate AS createdStamp
  FROM lineitem, (SELECT unnest(range(2)) AS n) WHERE n < l_linenumber % 3),
profile AS (
  SELECT orgId, storeId, userId, orderId,
         'A' || (productId % 7) || ',A' || (productId % 11) ||
         CASE WHEN productId % 3 = 0 THEN ',,' ELSE '' END AS Allergens
  FROM items),
met AS (
  SELECT orgId, storeId, userId, orderId, unnest(string_split(rtrim(Allergens, ','), ',')) AS Allergen
  FROM profile),
indicators AS (SELECT p_partkey AS productId, p_brand AS indicator FROM part WHERE p_type = 'PROMO'),
lines AS (
  SELECT event_type, CASE WHEN event_type = 'purchase' THEN
    '{{"event":{{"orderId":' || event_id || ',"userId":"' || user_id || '","orgId":01,"storeId":' || (event_id % 3)
    || ',"orderItems":[{{"orderItemId":1,"productId":' || {K} || ',"categoryId":' || ({K} % 50 + 1)
    || ',"quantity":1,"unitPrice":' || {PRICE} || ',"discountApplied":0.0,"createdStamp":"' || {SECOND}
    || '"}}],"invoiceAmount":' || {PRICE} || ',"invoiceQuantity":1,"createdStamp":"' || {SECOND}
    || '"}},"eventType":"CheckOutEvent"}}'
  ELSE
    '{{"event":{{"eventId":' || event_id || ',"userId":"' || user_id || '","orgId":01,"storeId":' || (event_id % 3)
    || ',"rackId":' || {K} || ',"locEventType":' || CASE WHEN event_type = 'error' THEN '1' ELSE '0' END
    || ',"createdStamp":"' || {SECOND} || '"}},"eventType":"LocationEvent"}}'
  END AS value FROM events),
first_visit AS (
  SELECT orgId, storeId, userId, min(createdStamp) AS firstTime FROM loc GROUP BY ALL),
first_entry AS (
  SELECT orgId, storeId, userId, min(createdStamp) AS firstTime FROM entries GROUP BY ALL),
typed AS (
  SELECT orgId, storeId, userId, date_trunc('day', createdStamp) AS time,
         CASE WHEN date_trunc('day', createdStamp) = date_trunc('day', firstTime) THEN 'NEW' ELSE 'REPEAT' END
           AS visitType
  FROM loc JOIN first_visit USING (orgId, storeId, userId)),
typed_entries AS (
  SELECT orgId, storeId, userId, date_trunc('day', createdStamp) AS time,
         CASE WHEN date_trunc('day', createdStamp) = date_trunc('day', firstTime) THEN 'NEW' ELSE 'REPEAT' END
           AS visitType
  FROM entries JOIN first_entry USING (orgId, storeId, userId)),
visits AS (
  SELECT orgId, storeId, userId, date_trunc('day', createdStamp) AS time, count(*) AS VisitCount
  FROM loc GROUP BY ALL)
"""

DMY = "CAST(day(time) AS INTEGER) AS day, CAST(month(time) AS INTEGER) AS month, CAST(year(time) AS INTEGER) AS year"
DMY_LEGACY = (
    "CAST(day(time) AS INTEGER) AS day, CAST(month(time) - 1 AS INTEGER) AS month, "
    "CAST(year(time) - 1900 AS INTEGER) AS year"
)
DAY = "date_trunc('day', createdStamp)"
CATEGORY_KEYS = "orgId, storeId, time, categoryId"


def _footfall(rows: str, name: str = "footfallCount") -> str:
    return (
        f"SELECT orgId, storeId, {DAY} AS time, categoryId, count(*) AS {name} "
        f"FROM {rows} JOIN dims USING (rackId) GROUP BY ALL"
    )


def _calendar(inner: str, measures: str, parts: str = DMY) -> str:
    keys = "orgId, storeId, time" + (", categoryId" if "categoryId" in inner else "")
    return f"SELECT {keys}, {parts}, {measures} FROM ({inner})"


def _sales(rows: str, measures: str) -> str:
    return f"SELECT orgId, storeId, {DAY} AS time, categoryId, {measures} FROM {rows} GROUP BY ALL"


AMOUNT = "round(sum(CAST(unitPrice AS DOUBLE) * quantity), 2) AS saleAmountAgg"
UNITS = "CAST(sum(quantity) AS BIGINT) AS saleCountAgg"
KNOWN_BUY = "(SELECT * FROM buy WHERE categoryId IN (SELECT categoryId FROM known))"


def _category_wise(rows: str) -> str:
    return f"""
SELECT orgId, storeId, time, categoryId, {DMY}, converted, total - converted AS failed, total FROM (
  SELECT orgId, storeId, time, categoryId, coalesce(converted, 0) AS converted, coalesce(total, 0) AS total
  FROM ({_footfall(rows, 'total')})
  FULL JOIN (SELECT orgId, storeId, {DAY} AS time, categoryId, count(DISTINCT userId) AS converted
             FROM {KNOWN_BUY} GROUP BY ALL)
  USING (orgId, storeId, time, categoryId))"""


def _visitors(typed: str) -> str:
    return f"""
SELECT orgId, storeId, time, {DMY}, new_visitors, repeated_visitors, new_visitors + repeated_visitors AS total
FROM (SELECT orgId, storeId, time,
             count(DISTINCT CASE WHEN visitType = 'NEW' THEN userId END) AS new_visitors,
             count(DISTINCT CASE WHEN visitType = 'REPEAT' THEN userId END) AS repeated_visitors
      FROM {typed} GROUP BY ALL)"""


NEW_REPEAT = """
SELECT orgId, storeId, time,
       count(DISTINCT CASE WHEN visitType = 'NEW' THEN userId END) AS new_visitors,
       count(DISTINCT CASE WHEN visitType = 'REPEAT' THEN userId END) AS repeated_visitors
FROM typed GROUP BY ALL"""

DAILY_VISIT = "SELECT orgId, storeId, time, userId, VisitCount FROM visits"
FLAGS = (
    "SELECT orgId, storeId, time, userId, VisitCount, CASE WHEN VisitCount = 1 THEN 1 ELSE 0 END AS New, "
    "CASE WHEN VisitCount = 1 THEN 0 ELSE 1 END AS Repeat FROM visits"
)
FLAG_TOTALS = (
    "SELECT orgId, storeId, time, CAST(sum(New) AS BIGINT) AS new_visitors, "
    f"CAST(sum(Repeat) AS BIGINT) AS repeated_visitors FROM ({FLAGS}) GROUP BY ALL"
)


ORDER_VISITS = (
    "(SELECT 1 AS orgId, CAST(o_custkey % 3 AS INTEGER) AS storeId, o_orderdate AS time, "
    "CAST(o_custkey AS VARCHAR) AS userId, 1 AS VisitCount FROM orders)"
)


def _grain(parts: list[str], legacy: bool = False, visits: str = "visits") -> str:
    minus = {"day": "", "month": " - 1" if legacy else "", "year": " - 1900" if legacy else ""}
    columns = ", ".join(f"CAST({p}(time){minus[p]} AS INTEGER) AS {p}" for p in parts)
    return (
        f"SELECT orgId, storeId, {columns}, userId, CAST(sum(VisitCount) AS BIGINT) AS VisitCount "
        f"FROM {visits} GROUP BY ALL"
    )


INDICATED = "(SELECT userId, orderId, productId, quantity, indicator FROM items JOIN indicators USING (productId))"
PER_ORDER = f'SELECT userId, orderId, count(*) AS "count" FROM {INDICATED} GROUP BY ALL'


def _allergy(count: str) -> str:
    return f"CASE WHEN {count} > 1 THEN 'allergy detected' ELSE 'no allergy detected uptil now' END AS Allergy"


def _profile(min_orders: int) -> str:
    return f"""
SELECT DISTINCT orgId, storeId, userId, Allergen FROM met WHERE userId IN (
  SELECT userId FROM profile GROUP BY orgId, storeId, userId HAVING count(DISTINCT orderId) >= {min_orders})"""


def _visit_type(visit: str, first: str, part: str) -> str:
    return f"CASE WHEN {part.format(visit)} = {part.format(first)} THEN 'NEW' ELSE 'REPEAT' END"


FLAT_LOCATION_SECONDS = (
    "SELECT eventId, orgId, storeId, userId, rackId, locEventType, "
    "date_trunc('second', createdStamp) AS createdStamp FROM loc"
)

GOOD = (
    "'{\"eventType\":\"LocationEvent\",\"event\":{\"eventId\":' || event_id || ',\"userId\":\"u\",\"orgId\":1,"
    f"\"storeId\":1,\"rackId\":2,\"locEventType\":0,\"createdStamp\":\"' || {SECOND} || '\"}}}}'"
)

_SELECTS = {
    # sources, sinks, streams
    "read_event_stream": "SELECT value FROM lines",
    "micro_batch": "SELECT CASE WHEN event_type = 'purchase' THEN 'CheckOutEvent' ELSE 'LocationEvent' END "
                   "AS eventType, count(*) AS lines FROM lines GROUP BY ALL",
    "raw_messages": "SELECT value AS msg FROM lines",
    "stream_dead_letters": "SELECT CASE event_id % 8 WHEN 2 THEN 'no payload' WHEN 4 THEN 'no event type' "
                           "WHEN 6 THEN 'missing field' ELSE 'unreadable' END AS problem, count(*) AS lines "
                           "FROM events WHERE event_id % 8 BETWEEN 1 AND 6 GROUP BY ALL",
    "stream_string_ids": "SELECT CASE WHEN CAST(eventId AS BIGINT) % 2 = 0 THEN '1' ELSE 'org1' END AS orgId, "
                         f"storeId::VARCHAR AS storeId, {DAY} AS time, "
                         "CAST(day(createdStamp) AS INTEGER) AS day, CAST(month(createdStamp) AS INTEGER) AS month, "
                         "CAST(year(createdStamp) AS INTEGER) AS year, categoryId::VARCHAR AS categoryId, "
                         "count(*) AS footfallCount FROM loc JOIN dims USING (rackId) GROUP BY ALL",
    "stream_compacted_replay": f"SELECT orgId, storeId, {DAY} AS time, userId, count(*) AS VisitCount "
                               "FROM entries GROUP BY ALL",
    "stream_new_repeat_daily": "SELECT *, CASE WHEN VisitCount = 1 THEN 1 ELSE 0 END AS New, "
                               "CASE WHEN VisitCount = 1 THEN 0 ELSE 1 END AS Repeat FROM "
                               f"(SELECT orgId, storeId, {DAY} AS time, userId, count(*) AS VisitCount "
                               "FROM entries GROUP BY ALL)",
    **{
        f"stream_monthly_{name}_visitors": "SELECT * FROM (SELECT orgId, storeId, CAST(month(createdStamp) AS INTEGER) AS month, "
                                           "CAST(year(createdStamp) AS INTEGER) AS year, userId, count(*) AS VisitCount "
                                           f"FROM entries GROUP BY ALL) WHERE VisitCount {test}"
        for name, test in (("repeat", "> 1"), ("new", "= 1"))
    },
    "stream_legacy": f"SELECT 'org1' AS orgId, 's' || storeId AS storeId, {DAY} AS time, 'u' || userId AS userId, "
                     "count(*) AS VisitCount FROM loc GROUP BY ALL",
    "stream_mixed_generations": f"SELECT 'visits' AS product, orgId, storeId, {DAY} AS time, userId AS key, count(*) AS n FROM ("
                                "SELECT orgId::VARCHAR AS orgId, storeId::VARCHAR AS storeId, userId, createdStamp FROM entries "
                                "UNION ALL SELECT CASE WHEN CAST(eventId AS BIGINT) % 2 = 0 THEN '1' ELSE 'org1' END, "
                                "storeId::VARCHAR, 'u' || userId, createdStamp FROM loc "
                                "UNION ALL SELECT 'org1', 's' || storeId, 'u' || userId, createdStamp FROM loc) GROUP BY ALL "
                                f"UNION ALL SELECT 'units', orgId::VARCHAR, storeId::VARCHAR, {DAY}, categoryId::VARCHAR, "
                                f"CAST(sum(quantity) AS BIGINT) FROM {KNOWN_BUY} GROUP BY ALL",
    "stream_footfall_30s": "SELECT * FROM (SELECT rackId, time_bucket(INTERVAL 30 SECOND, createdStamp) AS bucket, "
                           "count(*) AS footfall FROM loc GROUP BY rackId, bucket) WHERE bucket + INTERVAL 90 SECOND "
                           "<= (SELECT date_trunc('second', max(createdStamp)) FROM loc)",
    "stream_distinct_visitors": f"SELECT orgId, storeId, {DAY} AS time, count(DISTINCT userId) AS visitors FROM loc GROUP BY ALL",
    "stream_chained": f"SELECT orgId, storeId, {DAY} AS time, userId, count(*) AS VisitCount FROM entries GROUP BY ALL",
    "for_each_batch": f"SELECT orgId, storeId, {DAY} AS time, userId, count(*) AS VisitCount FROM entries GROUP BY ALL",
    "stream_daily_category_footfall": _calendar(_footfall("entries"), "footfallCount"),
    "stream_daily_category_sale_summary": _calendar(
        _sales(KNOWN_BUY, f"{AMOUNT}, {UNITS}"), "saleAmountAgg, saleCountAgg"
    ),
    "stream_daily_visitors": _visitors("typed_entries"),
    "stream_daily_visitors_category_wise": _category_wise("entries"),
    "stream_user_profile": "SELECT userId, orderId, productId, quantity, categoryId, "
                           f"date_trunc('second', createdStamp) AS orderTimestamp FROM {KNOWN_BUY}",
    "stream_allergy_notifications": f"SELECT userId, count(*) AS purchasedCount, {_allergy('count(*)')} "
                                    f"FROM {KNOWN_BUY} WHERE productId IN (SELECT rackId FROM racks WHERE rackId % 3 = 0) "
                                    "GROUP BY userId",
    "read_table": "SELECT * FROM loc",
    "append_table": _footfall("loc"),
    "overwrite_table": f"{DAILY_VISIT} WHERE time < {SPLIT_EVENTS} UNION ALL "
                       f"SELECT orgId, storeId, {DAY} AS time, userId, count(*) AS VisitCount FROM entries "
                       f"WHERE createdStamp >= {SPLIT_EVENTS} GROUP BY ALL",
    "load_dimensions": "SELECT * FROM dims",
    # parsing and routing
    "event_type": "SELECT value, CASE WHEN event_type = 'purchase' THEN 'CheckOutEvent' ELSE 'LocationEvent' END "
                  "AS eventType FROM lines",
    "route_location": "SELECT value FROM lines WHERE event_type <> 'purchase'",
    "route_checkout": "SELECT value FROM lines WHERE event_type = 'purchase'",
    "parse_location_events": FLAT_LOCATION_SECONDS,
    "parse_checkout_events": "SELECT userId, orgId, storeId, orderId, CAST(unitPrice AS DOUBLE) AS invoiceAmount, "
                             "1 AS invoiceQuantity, date_trunc('second', createdStamp) AS createdStamp, 1 AS items, "
                             "productId, quantity, categoryId, CAST(unitPrice AS DOUBLE) AS unitPrice FROM buy",
    "parse_string_id_events": "SELECT eventId, 'u' || userId AS userId, "
                              "CASE WHEN CAST(eventId AS BIGINT) % 2 = 0 THEN '1' ELSE 'org1' END AS orgId, "
                              "storeId::VARCHAR AS storeId, rackId::VARCHAR AS rackId, 0 AS locEventType, date_trunc('second', createdStamp) AS createdStamp FROM loc",
    "parse_string_id_checkouts": "SELECT 'u' || userId AS userId, CASE WHEN orderId % 2 = 0 THEN '1' ELSE 'org1' END AS orgId, "
                                 "storeId::VARCHAR AS storeId, orderId::VARCHAR AS orderId, CAST(NULL AS DOUBLE) AS invoiceAmount, "
                                 "CAST(NULL AS INTEGER) AS invoiceQuantity, "
                                 "date_trunc('second', createdStamp) AS createdStamp, 1 AS items, "
                                 "productId::VARCHAR AS productId, 2 AS quantity, 'c' || productId AS categoryId, "
                                 "CAST(unitPrice AS DOUBLE) AS unitPrice FROM buy",
    "parse_legacy_events": "SELECT CAST(NULL AS VARCHAR) AS eventId, 'u' || userId AS userId, 'org1' AS orgId, "
                           "'s' || storeId AS storeId, 'r' || rackId AS rackId, '0' AS locEventType, "
                           "date_trunc('second', createdStamp) AS createdStamp FROM loc",
    "parse_legacy_checkouts": "SELECT 'u' || userId AS userId, 'org1' AS orgId, 's' || storeId AS storeId, "
                              "'o' || orderId AS orderId, date_trunc('second', createdStamp) AS createdStamp, "
                              "1 AS items, 'p' || productId AS productId, 2 AS quantity, 'c1' AS categoryId, "
                              "CAST(unitPrice AS DOUBLE) AS unitPrice FROM buy",
    "dead_letter": f"""
SELECT CASE event_id % 8
         WHEN 1 THEN 'note ' || event_id
         WHEN 2 THEN replace(good, '"event":', '"Event":')
         WHEN 3 THEN replace(good, '"rackId":2', '"rackId":"r2"')
         WHEN 4 THEN replace(good, '"eventType":"LocationEvent",', '')
         WHEN 5 THEN replace(good, '"createdStamp":"20', '"createdStamp":"day ')
         ELSE replace(good, '"userId":"u",', '') END AS value,
       CASE event_id % 8 WHEN 2 THEN 'no payload' WHEN 4 THEN 'no event type' WHEN 6 THEN 'missing field'
         ELSE 'unreadable' END AS problem
FROM (SELECT event_id, {GOOD} AS good FROM events) WHERE event_id % 8 BETWEEN 1 AND 6""",
    # projections
    "select_columns": "SELECT userId, orgId, createdStamp FROM loc",
    "struct_field_access": "SELECT orderId, productId, quantity FROM cart",
    "rename_column": "SELECT orderId, createdStamp, productId, createdStamp AS orderTimestamp FROM cart",
    "constant_column": "SELECT eventId, 1 AS footfall FROM loc",
    "derived_column": "SELECT orderId, productId, round(CAST(unitPrice AS DOUBLE) * quantity, 2) AS saleAmount FROM items",
    "drop_columns": "SELECT eventId, orgId, storeId, userId, locEventType, createdStamp, categoryId "
                    "FROM loc JOIN dims USING (rackId)",
    "drop_side_column": "SELECT * FROM dims",
    # filters
    "filter_entry_events": "SELECT * FROM entries",
    "filter_visit_type": "SELECT orgId, storeId, userId, time, visitType, count(*) AS visits FROM typed "
                         "WHERE visitType = 'REPEAT' GROUP BY ALL",
    "filter_min_orders": "SELECT orgId, storeId, userId, count(DISTINCT orderId) AS OrderCount FROM profile "
                         "GROUP BY ALL HAVING count(DISTINCT orderId) >= 10",
    "filter_repeat_by_count": f"{DAILY_VISIT} WHERE VisitCount > 1",
    "filter_new_by_count": f"{DAILY_VISIT} WHERE VisitCount = 1",
    "null_guard": "SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN 19 END AS length FROM events",
    # joins
    "rack_category_dim": "SELECT * FROM dims",
    "location_with_category": "SELECT * FROM loc JOIN dims USING (rackId)",
    "items_with_category": "SELECT userId, storeId, orderId, productId, categoryId, quantity, createdStamp FROM sold",
    "items_with_category_fanout": "SELECT userId, storeId, orderId, productId, categoryId, quantity, createdStamp "
                                  "FROM items JOIN dims USING (categoryId)",
    "sale_count_with_amount": _calendar(_sales("sold", f"{AMOUNT}, {UNITS}"), "saleAmountAgg, saleCountAgg"),
    "visits_with_first_visit": "SELECT orgId, storeId, userId, createdStamp AS time, firstTime "
                               "FROM loc JOIN first_visit USING (orgId, storeId, userId)",
    "new_repeat_outer": NEW_REPEAT,
    "total_converted_outer": f"SELECT orgId, storeId, time, categoryId, converted, total FROM ({_category_wise('loc')})",
    "store_conversion_join": "",
    "profiled_users": "SELECT orgId, storeId, userId, Allergens FROM profile WHERE userId IN (SELECT userId FROM profile "
                      "GROUP BY orgId, storeId, userId HAVING count(DISTINCT orderId) >= 10)",
    "allergen_products": f"SELECT * FROM {INDICATED}",
    "allergen_profile_input": "SELECT orgId, storeId, userId, createdStamp, productId, p_brand || ',' || p_type AS Allergens "
                              "FROM items JOIN part ON productId = p_partkey WHERE storeId <> p_partkey % 3",
    "minor_to_rack": "SELECT eventId, CAST(loc.rackId + 20000 AS VARCHAR) AS minorId, racks.rackId AS rackId "
                     "FROM loc LEFT JOIN racks ON loc.rackId = racks.rackId",
    "minor_unknown": "SELECT eventId, CAST(rackId + 20000 AS VARCHAR) AS minorId FROM loc "
                     "WHERE rackId NOT IN (SELECT rackId FROM racks)",
    "product_code_lookup": "SELECT l_orderkey AS orderId, 'P-' || l_partkey AS productCode, "
                           "CAST(l_quantity AS INTEGER) AS quantity, p_partkey AS productId, "
                           "CAST(p_partkey % 75 AS INTEGER) AS rackId, CAST(p_partkey % 50 + 1 AS INTEGER) AS categoryId, "
                           "p_retailprice AS unitPrice FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_partkey % 2 = 0) ON l_partkey = p_partkey",
    # aggregates
    "user_first_visit": "SELECT * FROM first_visit",
    "user_first_visit_entries": "SELECT * FROM first_entry",
    "user_first_visit_incremental": "SELECT * FROM first_visit",
    "daily_category_sale_lines": f"SELECT orgId, storeId, {DAY} AS time, categoryId, 'cat' || categoryId AS categoryName, "
                                 "count(*) AS saleCount FROM sold GROUP BY ALL",
    "converted_users": f"SELECT orgId, storeId, {DAY} AS time, categoryId, count(DISTINCT userId) AS converted "
                       f"FROM {KNOWN_BUY} GROUP BY ALL",
    "store_daily_visitors": f"SELECT orgId, storeId, {DAY} AS time, count(DISTINCT userId) AS total FROM loc GROUP BY ALL",
    "store_daily_converted": f"SELECT orgId, storeId, {DAY} AS time, count(DISTINCT userId) AS converted "
                             f"FROM {KNOWN_BUY} GROUP BY ALL",
    "user_order_count": "SELECT orgId, storeId, userId, count(DISTINCT orderId) AS OrderCount FROM profile GROUP BY ALL",
    "daily_visits_per_user": _grain(["day", "month", "year"]),
    "monthly_visits_per_user": _grain(["month", "year"]),
    "yearly_visits_per_user": _grain(["year"]),
    "yearly_visits_per_user_legacy": _grain(["month", "year"], legacy=True),
    "new_repeat_flags_daily": FLAG_TOTALS,
    "indicator_purchases": PER_ORDER,
    "indicator_total": f'SELECT userId, CAST(sum("count") AS BIGINT) AS purchasedCount FROM ({PER_ORDER}) GROUP BY ALL',
    "visit_type_pivot": "SELECT orgId, storeId, time, count(*) FILTER (visitType = 'REPEAT') AS repeated_visitors, "
                        "count(*) FILTER (visitType = 'NEW') AS new_visitors FROM typed GROUP BY ALL",
    "group_rows_by_user": f"SELECT DISTINCT userId, {_allergy(chr(34) + 'count' + chr(34))} FROM ({PER_ORDER})",
    "daily_product_count": "SELECT CAST(createdStamp AS DATE) AS day, productId, CAST(sum(quantity) AS BIGINT) AS quantity "
                           "FROM items GROUP BY ALL",
    "distinct_rows": "SELECT DISTINCT orgId, storeId, userId, Allergen FROM met",
    # set operations
    "union_history": f"SELECT orgId, storeId, userId, {DAY} AS time FROM loc",
    "union_profile": "SELECT userId, orderId, productId, quantity FROM items "
                     "UNION ALL SELECT userId, orderId, productId, quantity FROM buy",
    # scalar functions
    "day_of": "SELECT event_id, CAST(day(ts) AS INTEGER) AS day FROM events",
    "month_of": f"SELECT event_id, CAST(month({FUTURE}) AS INTEGER) AS month, "
                f"CAST(month({FUTURE}) - 1 AS INTEGER) AS legacy FROM events",
    "year_of": f"SELECT event_id, CAST(year({FUTURE}) AS INTEGER) AS year, "
               f"CAST(year({FUTURE}) - 1900 AS INTEGER) AS legacy FROM events",
    "quarter_of": f"SELECT event_id, CAST(quarter({FUTURE}) AS INTEGER) AS quarter, "
                  f"CASE WHEN month({FUTURE}) IN (4, 7, 10, 11, 12) THEN 4 "
                  f"ELSE CAST(quarter({FUTURE}) AS INTEGER) END AS legacy FROM events",
    "week_of_month": f"SELECT event_id, CAST((day({FUTURE}) + dayofweek(date_trunc('month', {FUTURE})) - 1) // 7 + 1 "
                     "AS INTEGER) AS week FROM events",
    "trim_time": "SELECT event_id, date_trunc('day', ts) AS time, "
                 "date_trunc('day', ts) + (ts - date_trunc('second', ts)) AS legacy FROM events",
    "time_delta_ms": "SELECT event_id, (epoch_us(ts) + event_id % 1999) // 1000 - epoch_us(TIMESTAMP '2024-01-01') // 1000 AS delta FROM events",
    "add_24h": "SELECT event_id, ts + INTERVAL 24 HOUR AS next FROM events",
    "new_flag": "SELECT event_id, CASE WHEN event_id % 4 = 2 THEN 1 ELSE 0 END AS flag FROM events",
    "repeat_flag": "SELECT event_id, CASE WHEN event_id % 4 = 2 THEN 0 ELSE 1 END AS flag FROM events",
    "allergy_flag": "SELECT event_id, CASE WHEN event_id % 4 > 2 THEN 'allergy detected' "
                    "ELSE 'no allergy detected uptil now' END AS flag FROM events",
    "cast_int": "SELECT event_id, CAST(floor(value) AS INTEGER) AS amount FROM events",
    "visit_type": f"SELECT event_id, {_visit_type(FUTURE, 'ts', 'CAST({} AS DATE)')} AS visitType, "
                     f"{_visit_type(FUTURE, 'ts', 'day({})')} AS legacy FROM events",
    "sale_amount": "SELECT orderId, productId, quantity, CASE WHEN productId % 10 <> 0 THEN "
                   "round(CAST(unitPrice AS DOUBLE) * quantity, 2) END AS saleAmount FROM items",
    "date_as_int": "SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN CAST(strftime(ts, '%Y%m%d') AS INTEGER) END AS day "
                   "FROM events",
    "explode_items": "SELECT userId, storeId, orderId, orderItemId, productId, categoryId, quantity FROM cart",
    "explode_allergens": "SELECT userId, orderId, Allergen FROM met",
    "fill_zero": f"SELECT time, storeId, new_visitors, repeated_visitors FROM ({NEW_REPEAT})",
    "arithmetic": "SELECT time, storeId, new_visitors + repeated_visitors AS total, "
                  f"repeated_visitors - new_visitors AS difference FROM ({NEW_REPEAT})",
    # products
    "daily_category_footfall": _calendar(_footfall("loc"), "footfallCount"),
    "daily_category_footfall_legacy": _calendar(_footfall("loc"), "footfallCount", DMY_LEGACY),
    "daily_category_sale_count": _calendar(_sales(KNOWN_BUY, UNITS), "saleCountAgg"),
    "daily_category_sale_amount": _calendar(_sales(KNOWN_BUY, AMOUNT), "saleAmountAgg"),
    "daily_category_sale_summary": _calendar(_sales("sold", f"{AMOUNT}, {UNITS}"), "saleAmountAgg, saleCountAgg"),
    "daily_category_sale_summary_history": _calendar(
        _sales(KNOWN_BUY, f"{AMOUNT}, {UNITS}"), "saleAmountAgg, saleCountAgg"
    ),
    "daily_category_sale_summary_fanout": _calendar(
        _sales("(SELECT items.* FROM items JOIN dims USING (categoryId))", f"{AMOUNT}, {UNITS}"),
        "saleAmountAgg, saleCountAgg",
    ),
    "user_visit_type": "SELECT * FROM typed",
    "user_visit_type_legacy": "SELECT orgId, storeId, userId, date_trunc('day', createdStamp) AS time, "
                              + _visit_type("createdStamp", "(firstTime - INTERVAL 31 DAY)", "day({})")
                              + " AS visitType FROM loc JOIN first_visit USING (orgId, storeId, userId)",
    "daily_visitors": _visitors("typed_entries"),
    "daily_visitors_all_events": _visitors("typed"),
    "daily_visitors_category_wise": _category_wise("loc"),
    "store_conversion": f"""
SELECT orgId, storeId, time, total, converted, total - converted AS failed
FROM (SELECT orgId, storeId, {DAY} AS time, count(DISTINCT userId) AS total FROM loc GROUP BY ALL)
JOIN (SELECT orgId, storeId, {DAY} AS time, count(DISTINCT userId) AS converted FROM {KNOWN_BUY} GROUP BY ALL)
USING (orgId, storeId, time)""",
    "daily_visit": DAILY_VISIT,
    "new_repeat_daily": FLAGS,
    "daily_visitors_by_count": f"SELECT *, {DMY}, new_visitors + repeated_visitors AS total FROM ({FLAG_TOTALS})",
    "daily_new_visitors": f"SELECT * FROM ({_grain(['day', 'month', 'year'])}) WHERE VisitCount = 1",
    "daily_repeat_visitors": f"SELECT * FROM ({_grain(['day', 'month', 'year'])}) WHERE VisitCount > 1",
    "monthly_new_visitors": f"SELECT * FROM ({_grain(['month', 'year'], visits=ORDER_VISITS)}) WHERE VisitCount = 1",
    "monthly_repeat_visitors": f"SELECT * FROM ({_grain(['month', 'year'])}) WHERE VisitCount > 1",
    "yearly_new_visitors": f"SELECT * FROM ({_grain(['year'], visits=ORDER_VISITS)}) WHERE VisitCount = 1",
    "yearly_repeat_visitors": f"SELECT * FROM ({_grain(['year'])}) WHERE VisitCount > 1",
    "user_profile": "SELECT userId, orgId, storeId, orderId, productId, quantity, unitPrice, discountApplied, orderItemId, "
                    "orderTimestamp, categoryId, CAST(day(createdStamp) AS INTEGER) AS day, "
                    "CAST(month(createdStamp) AS INTEGER) AS month, CAST(year(createdStamp) AS INTEGER) AS year FROM sold",
    "allergy_notifications": f"SELECT userId, count(*) AS purchasedCount, {_allergy('count(*)')} "
                             "FROM (SELECT userId, productId FROM items UNION ALL SELECT userId, productId FROM buy) "
                             "JOIN indicators USING (productId) GROUP BY userId",
    "allergen_profile": _profile(3),
    "allergen_profile_min_orders": _profile(10),
    "footfall_30s": "SELECT userId, rackId, createdStamp AS ts, time_bucket(INTERVAL 30 SECOND, createdStamp) AS bucket "
                    "FROM loc",
    "daily_category_footfall_by_name": "SELECT orgId, storeId, CAST(day(createdStamp) AS INTEGER) AS day, "
                                       "CAST(month(createdStamp) AS INTEGER) AS month, "
                                       "CAST(year(createdStamp) AS INTEGER) AS year, categoryName AS category, "
                                       "count(*) AS FootFallCount FROM loc JOIN dims USING (rackId) GROUP BY ALL",
    "category_footfall_by_second": "SELECT orgId, storeId, createdStamp AS time, categoryId, categoryName, "
                                   "count(*) AS FootFallCount FROM loc JOIN dims USING (rackId) GROUP BY ALL",
    "category_sale_amount_by_second": "SELECT orgId, storeId, createdStamp AS time, categoryId, 'cat' || categoryId "
                                      f"AS categoryName, {AMOUNT} FROM sold GROUP BY ALL",
    "daily_category_sales_by_name": "SELECT orgId, storeId, CAST(day(createdStamp) AS INTEGER) AS day, "
                                    "CAST(month(createdStamp) AS INTEGER) AS month, "
                                    "CAST(year(createdStamp) AS INTEGER) AS year, 'cat' || categoryId AS category, "
                                    f"count(*) AS saleCount, {AMOUNT} FROM sold GROUP BY ALL",
}
_SELECTS["store_conversion_join"] = _SELECTS["store_conversion"]
_SELECTS["user_allergen_profile_input"] = _SELECTS["allergen_profile_input"]

ORACLE_SQL = {name: f"WITH {_TABLES}\n{select}" for name, select in _SELECTS.items()}
