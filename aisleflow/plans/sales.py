"""Units and amounts sold per category and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from aisleflow.functions.dates import day_of, month_of, trim_time, with_calendar, year_of
from aisleflow.functions.retail import sale_amount
from aisleflow.model import CATEGORY_DAY
from aisleflow.operators.aggregates import daily_category_totals, union_history
from aisleflow.operators.joins import sums_of_known_category


def order_items(checkouts: DataFrame) -> DataFrame:
    """One row per order item, dated by its order; orders without items drop out."""
    return checkouts.select(
        "userId", "orgId", "storeId", "orderId", "createdStamp", F.explode("orderItems").alias("item")
    ).select(
        "userId",
        "orgId",
        "storeId",
        "orderId",
        "createdStamp",
        "item.productId",
        "item.quantity",
        "item.categoryId",
        "item.unitPrice",
        "item.discountApplied",
        "item.orderItemId",
        F.col("item.createdStamp").alias("orderTimestamp"),
    )


def sale_facts(items: DataFrame, dims: DataFrame, fanout: bool = False) -> DataFrame:
    """Units and amount per store, day and category, of known categories.

    Items are summed before the category check. Catalyst moves the check below
    the sums when the dimension is small enough to broadcast; when it is not,
    the check runs on the sums, which no hot category makes large.
    """
    day = trim_time("createdStamp").alias("time")
    sums = items.groupBy("orgId", "storeId", day, "categoryId").agg(
        F.sum("quantity").alias("sale"), F.sum(sale_amount("unitPrice", "quantity")).alias("saleAmount")
    )
    return sums_of_known_category(sums, dims, fanout)


def _totals(
    items: DataFrame, dims: DataFrame, history: DataFrame | None, fanout: bool, **measures: str
) -> DataFrame:
    facts = sale_facts(items, dims, fanout).select(*CATEGORY_DAY, *measures.values())
    return daily_category_totals(union_history(facts, history), **measures)


def daily_category_sale_count(
    items: DataFrame, dims: DataFrame, history: DataFrame | None = None,
    fanout: bool = False, legacy: bool = False,
) -> DataFrame:
    return with_calendar(_totals(items, dims, history, fanout, saleCountAgg="sale"), legacy)


def daily_category_sale_amount(
    items: DataFrame, dims: DataFrame, history: DataFrame | None = None,
    fanout: bool = False, legacy: bool = False,
) -> DataFrame:
    return with_calendar(_totals(items, dims, history, fanout, saleAmountAgg="saleAmount"), legacy)


def daily_category_sale_summary(
    items: DataFrame, dims: DataFrame, history: DataFrame | None = None,
    fanout: bool = False, legacy: bool = False,
) -> DataFrame:
    """Amount and count together: two sums of one grouping instead of a join of two."""
    totals = _totals(items, dims, history, fanout, saleAmountAgg="saleAmount", saleCountAgg="sale")
    complete = totals.dropna(subset=CATEGORY_DAY)
    return with_calendar(complete, legacy)


def _category_names(dims: DataFrame) -> DataFrame:
    return dims.select("categoryId", "categoryName").distinct()


def _sold(items: DataFrame, time: Column) -> DataFrame:
    """Item lines and amount per store, time and category."""
    return items.groupBy("orgId", "storeId", time.alias("time"), "categoryId").agg(
        F.count(F.lit(1)).alias("saleCount"),
        F.sum(sale_amount("unitPrice", "quantity")).alias("saleAmountAgg"),
    )


def daily_category_sale_lines(items: DataFrame, dims: DataFrame) -> DataFrame:
    """Older measure: item lines sold, with the category's name."""
    lines = _sold(items, trim_time("createdStamp")).join(_category_names(dims), "categoryId")
    return lines.select("orgId", "storeId", "time", "categoryId", "categoryName", "saleCount")


def category_sale_amount_by_second(items: DataFrame, dims: DataFrame) -> DataFrame:
    """Older grain: the order's own time, not its day."""
    amounts = _sold(items, F.col("createdStamp")).join(_category_names(dims), "categoryId")
    return amounts.select("orgId", "storeId", "time", "categoryId", "categoryName", "saleAmountAgg")


def daily_category_sales_by_name(items: DataFrame, dims: DataFrame, legacy: bool = False) -> DataFrame:
    """Older grain: calendar columns and the category's name, counting item lines."""
    sold = _sold(items, trim_time("createdStamp")).join(_category_names(dims), "categoryId")
    return sold.groupBy(
        "orgId",
        "storeId",
        day_of("time").alias("day"),
        month_of("time", legacy).alias("month"),
        year_of("time", legacy).alias("year"),
        F.col("categoryName").alias("category"),
    ).agg(F.sum("saleCount").alias("saleCount"), F.sum("saleAmountAgg").alias("saleAmountAgg"))
