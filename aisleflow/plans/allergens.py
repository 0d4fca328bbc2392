"""Customer allergen profiles and notifications."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from aisleflow.functions.dates import day_of, month_of, trim_time, year_of
from aisleflow.functions.retail import allergen_list, allergy_flag
from aisleflow.model import STORE_USER
from aisleflow.operators.aggregates import union_history, user_order_count
from aisleflow.operators.joins import allergen_products, items_with_category
from aisleflow.operators import joins

PURCHASE = ["userId", "orderId", "productId", "quantity"]


def profile_users(profile: DataFrame, min_orders: int = 3) -> DataFrame:
    """Users with enough orders in one store to be profiled."""
    return user_order_count(profile).filter(F.col("OrderCount") >= min_orders)


def explode_allergens(profile: DataFrame) -> DataFrame:
    """One row per listed allergen, in place of the list."""
    return profile.withColumn("Allergen", F.explode(allergen_list("Allergens"))).drop("Allergens")


def allergen_profile(profile: DataFrame, min_orders: int = 3) -> DataFrame:
    """The allergens met by users with enough orders in any one store.

    The profile is read once. Its rows become one per store and user, with the orders
    counted and the allergens as a set, which the allergens there are bound; a window
    over the stores of a user then says whether one of them has enough orders.
    """
    met = profile.filter(F.col("userId").isNotNull()).select(
        *STORE_USER, "orderId", F.explode_outer(allergen_list("Allergens")).alias("Allergen")
    )
    per_store = met.groupBy(*STORE_USER).agg(
        F.count_distinct("orderId").alias("OrderCount"), F.collect_set("Allergen").alias("met")
    )
    most = F.max("OrderCount").over(Window.partitionBy("userId"))
    profiled = per_store.withColumn("most", most).filter(F.col("most") >= min_orders)
    return profiled.select(*STORE_USER, F.explode("met").alias("Allergen"))


def user_profile(items: DataFrame, dims: DataFrame, legacy: bool = False) -> DataFrame:
    """Purchased items of known categories with their calendar columns."""
    return items_with_category(items, dims).select(
        "userId",
        "orgId",
        "storeId",
        "orderId",
        "productId",
        "quantity",
        "unitPrice",
        "discountApplied",
        "orderItemId",
        "orderTimestamp",
        "categoryId",
        day_of("createdStamp").alias("day"),
        month_of("createdStamp", legacy).alias("month"),
        year_of("createdStamp", legacy).alias("year"),
    )


def indicated_purchases(purchases: DataFrame, indicators: DataFrame) -> DataFrame:
    """Purchases of indicator products, with how often the product is listed.

    An indicator listed several times counts each time; listings are counted
    per product first, so that every purchase is joined once.
    """
    listed = indicators.groupBy("productId").agg(F.count(F.lit(1)).alias("listings"))
    return allergen_products(purchases, listed)


def notifications_of(counts: DataFrame) -> DataFrame:
    """Notifications from counted purchases: (userId, purchasedCount) rows, several per user."""
    totals = counts.groupBy("userId").agg(F.sum("purchasedCount").alias("purchasedCount"))
    return totals.withColumn("Allergy", allergy_flag("purchasedCount"))


def allergy_notifications(current: DataFrame, indicators: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Per user, how often indicator products were bought and what that says."""
    purchases = union_history(current.select(*PURCHASE), stored).select("userId", "productId")
    bought = indicated_purchases(purchases, indicators)
    return notifications_of(bought.withColumnRenamed("listings", "purchasedCount"))


def indicator_facts(items: DataFrame, dims: DataFrame, indicators: DataFrame) -> DataFrame:
    """Counted purchases of indicator products per user and day, of known categories."""
    day = trim_time("createdStamp").alias("time")
    known = items_with_category(items, dims).select("userId", "productId", day)
    bought = indicated_purchases(known, indicators)
    return bought.groupBy("userId", "time").agg(F.sum("listings").alias("purchasedCount"))


def user_allergen_profile_input(items: DataFrame, products: DataFrame) -> DataFrame:
    """Items with their product's allergens: the rows profiles are built from."""
    rows = items.select("orgId", "storeId", "userId", "createdStamp", "productId")
    return joins.allergen_profile_input(rows, products)
