"""The two fact tables.

A caller names the columns it needs, and only the lookups behind them are joined. All lookups are on unique
keys, so leaving out a left join, or replacing an inner join by a semi join, never changes the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.functions.calendar import date_key, minutes_between
from comanda.operators import dims as D
from comanda.operators.keys import ordered_key
from comanda.sources.operational import Tables

FACT_ORDERS = (
    "order_key", "order_id", "date_key", "time_key", "customer_key", "restaurant_key", "location_key",
    "courier_key", "status", "payment_method", "total", "item_count", "distance_km", "eta_min",
    "delivery_time_min", "is_delivered", "year", "month",
)
FACT_ORDER_ITEMS = (
    "item_key", "order_id", "date_key", "time_key", "product_key", "category_key", "restaurant_key",
    "customer_key", "quantity", "unit_price", "line_total", "year", "month",
)
FROM_DELIVERY = {"location_key", "courier_key", "distance_km", "eta_min", "delivery_time_min"}


def items_per_order(order_items: DataFrame) -> DataFrame:
    """Lines of each order, counted before any join."""
    return order_items.groupBy("order_id").agg(F.count(F.lit(1)).alias("item_count"))


def _check(columns: Sequence[str], known: Sequence[str]) -> set[str]:
    unknown = set(columns) - set(known)
    if unknown:
        raise ValueError(f"unknown fact columns: {sorted(unknown)}")
    return set(columns)


def _own_key(members: DataFrame, natural: str, surrogate: str) -> DataFrame:
    return members.select(F.col("id").alias(natural), F.col("id").alias(surrogate))


def fact_orders(t: Tables, dims, columns: Sequence[str] = FACT_ORDERS, natural_keys: bool = False) -> DataFrame:
    """One row per order. ``dims`` offers the keyed dimensions customer, restaurant, location and courier.

    With ``natural_keys`` the customer's and restaurant's keys are their ids: enough for counting, and no surrogates are
    made for it.
    """
    want = _check(columns, FACT_ORDERS)
    ts = F.col("order_ts")
    fact = t.orders.withColumnRenamed("id", "order_id")

    # Lookups by order id come first, as they can share one shuffle of the orders.
    if "item_count" in want:
        fact = fact.join(items_per_order(t.order_items), "order_id", "left")
    if want & FROM_DELIVERY:
        delivery = t.deliveries.select("order_id", "courier_id", "dest_zone", "distance_km", "eta_min", "delivered_ts")
        fact = fact.join(delivery, "order_id", "left")
    if "customer_key" in want:
        customer = _own_key(D.customers(t.users), "user_id", "customer_key") if natural_keys else dims.customer
        fact = fact.join(customer.select("user_id", "customer_key"), "user_id", "left")
    if "restaurant_key" in want:
        restaurant = _own_key(t.restaurants, "restaurant_id", "restaurant_key") if natural_keys else dims.restaurant
        fact = fact.join(restaurant.select("restaurant_id", "restaurant_key"), "restaurant_id", "left")
    if "location_key" in want:
        zones = dims.location.select(F.col("zone").alias("dest_zone"), "location_key")
        fact = fact.join(zones, "dest_zone", "left")
    if "courier_key" in want:
        fact = fact.join(dims.courier.select("courier_id", "courier_key"), "courier_id", "left")
    values = {
        "order_key": F.col("order_id").cast("bigint"),
        "date_key": date_key(ts),
        "time_key": F.hour(ts),
        "total": F.col("total").cast("double"),
        "is_delivered": F.col("status").isin("completed", "delivering"),
        "year": F.year(ts),
        "month": F.month(ts),
    }
    if "location_key" in want:
        values["location_key"] = F.coalesce("location_key", F.lit(D.UNKNOWN_KEY))
    if "courier_key" in want:
        values["courier_key"] = F.coalesce("courier_key", F.lit(D.UNKNOWN_KEY).cast("bigint"))
    if "item_count" in want:
        values["item_count"] = F.coalesce("item_count", F.lit(0).cast("bigint"))
    if want & FROM_DELIVERY:
        values["distance_km"] = F.col("distance_km").cast("double")
        values["eta_min"] = F.col("eta_min").cast("int")
        values["delivery_time_min"] = minutes_between(ts, F.col("delivered_ts"))
    return fact.select(*[values.get(c, F.col(c)).alias(c) for c in columns])


def fact_order_items(t: Tables, dims, columns: Sequence[str] = FACT_ORDER_ITEMS) -> DataFrame:
    """One row per line of a customer's order at a known restaurant, with a known product and category."""
    want = _check(columns, FACT_ORDER_ITEMS)
    ts = F.col("order_ts")

    # The filters on orders come first: they shrink the side that the lines are joined with.
    orders = t.orders.select(F.col("id").alias("order_id"), "order_ts", "user_id", "restaurant_id")
    if "customer_key" in want:
        orders = orders.join(dims.customer.select("user_id", "customer_key"), "user_id")
    else:
        buyers = D.customers(t.users).select(F.col("id").alias("user_id"))
        orders = orders.join(buyers, "user_id", "left_semi")
    if "restaurant_key" in want:
        orders = orders.join(dims.restaurant.select("restaurant_id", "restaurant_key"), "restaurant_id")
    else:
        sellers = t.restaurants.select(F.col("id").alias("restaurant_id"))
        orders = orders.join(sellers, "restaurant_id", "left_semi")

    if "product_key" in want:
        product = dims.product.select("product_id", "product_key", "category_key")
    else:
        product = D.dim_product(t.products, dims.category, keyed=False).select("product_id", "category_key")

    lines = t.order_items.join(orders, "order_id").join(product, "product_id")
    if "item_key" in want:
        lines = ordered_key(lines, list(t.line_order), "item_key")
    values = {
        "date_key": date_key(ts),
        "time_key": F.hour(ts),
        "quantity": F.col("quantity").cast("int"),
        "unit_price": F.col("unit_price").cast("double"),
        "line_total": F.col("line_total").cast("double"),
        "year": F.year(ts),
        "month": F.month(ts),
    }
    return lines.select(*[values.get(c, F.col(c)).alias(c) for c in columns])
