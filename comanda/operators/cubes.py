"""The six cubes: fixed-grain aggregates over a star schema (see ``plans.star``).

Joins with the calendar also go over year and month, the partition columns of the stored facts, so a filter on a
cube's year or month prunes partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comanda.functions.calendar import year_month
from comanda.functions.money import amount, exact_mean, exact_sum, half_up, units

DAY = ["date_key", "year", "month"]


def _with_month(fact: DataFrame, star) -> DataFrame:
    return fact.join(star.dim_date.select(*DAY, "month_name"), DAY).withColumn(
        "year_month", year_month(F.col("year"), F.col("month"))
    )


def _count_if(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def by_month_and_category(star):
    lines = star.items("order_id", *DAY, "category_key", "quantity", "line_total")
    named = _with_month(lines, star).join(star.dim_category.select("category_key", "category_name"), "category_key")
    return named.groupBy("year", "month", "month_name", "year_month", "category_name")


def revenue_month_category(star) -> DataFrame:
    return by_month_and_category(star).agg(
        F.countDistinct("order_id").alias("order_count"),
        F.sum("quantity").alias("units_sold"),
        exact_sum("line_total").alias("revenue"),
        F.round(F.avg(F.try_divide("line_total", "quantity")), 2).alias("avg_unit_price"),
    )


def orders_by_zone(star) -> DataFrame:
    place = ["zone", "zone_name", "lat", "lon"]
    fact = star.orders("location_key", *DAY, "is_delivered", "distance_km", "delivery_time_min", "total")
    return (
        fact.join(star.dim_date.select(*DAY), DAY)
        .join(star.dim_location.select("location_key", *place), "location_key")
        .groupBy(*place, "year", "month")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            _count_if(F.col("is_delivered")).alias("delivered_count"),
            exact_mean("distance_km", 2).alias("avg_distance_km"),
            exact_mean("delivery_time_min", 1, per_one=1).alias("avg_delivery_min"),
            exact_sum("total").alias("total_revenue"),
            exact_mean("total", 2).alias("avg_ticket"),
        )
    )


def order_status(star) -> DataFrame:
    fact = star.orders(*DAY, "status", "payment_method", "total")
    return (
        _with_month(fact, star)
        .groupBy("year", "month", "month_name", "year_month", "status", "payment_method")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            exact_sum("total").alias("revenue"),
            exact_mean("total", 2).alias("avg_ticket"),
        )
    )


def peak_hours(star, items_label: str = "avg_items_per_order") -> DataFrame:
    slot = ["hour", "time_label", "time_of_day", "day_of_week", "day_name", "is_weekend"]
    fact = star.orders(*DAY, "time_key", "total", "item_count")
    return (
        fact.join(star.dim_time, "time_key")
        .join(star.dim_date.select(*DAY, *slot[3:]), DAY)
        .groupBy(*slot)
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            exact_sum("total").alias("revenue"),
            exact_mean("total", 2).alias("avg_ticket"),
            exact_mean("item_count", 1, per_one=1).alias(items_label),
        )
    )


def product_ranking(star) -> DataFrame:
    lines = star.items("order_id", "product_key", "quantity", "unit_price", "line_total")
    product = star.dim_product.select(
        "product_key", "product_name", "category_name", F.col("unit_price").alias("current_price")
    )
    return (
        lines.join(product, "product_key")
        .groupBy("product_name", "category_name", "current_price")
        .agg(
            F.countDistinct("order_id").alias("orders_containing"),
            F.sum("quantity").alias("units_sold"),
            exact_sum("line_total").alias("total_revenue"),
            F.round(F.avg("unit_price"), 2).alias("avg_sold_price"),
            amount(half_up(F.sum(units("line_total")), F.sum("quantity"))).alias("revenue_per_unit"),
        )
    )


def courier_performance(star) -> DataFrame:
    fact = star.orders("courier_key", "status", "distance_km", "eta_min", "delivery_time_min", "total")
    return (
        fact.filter(F.col("courier_key") > 0)
        .join(star.dim_courier.select("courier_key", "courier_name", "vehicle", "base_zone"), "courier_key")
        .groupBy("courier_name", "vehicle", "base_zone")
        .agg(
            F.count(F.lit(1)).alias("total_assignments"),
            _count_if(F.col("status") == "completed").alias("completed"),
            _count_if(F.col("status") == "delivering").alias("in_transit"),
            exact_mean("distance_km", 2).alias("avg_distance_km"),
            exact_mean("eta_min", 1, per_one=1).alias("avg_eta_min"),
            exact_mean("delivery_time_min", 1, per_one=1).alias("avg_real_time_min"),
            # The two means cover different rows: orders still on the way have an ETA but no real time.
            F.round(F.avg("delivery_time_min") - F.avg("eta_min"), 1).alias("avg_delay_min"),
            exact_sum("total").alias("total_revenue_handled"),
        )
    )


CUBES = {
    "cube_revenue_month_category": revenue_month_category,
    "cube_orders_by_zone": orders_by_zone,
    "cube_order_status": order_status,
    "cube_peak_hours": peak_hours,
    "cube_product_ranking": product_ranking,
    "cube_courier_performance": courier_performance,
}
