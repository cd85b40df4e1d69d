"""Analytic marts. Windows run on aggregated rows only: months x categories, 168 hours of a week, or months."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from comanda.functions.calendar import year_month
from comanda.functions.money import amount, exact_mean, exact_sum, pct_change, units
from comanda.operators.cubes import DAY, by_month_and_category, peak_hours


def trends(star) -> DataFrame:
    """Revenue by month and category, with its running sum and its rank inside the month."""
    base = by_month_and_category(star).agg(
        F.countDistinct("order_id").alias("order_count"),
        F.sum("quantity").alias("units_sold"),
        exact_sum("line_total").alias("revenue"),
    )
    so_far = W.partitionBy("category_name").orderBy("year", "month").rowsBetween(W.unboundedPreceding, W.currentRow)
    in_month = W.partitionBy("year", "month").orderBy(F.desc("revenue"))
    return base.select(
        "*",
        amount(F.sum(units("revenue")).over(so_far)).alias("cumulative_revenue"),
        F.rank().over(in_month).alias("revenue_rank_in_month"),
    )


def peak_hours_ranked(star) -> DataFrame:
    busiest = W.orderBy(F.desc("order_count"))
    return peak_hours(star, items_label="avg_items").withColumn("global_rank", F.rank().over(busiest))


def busiest_hours(mart_peak_hours: DataFrame, limit: int = 10) -> DataFrame:
    """The preview report of the busiest hours, ties in calendar order."""
    return mart_peak_hours.orderBy("global_rank", "day_of_week", "hour").limit(limit)


def monthly_growth(star) -> DataFrame:
    """Completed orders by month, with the change against the month before."""
    fact = star.orders_to_count(*DAY, "status", "total", "item_count", "customer_key").filter(F.col("status") == "completed")
    monthly = (
        fact.join(star.dim_date.select(*DAY, "month_name"), DAY)
        .groupBy("year", "month", "month_name")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            exact_sum("total").alias("revenue"),
            exact_mean("total", 2).alias("avg_ticket"),
            exact_mean("item_count", 2, per_one=1).alias("avg_items_per_order"),
            F.countDistinct("customer_key").alias("unique_customers"),
        )
    )
    months = W.orderBy("year", "month")
    before = {c: F.lag(c).over(months) for c in ("order_count", "revenue")}
    return monthly.select(
        "year", "month", "month_name",
        year_month(F.col("year"), F.col("month")).alias("year_month"),
        "order_count", "revenue", "avg_ticket", "avg_items_per_order", "unique_customers",
        pct_change(F.col("order_count"), before["order_count"]).alias("order_count_pct_change"),
        pct_change(F.col("revenue"), before["revenue"]).alias("revenue_pct_change"),
        amount(F.sum(units("revenue")).over(months.rowsBetween(W.unboundedPreceding, W.currentRow)))
        .alias("cumulative_revenue"),
    )


def executive_summary(star) -> DataFrame:
    """One row of totals. ``completed_orders`` is NULL, not 0, when nothing is completed."""
    return star.orders_to_count("status", "total", "customer_key", "restaurant_key").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum(F.when(F.col("status") == "completed", 1)).alias("completed_orders"),
        exact_sum("total").alias("total_revenue"),
        exact_mean("total", 2).alias("avg_ticket"),
        F.countDistinct("customer_key").alias("unique_customers"),
        F.countDistinct("restaurant_key").alias("active_restaurants"),
    )


MARTS = {
    "mart_trends": trends,
    "mart_peak_hours": peak_hours_ranked,
    "mart_monthly_growth": monthly_growth,
}
