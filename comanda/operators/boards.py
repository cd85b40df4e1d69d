"""Dashboard charts: aggregates over the cubes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from comanda.functions.money import amount, half_up, units


@dataclass(frozen=True)
class Metric:
    """SUM or AVG of a column whose values are multiples of 1/``per_one``."""

    column: str
    agg: str
    label: str
    per_one: int = 1

    def expr(self) -> Column:
        c = units(self.column, self.per_one)
        if self.agg == "SUM":
            total = F.sum(c)
            return (total if self.per_one == 1 else amount(total, self.per_one)).alias(self.label)
        if self.agg == "AVG":
            return F.try_divide(F.sum(c).cast("double"), (F.count(c) * self.per_one).cast("double")).alias(self.label)
        raise ValueError(f"unsupported aggregate {self.agg}")


def chart(
    df: DataFrame,
    by: Sequence[str],
    metrics: Sequence[Metric],
    limit: int | None = None,
) -> DataFrame:
    """Group and aggregate; with a ``limit`` keep the groups with the largest first metric, ties by group."""
    out = df.groupBy(*by).agg(*[m.expr() for m in metrics])
    if limit is None:
        return out
    return out.orderBy(F.desc_nulls_last(metrics[0].label), *by).limit(limit)


def revenue_by_month_category(cube: DataFrame) -> DataFrame:
    return chart(cube, ["year_month", "category_name"], [Metric("revenue", "SUM", "revenue", 100)])


def revenue_by_category(cube: DataFrame, limit: int | None = None) -> DataFrame:
    return chart(cube, ["category_name"], [Metric("revenue", "SUM", "revenue", 100)], limit)


def orders_units_by_month(cube: DataFrame) -> DataFrame:
    """Orders are added over categories, so an order with two categories counts twice."""
    metrics = [Metric("order_count", "SUM", "orders"), Metric("units_sold", "SUM", "units")]
    return chart(cube, ["year_month"], metrics)


def orders_by_zone(cube: DataFrame, limit: int | None = None) -> DataFrame:
    return chart(cube, ["zone_name"], [Metric("order_count", "SUM", "orders")], limit)


def revenue_by_zone(cube: DataFrame, limit: int | None = None) -> DataFrame:
    return chart(cube, ["zone_name"], [Metric("total_revenue", "SUM", "revenue", 100)], limit)


def delivery_by_zone(cube: DataFrame, limit: int | None = None) -> DataFrame:
    """Unweighted means of the monthly means."""
    metrics = [Metric("avg_distance_km", "AVG", "avg_km", 100), Metric("avg_delivery_min", "AVG", "avg_min", 10)]
    return chart(cube, ["zone_name"], metrics, limit)


def status_over_time(cube: DataFrame) -> DataFrame:
    return chart(cube, ["year_month", "status"], [Metric("order_count", "SUM", "orders")])


def status_distribution(cube: DataFrame) -> DataFrame:
    by_status = chart(cube, ["status"], [Metric("order_count", "SUM", "orders")])
    everything = F.sum("orders").over(W.partitionBy())
    return by_status.withColumn("percent", amount(half_up(F.col("orders") * 10_000, everything)))


def revenue_by_status_month(cube: DataFrame) -> DataFrame:
    return chart(cube, ["year_month", "status"], [Metric("revenue", "SUM", "revenue", 100)])


# Chart name -> (cube it reads, function).
BOARDS = {
    "board_revenue_by_month_category": ("cube_revenue_month_category", revenue_by_month_category),
    "board_revenue_by_category": ("cube_revenue_month_category", revenue_by_category),
    "board_orders_units_by_month": ("cube_revenue_month_category", orders_units_by_month),
    "board_orders_by_zone": ("cube_orders_by_zone", orders_by_zone),
    "board_revenue_by_zone": ("cube_orders_by_zone", revenue_by_zone),
    "board_delivery_by_zone": ("cube_orders_by_zone", delivery_by_zone),
    "board_status_over_time": ("cube_order_status", status_over_time),
    "board_status_distribution": ("cube_order_status", status_distribution),
    "board_revenue_by_status_month": ("cube_order_status", revenue_by_status_month),
}
