"""The six cubes as views of the warehouse: SQL text that the catalogue keeps, for every session and SQL client.

The same grains and measures as ``operators.cubes``, over the stored tables of one database. A filter on year or month
reaches the facts' partitions, as the calendar is joined over them too.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

#: What a fact shares with a dimension.
KEYS = {
    "dim_date": "date_key, year, month", "dim_time": "time_key", "dim_category": "category_key", "dim_product": "product_key",
    "dim_location": "location_key", "dim_courier": "courier_key",
}
YEAR_MONTH = "concat(CAST(year AS STRING), '-', lpad(CAST(month AS STRING), 2, '0')) AS year_month"
WIDE = "DECIMAL(38,0)"


def _units(value: str, per_one: int) -> str:
    return f"CAST({value} AS BIGINT)" if per_one == 1 else f"CAST(rint(CAST({value} AS DOUBLE) * {per_one}) AS BIGINT)"


def _amount(whole: str, per_one: int = 100) -> str:
    return f"CAST(CAST({whole} AS {WIDE}) / {per_one} AS DOUBLE)"


def _half_up(numerator: str, denominator: str) -> str:
    num, den = f"CAST({numerator} AS {WIDE})", f"nullif(CAST({denominator} AS {WIDE}), CAST(0 AS {WIDE}))"
    return f"(CASE WHEN {num} < 0 THEN -1 ELSE 1 END * ((abs({num}) * 2 + {den}) div ({den} * 2)))"


def total(value: str) -> str:
    """Exact sum of an amount with two decimals."""
    return _amount(f"sum({_units(value, 100)})")


def mean(value: str, digits: int, per_one: int = 100) -> str:
    """Exact mean, rounded half up."""
    units = _units(value, per_one)
    return _amount(_half_up(f"CAST(sum({units}) AS {WIDE}) * {10**digits}", f"count({units}) * {per_one}"), 10**digits)


def count_if(condition: str) -> str:
    return f"sum(CASE WHEN {condition} THEN 1 ELSE 0 END)"


@dataclass(frozen=True)
class CubeView:
    comment: str
    fact: str
    dimensions: tuple[str, ...]
    grain: tuple[str, ...]
    measures: dict[str, str]
    rows: str = ""

    def text(self, database: str) -> str:
        joins = "".join(f" JOIN `{database}`.{d} AS {d} USING ({KEYS[d]})" for d in self.dimensions)
        measures = (f"{formula} AS {name}" for name, formula in self.measures.items())
        where = f" WHERE {self.rows}" if self.rows else ""
        by = ", ".join(str(i + 1) for i in range(len(self.grain)))
        return (f"SELECT {', '.join([*self.grain, *measures])} FROM `{database}`.{self.fact} AS fact{joins}{where} GROUP BY {by}")


VIEWS = {
    "cube_revenue_month_category": CubeView(
        "revenue and units by month and category", "fact_order_items", ("dim_date", "dim_category"),
        ("year", "month", "month_name", YEAR_MONTH, "category_name"), {
            "order_count": "count(DISTINCT order_id)", "units_sold": "sum(quantity)", "revenue": total("line_total"),
            "avg_unit_price": "round(avg(try_divide(line_total, quantity)), 2)"}),
    "cube_orders_by_zone": CubeView(
        "orders, distances and times by zone and month", "fact_orders", ("dim_date", "dim_location"),
        ("zone", "zone_name", "lat", "lon", "year", "month"), {
            "order_count": "count(*)", "delivered_count": count_if("is_delivered"), "avg_distance_km": mean("distance_km", 2),
            "avg_delivery_min": mean("delivery_time_min", 1, 1), "total_revenue": total("total"), "avg_ticket": mean("total", 2)}),
    "cube_order_status": CubeView(
        "orders by month, status and payment", "fact_orders", ("dim_date",),
        ("year", "month", "month_name", YEAR_MONTH, "status", "payment_method"), {
            "order_count": "count(*)", "revenue": total("total"), "avg_ticket": mean("total", 2)}),
    "cube_peak_hours": CubeView(
        "orders by hour and day of the week", "fact_orders", ("dim_time", "dim_date"),
        ("hour", "time_label", "time_of_day", "day_of_week", "day_name", "is_weekend"), {
            "order_count": "count(*)", "revenue": total("total"), "avg_ticket": mean("total", 2),
            "avg_items_per_order": mean("item_count", 1, 1)}),
    "cube_product_ranking": CubeView(
        "sales by product", "fact_order_items", ("dim_product",),
        ("product_name", "category_name", "dim_product.unit_price AS current_price"), {
            "orders_containing": "count(DISTINCT order_id)", "units_sold": "sum(quantity)", "total_revenue": total("line_total"),
            "avg_sold_price": "round(avg(fact.unit_price), 2)",
            "revenue_per_unit": _amount(_half_up(f"sum({_units('line_total', 100)})", "sum(quantity)"))}),
    "cube_courier_performance": CubeView(
        "deliveries by courier", "fact_orders", ("dim_courier",), ("courier_name", "vehicle", "base_zone"), {
            "total_assignments": "count(*)", "completed": count_if("status = 'completed'"),
            "in_transit": count_if("status = 'delivering'"), "avg_distance_km": mean("distance_km", 2),
            "avg_eta_min": mean("eta_min", 1, 1), "avg_real_time_min": mean("delivery_time_min", 1, 1),
            "avg_delay_min": "round(avg(delivery_time_min) - avg(eta_min), 1)", "total_revenue_handled": total("total")},
        rows="courier_key > 0"),
}


def create_cube_views(spark: SparkSession, database: str) -> list[str]:
    """Create or replace the views in the database; they stay when the session ends, and read the tables as they are then."""
    for name, view in VIEWS.items():
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.{name} COMMENT '{view.comment}' AS {view.text(database)}")
    return list(VIEWS)
