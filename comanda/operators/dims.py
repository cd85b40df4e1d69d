"""The eight dimensions, built from the columns that the warehouse schema declares."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comanda import schemas
from comanda.functions.calendar import date_key, time_of_day
from comanda.operators.keys import dense_key

UNKNOWN_KEY = -1

#: Calendar attributes, as functions of a date column.
OF_A_DAY = {
    "date_key": date_key,
    "full_date": lambda d: d,
    "year": F.year,
    "quarter": F.quarter,
    "semester": lambda d: F.ceil(F.month(d) / 6),
    "month": F.month,
    "month_name": lambda d: F.date_format(d, "MMMM"),
    "week_of_year": F.weekofyear,
    "day_of_month": F.day,
    "day_of_week": F.dayofweek,
    "day_name": lambda d: F.date_format(d, "EEEE"),
    "is_weekend": lambda d: F.weekday(d) >= 5,
}


def _members(table: schemas.Table, source: DataFrame, renamed: dict[str, str], keyed: bool = True) -> DataFrame:
    """A table's columns out of ``source``, where those in ``renamed`` have another name.

    By the schema's convention the first column is the surrogate key and the second the natural one.
    """
    surrogate, natural = (c.name for c in table.columns[:2])
    given = source.select(*(F.col(renamed.get(c.name, c.name)).alias(c.name) for c in table.columns[1:]))
    if not keyed:
        return given
    return table.conform(dense_key(given, natural, surrogate))


def calendar(days: DataFrame) -> DataFrame:
    """Calendar attributes of each row's ``full_date``."""
    day = F.col("full_date")
    return schemas.DIM_DATE.conform(days.select(*(of(day).alias(name) for name, of in OF_A_DAY.items())))


def dim_date(orders: DataFrame) -> DataFrame:
    """One row per day from the first to the last order."""
    bounds = orders.agg(F.min(F.to_date("order_ts")).alias("lo"), F.max(F.to_date("order_ts")).alias("hi"))
    days = bounds.filter(F.col("lo").isNotNull()).select(F.explode(F.sequence("lo", "hi")).alias("full_date"))
    return calendar(days)


def dim_date_between(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day of a fixed period, both ends included."""
    span = F.sequence(F.to_date(F.lit(first)), F.to_date(F.lit(last)))
    return calendar(spark.range(1).select(F.explode(span).alias("full_date")))


def dim_time(spark: SparkSession) -> DataFrame:
    hours = spark.range(24).select(F.col("id").cast("int").alias("hour"))
    return schemas.DIM_TIME.conform(hours.withColumns({
        "time_key": F.col("hour"),
        "time_label": F.format_string("%02d:00", "hour"),
        "time_of_day": time_of_day(F.col("hour")),
    }))


def dim_category(categories: DataFrame) -> DataFrame:
    return _members(schemas.DIM_CATEGORY, categories, {"category_id": "id", "category_name": "name"})


def dim_product(products: DataFrame, category: DataFrame, keyed: bool = True) -> DataFrame:
    """Products with a known category. ``keyed=False`` leaves the surrogate out, and with it two shuffles."""
    known = products.join(category.select("category_id", "category_key", "category_name"), "category_id")
    return _members(schemas.DIM_PRODUCT, known, {"product_id": "id", "product_name": "name", "unit_price": "price"}, keyed)


def customers(users: DataFrame) -> DataFrame:
    return users.filter(F.col("role") == "customer")


def dim_customer(users: DataFrame) -> DataFrame:
    return _members(schemas.DIM_CUSTOMER, customers(users), {"user_id": "id", "user_name": "name"})


def dim_restaurant(restaurants: DataFrame) -> DataFrame:
    return _members(schemas.DIM_RESTAURANT, restaurants, {"restaurant_id": "id", "rest_name": "name"})


def dim_location(zones: DataFrame, unknown_member: bool = False) -> DataFrame:
    """The delivery zones; on request with a row for key -1, which the facts use for 'no delivery'."""
    out = schemas.DIM_LOCATION.conform(zones)
    if not unknown_member:
        return out
    unknown = zones.sparkSession.createDataFrame([(UNKNOWN_KEY, None, "unknown", None, None)], out.schema)
    return out.unionByName(unknown)


def dim_courier(couriers: DataFrame) -> DataFrame:
    return _members(schemas.DIM_COURIER, couriers, {"courier_id": "id", "courier_name": "name"})
