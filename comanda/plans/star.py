"""Two star schemas with one face: derived lazily from operational tables, or read from the warehouse."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from comanda.operators import dims as D
from comanda.operators import facts
from comanda.sources.operational import Tables


class LazyStar:
    """Dimensions and facts as plans over the operational tables; nothing is stored."""

    def __init__(self, spark: SparkSession, tables: Tables):
        self.spark = spark
        self.tables = tables

    @cached_property
    def dim_date(self) -> DataFrame:
        return D.dim_date(self.tables.orders)

    @cached_property
    def dim_time(self) -> DataFrame:
        return D.dim_time(self.spark)

    @cached_property
    def dim_category(self) -> DataFrame:
        return D.dim_category(self.tables.categories)

    @cached_property
    def dim_product(self) -> DataFrame:
        return D.dim_product(self.tables.products, self.dim_category)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return D.dim_customer(self.tables.users)

    @cached_property
    def dim_restaurant(self) -> DataFrame:
        return D.dim_restaurant(self.tables.restaurants)

    @cached_property
    def dim_location(self) -> DataFrame:
        return D.dim_location(self.tables.zones)

    @cached_property
    def dim_courier(self) -> DataFrame:
        return D.dim_courier(self.tables.couriers)

    # Names the fact builders look dimensions up by.
    category = property(lambda self: self.dim_category)
    product = property(lambda self: self.dim_product)
    customer = property(lambda self: self.dim_customer)
    restaurant = property(lambda self: self.dim_restaurant)
    location = property(lambda self: self.dim_location)
    courier = property(lambda self: self.dim_courier)

    def orders(self, *columns: str) -> DataFrame:
        return facts.fact_orders(self.tables, self, columns or facts.FACT_ORDERS)

    def orders_to_count(self, *columns: str) -> DataFrame:
        """Orders whose customer and restaurant keys are only counted: any unique value will do."""
        return facts.fact_orders(self.tables, self, columns, natural_keys=True)

    def items(self, *columns: str) -> DataFrame:
        return facts.fact_order_items(self.tables, self, columns or facts.FACT_ORDER_ITEMS)


class StoredStar:
    """Dimensions and facts read back from the warehouse database."""

    def __init__(self, spark: SparkSession, database: str):
        self.spark = spark
        self.database = database

    def table(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.database}.{name}")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("dim_"):
            return self.table(name)
        if name in ("category", "product", "customer", "restaurant", "location", "courier"):
            return self.table(f"dim_{name}")
        raise AttributeError(name)

    def orders(self, *columns: str) -> DataFrame:
        return self.table("fact_orders").select(*(columns or facts.FACT_ORDERS))

    orders_to_count = orders

    def items(self, *columns: str) -> DataFrame:
        return self.table("fact_order_items").select(*(columns or facts.FACT_ORDER_ITEMS))
