"""Operational tables mapped from the TPC-H-like test tables (definitions: FIXTURES.md, part 4).

Every frame is lazy, and takes only the columns a query asks for.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from comanda.functions.geo import haversine_km
from comanda.operators.keys import ordered_key


# Columns of the test tables. Stated here, so that opening a table starts no job.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
}


def _places(nation: DataFrame) -> DataFrame:
    key = F.col("n_nationkey")
    return nation.select(
        key.alias("nation_key"),
        (key + 1).alias("location_key"),
        F.col("n_name").alias("zone"),
        F.concat(F.lit("Zone "), key.cast("string")).alias("zone_name"),
        (F.lit(14.5) + ((key * 7) % 25) * F.lit(0.013)).alias("lat"),
        (F.lit(-90.7) + ((key * 11) % 25) * F.lit(0.011)).alias("lon"),
    )


def _users(customer: DataFrame, places: DataFrame) -> DataFrame:
    return customer.join(places, F.col("c_nationkey") == F.col("nation_key")).select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("user"), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias("email"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "admin").otherwise("customer").alias("role"),
        "zone", "lat", "lon",
    )


def _restaurants(supplier: DataFrame, places: DataFrame) -> DataFrame:
    return supplier.join(places, F.col("s_nationkey") == F.col("nation_key")).select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("Street "), F.col("s_suppkey").cast("string")).alias("address"),
        "zone", "lat", "lon",
        ((F.col("s_suppkey") % 50) / 10.0).cast("double").alias("rating"),
    )


def _categories(part: DataFrame) -> DataFrame:
    # One row per product type: the window only sees the few distinct types.
    types = part.select(F.col("p_type").alias("name")).distinct()
    return types.select(
        F.row_number().over(W.orderBy("name")).cast("bigint").alias("id"),
        "name",
        F.concat(F.lit("Products of type "), F.col("name")).alias("description"),
        F.substring("name", 1, 1).alias("icon"),
    )


def _products(part: DataFrame, categories: DataFrame) -> DataFrame:
    kinds = categories.select(F.col("id").alias("category_id"), F.col("name").alias("category_name"))
    return part.join(kinds, F.col("p_type") == F.col("category_name")).select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").alias("price"),
        (F.col("p_size") % 10 != 0).alias("available"),
        "category_id",
    )


def _orders(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    seller = lineitem.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("restaurant_id"))
    key = F.col("o_orderkey")
    status = (
        F.when(F.col("o_orderstatus") == "F", "completed")
        .when(
            F.col("o_orderstatus") == "O",
            F.when(key % 3 == 0, "delivering").when(key % 3 == 1, "preparing").otherwise("confirmed"),
        )
        .otherwise(F.when(key % 2 == 0, "cancelled").otherwise("pending"))
    )
    payment = F.when(key % 10 < 5, "card").when(key % 10 < 8, "cash").otherwise("wallet")
    return orders.join(seller, key == F.col("l_orderkey"), "left").select(
        key.alias("id"),
        F.col("o_custkey").alias("user_id"),
        "restaurant_id",
        F.timestamp_add("SECOND", key * 7919 % 86400, F.col("o_orderdate")).alias("order_ts"),
        status.alias("status"),
        F.col("o_totalprice").alias("total"),
        payment.alias("payment_method"),
    )


def _deliveries(orders: DataFrame, users: DataFrame, restaurants: DataFrame) -> DataFrame:
    to = users.select(F.col("id").alias("user_id"), F.col("zone").alias("dest_zone"),
                      F.col("lat").alias("dest_lat"), F.col("lon").alias("dest_lon"))
    origin = restaurants.select(F.col("id").alias("restaurant_id"), F.col("lat").alias("from_lat"),
                                F.col("lon").alias("from_lon"))
    km = F.round(haversine_km(F.col("from_lat"), F.col("from_lon"), F.col("dest_lat"), F.col("dest_lon")), 2)
    eta = (F.col("distance_km") * 4).cast("int") + 5 + F.col("order_id") % 11
    late = (F.col("eta_min") + F.col("order_id") % 14 - 3).cast("bigint")
    return (
        orders.filter(F.col("status").isin("completed", "delivering"))
        .join(to, "user_id")
        .join(origin, "restaurant_id", "left")
        .withColumnRenamed("id", "order_id")
        .withColumn("distance_km", km)
        .withColumn("eta_min", eta.cast("int"))
        .select(
            "order_id",
            (F.col("order_id") % 12 + 1).cast("bigint").alias("courier_id"),
            "dest_zone", "dest_lat", "dest_lon", "distance_km", "eta_min",
            F.when(F.col("status") == "completed", F.timestamp_add("MINUTE", late, F.col("order_ts")))
            .alias("delivered_ts"),
        )
    )


def _couriers(orders: DataFrame, places: DataFrame) -> DataFrame:
    """The couriers that appear on a delivery, with attributes given by their id."""
    seen = (
        orders.filter(F.col("status").isin("completed", "delivering"))
        .select((F.col("id") % 12 + 1).cast("bigint").alias("id"))
        .distinct()
    )
    base = places.select(F.col("nation_key").cast("bigint").alias("nation_key"), F.col("zone").alias("base_zone"),
                         F.col("lat").alias("base_lat"), F.col("lon").alias("base_lon"))
    vehicle = F.when(F.col("id") % 3 == 0, "moto").when(F.col("id") % 3 == 1, "bicicleta").otherwise("carro")
    return seen.join(base, F.col("id") * 2 == F.col("nation_key"), "left").select(
        "id",
        F.concat(F.lit("courier_"), F.col("id").cast("string")).alias("name"),
        vehicle.alias("vehicle"),
        "base_zone", "base_lat", "base_lon",
    )


LINE_ORDER = ["order_id", "product_id", "quantity", "line_total"]


def _items_with_id(lineitem: DataFrame) -> DataFrame:
    """Lines with a unique ``id`` that follows LINE_ORDER; equal lines are interchangeable."""
    return ordered_key(lineitem.select(*_item_columns()), LINE_ORDER, "id")


def _item_columns():
    return [
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity").cast("int")).alias("unit_price"),
        F.col("l_extendedprice").alias("line_total"),
    ]


class MappedTables:
    """The mapped tables by name, with the attributes of ``Tables``; a table is set up when it is first used.

    The lines of the test tables have no id; one is made up on request only, and else ``line_order`` tells their order.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, item_ids: bool = False):
        self._read = lambda name: spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
        self._item_ids = item_ids
        self.line_order = ["id"] if item_ids else LINE_ORDER

    @cached_property
    def places(self) -> DataFrame:
        return _places(self._read("nation"))

    @cached_property
    def zones(self) -> DataFrame:
        """The zones of the catalogue in which some user lives."""
        populated = self._read("customer").select(F.col("c_nationkey").alias("nation_key")).distinct()
        return self.places.join(populated, "nation_key", "left_semi").drop("nation_key")

    @cached_property
    def users(self) -> DataFrame:
        return _users(self._read("customer"), self.places)

    @cached_property
    def restaurants(self) -> DataFrame:
        return _restaurants(self._read("supplier"), self.places)

    @cached_property
    def categories(self) -> DataFrame:
        return _categories(self._read("part"))

    @cached_property
    def products(self) -> DataFrame:
        return _products(self._read("part"), self.categories)

    @cached_property
    def orders(self) -> DataFrame:
        return _orders(self._read("orders"), self._read("lineitem"))

    @cached_property
    def order_items(self) -> DataFrame:
        lineitem = self._read("lineitem")
        return _items_with_id(lineitem) if self._item_ids else lineitem.select(*_item_columns())

    @cached_property
    def deliveries(self) -> DataFrame:
        return _deliveries(self.orders, self.users, self.restaurants)

    @cached_property
    def couriers(self) -> DataFrame:
        return _couriers(self.orders, self.places)


def operational_tables(spark: SparkSession, sf_dir: str, item_ids: bool = False) -> MappedTables:
    return MappedTables(spark, sf_dir, item_ids)
