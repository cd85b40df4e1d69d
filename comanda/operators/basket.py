"""Products bought together, best sellers of a category, couriers and their zones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from comanda.session import cut_lineage

BLOCK_NAMES = 64  # names of an order in a block


def _names_in_orders(lines: DataFrame, products: DataFrame) -> DataFrame:
    """One row per order and product name, with the span of the product ids behind the name."""
    named = lines.select("order_id", "prod_id").join(products.select("prod_id", "name"), "prod_id")
    return named.groupBy("order_id", "name").agg(F.min("prod_id").alias("lo"), F.max("prod_id").alias("hi"))


def _pair_orders(baskets: DataFrame) -> DataFrame:
    """Orders that hold a product named product_1 with a smaller id than one named product_2.

    (order, name) is unique, so an order counts once for a pair of names and no distinct count is needed. An order of
    k names has about k^2 / 2 pairs to be counted, whatever the plan; they are formed block by block, by as many tasks
    as there are blocks, and added up before the shuffle by names.
    """
    # blocks of about BLOCK_NAMES names, and every block with every block: the number of rows under a key is bounded
    sizes = baskets.groupBy("order_id").agg(F.ceil(F.count(F.lit(1)) / BLOCK_NAMES).cast("int").alias("blocks"))
    blocked = baskets.join(sizes, "order_id").withColumn("block", F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    one = blocked.select("order_id", F.col("name").alias("product_1"), "lo", F.col("block").alias("block_1"),
                         others.alias("block_2"))
    two = blocked.select("order_id", F.col("name").alias("product_2"), "hi", F.col("block").alias("block_2"),
                         others.alias("block_1"))
    return (
        one.join(two, ["order_id", "block_1", "block_2"])
        .filter(F.col("lo") < F.col("hi"))
        .groupBy("product_1", "product_2")
        .agg(F.count(F.lit(1)).alias("orders_together"))
    )


def copurchase(lines: DataFrame, products: DataFrame, limit: int = 5, probe: int = 12) -> DataFrame:
    """The ``limit`` pairs of product names found together in most orders, ties by name.

    ``lines`` has (order_id, prod_id), and may repeat a pair: edges need not be reduced for this.
    A pair is in at most as many orders as the rarer of its names. The pairs of the ``probe`` most frequent names are
    counted first; names in fewer orders than the last of the best ``limit`` of them cannot be part of the answer
    and are dropped before pairs are formed. That helps where frequencies differ, and changes no result.
    """
    baskets = cut_lineage(_names_in_orders(lines, products))  # read by the probe, the counts and the pairs
    frequency = baskets.groupBy("name").agg(F.count(F.lit(1)).alias("orders"))
    frequent = frequency.orderBy(F.desc("orders"), "name").limit(probe).select("name")
    best = _pair_orders(baskets.join(frequent, "name", "left_semi")).orderBy(F.desc("orders_together")).limit(limit)
    floor = best.agg(
        F.when(F.count(F.lit(1)) == limit, F.min("orders_together")).otherwise(1).alias("floor")
    )
    candidates = frequency.filter(F.col("orders") >= floor.scalar()).select("name")
    return (
        _pair_orders(baskets.join(candidates, "name", "left_semi"))
        .orderBy(F.desc("orders_together"), "product_1", "product_2")
        .limit(limit)
    )


def top_products(edges: DataFrame, products: DataFrame, limit: int = 3) -> DataFrame:
    """The best sellers of each category by units, ties by name; one row per product."""
    sold = (
        edges.select("order_id", "prod_id", "quantity")
        .join(products.select("prod_id", "name", "category"), "prod_id")
        .groupBy("category", F.col("name").alias("product"))
        .agg(F.sum("quantity").alias("units"), F.countDistinct("order_id").alias("orders"))
    )
    best = W.partitionBy("category").orderBy(F.desc("units"), "product")
    return sold.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= limit)


def top_products_nested(edges: DataFrame, products: DataFrame, limit: int = 3) -> DataFrame:
    """The same as one list of (product, units) per category."""
    entry = F.struct("place", "product", "units")
    ordered = F.array_sort(F.collect_list(entry))
    return top_products(edges, products, limit).groupBy("category").agg(
        F.transform(ordered, lambda e: F.struct(e["product"].alias("product"), e["units"].alias("units")))
        .alias("best")
    )


def courier_top_zone(deliveries: DataFrame, couriers: DataFrame) -> DataFrame:
    """Deliveries (courier_id, zone) of each courier, and the zone of most of them; of equal zones the first by name."""
    who = couriers.select("courier_id", F.col("name").alias("courier_name"), "vehicle")
    by_zone = (
        deliveries.groupBy("courier_id", "zone")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(who, "courier_id")
        .groupBy("courier_name", "vehicle", "zone")
        .agg(F.sum("n").alias("n"))
    )
    return by_zone.groupBy("courier_name", "vehicle").agg(
        F.sum("n").alias("total_deliveries"),
        F.min(F.struct((-F.col("n")).alias("rank"), "zone")).getField("zone").alias("top_zone"),
    )
