"""Data quality checks and load validation."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comanda.operators import dims
from comanda.sources.operational import Tables


class QualityError(ValueError):
    """At least one check failed; the message lists all of them."""


@dataclass(frozen=True)
class Check:
    """A measured value and its bound: ``at_least`` the threshold, or else ``below`` it."""

    name: str
    measured: DataFrame  # one row, one column
    threshold: int
    message: str
    at_least: bool = True

    def row(self) -> DataFrame:
        value = F.coalesce(F.col(self.measured.columns[0]).cast("bigint"), F.lit(0).cast("bigint"))
        good: Column = value >= self.threshold if self.at_least else value < self.threshold
        return self.measured.select(
            F.lit(self.name).alias("check_name"),
            value.alias("value"),
            F.lit(self.threshold).cast("bigint").alias("threshold"),
            good.alias("passed"),
            F.lit(self.message).alias("message"),
        )


def _rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("value"))


# The marts that must not be empty.
NOT_EMPTY = ["mart_trends", "mart_peak_hours", "mart_monthly_growth"]
MIN_ORDERS = 1000


def row_count_checks(marts: dict[str, DataFrame]) -> list[Check]:
    return [Check(name, _rows(marts[name]), 1, "no rows") for name in NOT_EMPTY]


def min_orders_check(summary: DataFrame, min_orders: int = MIN_ORDERS) -> Check:
    return Check("mart_executive_summary", summary.select(F.col("total_orders").alias("value")), min_orders,
                 f"fewer than {min_orders} orders")


def null_revenue_check(trends: DataFrame, max_nulls: int = 1) -> Check:
    nulls = trends.agg(F.count(F.when(F.col("revenue").isNull(), 1)).alias("value"))
    return Check("no_nulls_trends", nulls, max_nulls, "null revenue", at_least=False)


def report(checks: list[Check]) -> DataFrame:
    """(check_name, value, threshold, passed, message), one row per check."""
    return reduce(DataFrame.unionByName, [check.row() for check in checks])


def all_checks(marts: dict[str, DataFrame], min_orders: int = MIN_ORDERS, max_nulls: int = 1) -> DataFrame:
    return report([
        *row_count_checks(marts),
        min_orders_check(marts["mart_executive_summary"], min_orders),
        null_revenue_check(marts["mart_trends"], max_nulls),
    ])


def gate(checked: DataFrame) -> None:
    """Raise with every failed check. The report has one row per check, so it fits the driver."""
    failed = [f"{r['check_name']}: {r['message']} (value={r['value']})" for r in checked.filter("NOT passed").collect()]
    if failed:
        raise QualityError("data quality checks failed:\n" + "\n".join(failed))


@dataclass(frozen=True)
class Relation:
    name: str
    child: str  # table and its key
    key: str
    parent: str
    parent_key: str = "id"


# Foreign keys that the facts are joined over.
RELATIONS = [
    Relation("orders.customer", "orders", "user_id", "customers"),
    Relation("orders.restaurant", "orders", "restaurant_id", "restaurants"),
    Relation("order_items.order", "order_items", "order_id", "orders"),
    Relation("order_items.product", "order_items", "product_id", "products"),
    Relation("deliveries.order", "deliveries", "order_id", "orders"),
    Relation("deliveries.courier", "deliveries", "courier_id", "couriers"),
    Relation("deliveries.zone", "deliveries", "dest_zone", "zones", "zone"),
    Relation("products.category", "products", "category_id", "categories"),
]


def _keys(table: DataFrame, named: list[tuple[str, str]]) -> DataFrame:
    """(relation, k): the keys of all relations of a table, in one pass over it."""
    return table.select(F.explode(F.array(*(
        F.struct(F.lit(relation).alias("relation"), F.col(key).cast("string").alias("k")) for relation, key in named
    ))).alias("r")).select("r.*")


def referential(t: Tables, relations: list[Relation] | None = None) -> DataFrame:
    """For each relation the rows of the child, those with a NULL key, and those whose key the parent does not have.

    Each table is read once as child and once as parent, whatever the number of its relations. Children are counted per
    key before anything is joined, so a key with very many rows is one row in the join.
    """
    relations = RELATIONS if relations is None else relations

    def table(name: str) -> DataFrame:
        return dims.customers(t.users) if name == "customers" else getattr(t, name)

    def all_keys(side: str, key: str) -> DataFrame:
        by_table: dict[str, list[tuple[str, str]]] = {}
        for r in relations:
            by_table.setdefault(getattr(r, side), []).append((r.name, getattr(r, key)))
        return reduce(DataFrame.unionByName, [_keys(table(name), named) for name, named in by_table.items()])

    children = all_keys("child", "key").groupBy("relation", "k").agg(F.count(F.lit(1)).alias("n"))
    parents = all_keys("parent", "parent_key").withColumn("found", F.lit(True))
    zero = F.lit(0).cast("bigint")
    found = children.join(parents, ["relation", "k"], "left").groupBy("relation").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(F.col("k").isNull(), F.col("n"))).alias("null_keys"),
        F.sum(F.when(F.col("k").isNotNull() & F.col("found").isNull(), F.col("n"))).alias("orphans"),
    )
    asked = t.orders.sparkSession.createDataFrame([(r.name,) for r in relations], "relation string")
    return asked.join(found, "relation", "left").select(
        "relation", *(F.coalesce(c, zero).alias(c) for c in ("rows", "null_keys", "orphans")))


def orders_per_status(orders: DataFrame) -> DataFrame:
    return orders.groupBy("status").agg(F.count(F.lit(1)).alias("orders"))


def orders_per_month(orders: DataFrame) -> DataFrame:
    """Month as its first day."""
    return orders.groupBy(F.trunc(F.to_date("order_ts"), "month").alias("month")).agg(
        F.count(F.lit(1)).alias("orders")
    )
