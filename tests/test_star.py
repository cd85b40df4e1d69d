"""Awkward rows, on the hand-made tables."""

import pytest

from comanda.operators import cubes, dims, graph, marts, quality
from comanda.plans.star import LazyStar


@pytest.fixture(scope="module")
def star(spark, small):
    return LazyStar(spark, small)


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def test_fact_orders(star):
    rows = by(star.orders(), "order_id")
    assert len(rows) == 6
    assert rows[100].delivery_time_min == 11  # 11:59 is cut, not rounded
    assert rows[101].delivery_time_min == 0  # 59 s before the order: toward zero
    assert rows[101].customer_key is None and rows[101].courier_key == -1  # admin, no courier
    assert rows[102].delivery_time_min is None and rows[102].is_delivered
    assert rows[103].location_key == -1 and rows[103].restaurant_key is None and rows[103].item_count == 0
    assert rows[104].location_key == -1 and rows[104].distance_km is None  # zone is not in the catalogue
    assert (rows[100].time_key, rows[102].date_key, rows[100].item_count) == (0, 20250111, 3)


def test_a_subset_of_columns_keeps_the_rows(star):
    full = by(star.orders(), "order_id")
    for c in ("customer_key", "item_count", "delivery_time_min", "courier_key", "total"):
        assert {k: r[c] for k, r in by(star.orders("order_id", c), "order_id").items()} == \
            {k: r[c] for k, r in full.items()}
    with pytest.raises(ValueError):
        star.orders("no_such_column")


def test_fact_order_items(star):
    rows = star.items().collect()
    # Not there: the admin's line, the product without category.
    assert sorted((r.order_id, r.line_total) for r in rows) == [
        (100, 4.5), (100, 6.0), (100, 10.0), (102, 4.5), (102, 21.75), (104, 7.25), (105, 18.0)]
    assert sorted(r.item_key for r in rows) == list(range(1, 8))
    assert len(star.items("order_id", "line_total").collect()) == 7


def test_dimensions(spark, small, star):
    assert [r.customer_key for r in star.dim_customer.orderBy("user_id").collect()] == [1, 2]
    assert star.dim_product.count() == 3
    assert star.dim_date.count() == 56  # 10 January to 6 March, days without orders included
    assert dims.dim_date_between(spark, "2025-07-01", "2026-06-30").count() == 365
    times = by(star.dim_time, "hour")
    assert [times[h].time_of_day for h in (5, 6, 11, 12, 14, 15, 17, 18, 22, 23)] == [
        "madrugada", "mañana", "mañana", "almuerzo", "almuerzo", "tarde", "tarde", "cena", "cena", "noche"]
    assert len(times) == 24 and times[9].time_label == "09:00"
    assert dims.dim_location(small.zones, unknown_member=True).filter("location_key = -1").count() == 1


def test_zone_cube_ignores_the_unknown_zone(star):
    rows = by(cubes.orders_by_zone(star), "zone", "month")
    assert set(rows) == {("z1", 1), ("z2", 1)}
    assert rows["z1", 1].order_count == 2 and rows["z1", 1].avg_distance_km == 0.88  # 0.875, half up
    assert rows["z2", 1].avg_delivery_min is None


def test_growth_skips_a_month_without_orders(star):
    rows = marts.monthly_growth(star).orderBy("year", "month").collect()
    assert [(r.year_month, r.order_count, r.unique_customers) for r in rows] == [("2025-01", 2, 1), ("2025-03", 1, 1)]
    assert rows[0].revenue_pct_change is None and rows[1].order_count_pct_change == -50.0
    assert rows[1].cumulative_revenue == 35.35


def test_summary_of_no_completed_orders(spark, small):
    from dataclasses import replace

    none = LazyStar(spark, replace(small, orders=small.orders.filter("status <> 'completed'")))
    row = marts.executive_summary(none).first()
    assert row.total_orders == 3 and row.completed_orders is None


def test_trend_ranks_share_a_place(spark, small):
    from dataclasses import replace

    tie = spark.createDataFrame([(1, 100, 10, 1, 5.0, 5.0), (2, 100, 20, 1, 5.0, 5.0)], small.order_items.schema)
    rows = marts.trends(LazyStar(spark, replace(small, order_items=tie))).collect()
    assert [r.revenue_rank_in_month for r in rows] == [1, 1]


def test_zero_quantity_does_not_fail(spark, small):
    from dataclasses import replace

    zero = spark.createDataFrame([(1, 100, 10, 0, 5.0, 5.0)], small.order_items.schema)
    star = LazyStar(spark, replace(small, order_items=zero))
    assert cubes.revenue_month_category(star).first().avg_unit_price is None
    assert cubes.product_ranking(star).first().revenue_per_unit is None


def test_means_of_very_large_totals(spark):
    from comanda.functions.money import exact_mean, exact_sum

    big = spark.createDataFrame([(4e14,), (4e14,), (-0.25,), (None,)], "x double")
    both = big.agg(exact_mean("x", 2).alias("m"), exact_sum("x").alias("s")).first()
    assert both == (266666666666666.58, 8e14 - 0.25)
    small_ = spark.createDataFrame([(-0.25,), (-0.26,)], "x double")
    assert small_.agg(exact_mean("x", 2).alias("m")).first().m == -0.26  # -0.255, away from zero


def test_graph_edges(small):
    edges = by(graph.contains(small), "order_id", "prod_id")
    assert edges[100, 10].line_total == 6.0  # the last line, not the largest
    assert (104, 40) not in edges  # a product without category is not a node
    assert graph.assigned(small).count() == 3
    assert {r.order_id for r in graph.delivered_to(small).collect()} == {100, 101, 102}
    assert graph.placed(small).count() == 6 and graph.from_restaurant(small).count() == 5


def test_upsert(spark):
    old = spark.createDataFrame([(1, 1, 5.0), (1, 2, 6.0)], "src long, dst long, km double")
    new = spark.createDataFrame([(1, 2, 9.0, 1), (1, 2, 7.0, 2), (3, 3, 1.0, 1)],
                                "src long, dst long, km double, version int")
    merged = graph.upsert(old, new, ["src", "dst"], ["version"]).collect()
    assert sorted(map(tuple, merged)) == [(1, 1, 5.0), (1, 2, 7.0), (3, 3, 1.0)]


def test_referential(small):
    rows = by(quality.referential(small), "relation")
    assert rows["orders.customer"].orphans == 1 and rows["orders.restaurant"].null_keys == 1
    assert rows["deliveries.zone"].orphans == 1 and rows["products.category"].orphans == 1
    assert rows["order_items.order"].orphans == 0 and rows["deliveries.courier"].null_keys == 1


def test_gate_lists_every_failure(spark):
    empty = spark.createDataFrame([], "revenue double")
    summary = spark.createDataFrame([(10,)], "total_orders long")
    marts_ = {name: empty for name in quality.NOT_EMPTY} | {"mart_executive_summary": summary}
    with pytest.raises(quality.QualityError) as error:
        quality.gate(quality.all_checks(marts_))
    assert str(error.value).count("\n") == 4
    nulls = spark.createDataFrame([(None,), (1.0,)], "revenue double")
    marts_ = {name: nulls for name in quality.NOT_EMPTY} | {"mart_executive_summary": summary}
    quality.gate(quality.all_checks(marts_, min_orders=10, max_nulls=2))
    with pytest.raises(quality.QualityError, match="null revenue"):
        quality.gate(quality.all_checks(marts_, min_orders=10))


def test_zone_names(spark, small):
    """The warehouse and the graph have a name of their own for one zone."""
    from dataclasses import replace

    from comanda.operators import dims, graph
    from comanda.sources.operational import default_zones

    zones = default_zones(spark)
    assert {r.zone_name for r in dims.dim_location(zones).filter("zone = 'antigua'").collect()} == {"Antigua"}
    named = graph.locations(replace(small, zones=zones))
    assert {r.zone: r.zone_name for r in named.collect()}["antigua"] == "Antigua Guatemala"


def test_last_line_with_large_quantities(spark, small):
    """The last of repeated lines has the largest amount, whatever the quantities."""
    from dataclasses import replace

    from comanda.operators import graph
    from comanda.plans.registry import _last_line

    lines = spark.createDataFrame([(1, 100, 10, 1 << 25, 0.01, 5.0), (2, 100, 10, 1, 6.0, 6.0)],
                                  "id long, order_id long, product_id long, quantity int, unit_price double, line_total double")
    assert graph.contains(replace(small, order_items=lines), _last_line()).first().line_total == 6.0
