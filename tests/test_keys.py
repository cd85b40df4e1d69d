import re

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from comanda.operators.keys import dense_key, ordered_key, running_sum


def test_equals_row_number_for_any_partitioning(spark):
    ids = [-40, -3, 0, 1, 2, 15, 16, 17, 1000, 5_000_000_000] + list(range(20_000, 20_200, 3))
    df = spark.createDataFrame([(i, str(i)) for i in ids], "id long, name string")
    expected = {r["id"]: r["n"] for r in df.select("id", F.row_number().over(W.orderBy("id")).alias("n")).collect()}
    for parts in (1, 5, 13):
        got = dense_key(df.repartition(parts), "id", "k", bucket_bits=4)
        assert {r["id"]: r["k"] for r in got.collect()} == expected
        assert got.columns == ["id", "name", "k"]


def test_ids_far_apart(spark):
    """Every id is a range of its own; no window sees more than one range of ranges."""
    ids = [(1 << 18) * i for i in range(3000)] + [-(1 << 62), 1 << 62]
    got = dense_key(spark.createDataFrame([(i,) for i in ids], "id long").repartition(7), "id", "k")
    assert [r["id"] for r in got.orderBy("k").collect()] == sorted(ids)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all(re.search(r"\], \[_?\w+#", line) for line in windows), plan
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("parts", ["1", "7"])
def test_keys_in_the_order_of_any_columns(spark, parts):
    """A third of all rows are equal, and one order holds half of the others."""
    rows = [(6, "x", 1.5)] * 300 + [(6, f"p{i % 50:02d}", float(i)) for i in range(300)] + [(i % 90, None, 0.0) for i in range(300)]
    df = spark.createDataFrame(rows, "o long, p string, v double").repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = ordered_key(df, ["o", "p", "v"], "k")
        assert got.columns == ["o", "p", "v", "k"]
        found = [(r.o, r.p, r.v) for r in got.orderBy("k").collect()]
        assert sorted(r.k for r in got.collect()) == list(range(1, 901))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert found == sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or "", r[2]))
    assert ordered_key(df.limit(0), ["o"], "k").collect() == []


def test_running_sums_of_ids_far_apart(spark):
    """A hot group whose visitors are each a range of their own: windows see ranges of ranges only."""
    rows = [(1, i << 18, i % 7) for i in range(2000)] + [(2, -i * 31, 1) for i in range(40)] + [(3, 5, 9)]
    df = spark.createDataFrame(rows, "g long, id long, v long").repartition(4)
    got = running_sum(df, "g", "id", "v", "before", "total", bucket_bits=5)
    expected = {}
    for g in (1, 2, 3):
        done, own = 0, sorted((i, v) for x, i, v in rows if x == g)
        for i, v in own:
            expected[g, i] = (done, sum(v for _, v in own))
            done += v
    assert {(r.g, r.id): (r.before, r.total) for r in got.collect()} == expected
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) > 2 and all(re.search(r"\], \[g#\w+, _\w+#", line) for line in windows), plan


def test_line_keys_are_dense(spark):
    from comanda.plans.registry import star
    from tests.conftest import SF_DIR

    lines = star(spark, SF_DIR).items()
    n, lo, hi, distinct = lines.agg(F.count("*"), F.min("item_key"), F.max("item_key"),
                                    F.countDistinct("item_key")).first()
    assert (lo, hi, distinct) == (1, n, n)
