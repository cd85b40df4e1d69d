"""Dense surrogate keys and running sums without a single-task sort."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from comanda.session import cut_lineage

BUCKET_BITS = 17  # 131,072 ids in a bucket
ID_BITS = 64
FEW = 1000  # ranges whose counts are brought to the driver
ROW_BITS = 33  # monotonically_increasing_id: the row in its partition


def _range(id_col: str, bits: int) -> Column:
    """Number of the id's range, from 0 for the smallest long."""
    return F.shiftright(F.col(id_col).cast("bigint"), bits) + F.lit(1 << (ID_BITS - 1 - bits))


def _before(*partition: str) -> WindowSpec:
    return W.partitionBy(*partition).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)


def _offsets(counts: DataFrame, bits: int, by: list[str]) -> DataFrame:
    """Stored ``counts`` (by, _range, _rows) -> (by, _range, _below): the sum of the ranges below, within ``by``.

    In levels: ranges are summed inside ranges of 2^bits ranges, those inside the next larger ones, until one range holds
    all that there are. Every window is partitioned and sees at most 2^bits rows, however far the ids lie apart.
    """
    low, high = counts.agg(F.min("_range"), F.max("_range")).first()
    zero = F.lit(0).cast(dict(counts.dtypes)["_rows"])
    level = counts.withColumn("_up", F.shiftright("_range", bits))
    inside = level.withColumn("_below", F.coalesce(F.sum("_rows").over(_before(*by, "_up")), zero))
    covered = bits
    while low is not None and low >> covered != high >> covered:
        above = level.groupBy(*by, F.col("_up").alias("_range")).agg(F.sum("_rows").alias("_rows")).withColumn(
            "_next", F.shiftright("_range", bits))
        shift = above.withColumn("_shift", F.coalesce(F.sum("_rows").over(_before(*by, "_next")), zero))
        inside = inside.join(shift.select(*by, F.col("_range").alias("_up"), "_next", "_shift"), [*by, "_up"]).select(
            *by, "_range", (F.col("_below") + F.col("_shift")).alias("_below"), F.col("_next").alias("_up"))
        level = above.withColumn("_up", F.col("_next"))
        covered += bits
    return inside.select(*by, "_range", "_below")


def dense_key(df: DataFrame, id_col: str, key_name: str, bucket_bits: int = BUCKET_BITS) -> DataFrame:
    """Add ``key_name`` = 1..n in the order of the unique integer ``id_col``.

    Ids are cut into fixed ranges, so a range never holds more rows than its width. Rows are numbered inside
    their range, and shifted by the number of rows in the ranges below. Those are counted once, when this is called: up to
    ``FEW`` counts come to the driver, more are stored and added up in levels of ranges. The result depends on the ids
    alone, so a recomputed task repeats the same keys.
    """
    ranged = df.withColumn("_range", _range(id_col, bucket_bits))
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    few = sorted(tuple(r) for r in counts.limit(FEW + 1).collect())
    placed = ranged.withColumn("_place", F.row_number().over(W.partitionBy("_range").orderBy(id_col)))
    if len(few) <= 1:
        return placed.withColumn(key_name, F.col("_place").cast("bigint")).drop("_range", "_place")
    if len(few) <= FEW:
        below = [0, *accumulate(rows for _, rows in few)]
        offsets = F.broadcast(df.sparkSession.createDataFrame(
            [(r, b) for (r, _), b in zip(few, below)], "_range long, _below long"))
    else:
        offsets = _offsets(cut_lineage(counts), bucket_bits, [])
    return placed.join(offsets, "_range").withColumn(
        key_name, (F.col("_below") + F.col("_place")).cast("bigint")).drop("_range", "_place", "_below")


def ordered_key(df: DataFrame, order: list[str], key_name: str) -> DataFrame:
    """Add ``key_name`` = 1..n in the order of any columns; rows that are equal in them are numbered in any order.

    A sort over range partitions; the rows before a partition (one number for each) are added to a row's place in it. Rows
    are stored before they are dealt, with a number that spreads equal ones over partitions, and stored again in order:
    a lost executor can change neither where a row went nor its place.
    """
    given = cut_lineage(df.withColumn("_tie", F.monotonically_increasing_id()))
    dealt = given.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    stored = cut_lineage(dealt.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", ROW_BITS)
    sizes = sorted(tuple(r) for r in stored.groupBy(part.alias("part")).agg(F.count(F.lit(1))).collect())  # one per partition
    below = [0, *accumulate(rows for _, rows in sizes)]
    offsets = F.broadcast(df.sparkSession.createDataFrame(
        [(p, b) for (p, _), b in zip(sizes, below)], "_part long, _below long"))
    place = F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1)) + 1
    return stored.withColumn("_part", part).join(offsets, "_part").withColumn(
        key_name, (F.col("_below") + place).cast("bigint")).drop("_part", "_at", "_below")


def running_sum(df: DataFrame, group: str, id_col: str, value: str, before: str, total: str | None = None,
                bucket_bits: int = BUCKET_BITS) -> DataFrame:
    """Add ``before``: the sum of ``value`` over the rows of the group with a smaller ``id_col`` (unique in the group),
    and ``total``: that of the whole group.

    A group with very many rows is added up by ranges of ids, and the ranges in levels, so no window holds more than a
    range of either, however far the ids lie apart. Sums by range are combined before the shuffle, and stored.
    """
    ranged = df.withColumn("_range", _range(id_col, bucket_bits))
    zero = F.lit(0).cast(dict(df.dtypes)[value])
    sums = cut_lineage(ranged.groupBy(group, "_range").agg(F.sum(value).alias("_rows")))
    parts = _offsets(sums, bucket_bits, [group])
    if total:
        parts = parts.join(sums.groupBy(group).agg(F.sum("_rows").alias(total)), group)
    inside = F.sum(value).over(W.partitionBy(group, "_range").orderBy(id_col).rowsBetween(W.unboundedPreceding, -1))
    return (
        ranged.withColumn(before, F.coalesce(inside, zero))
        .join(parts, [group, "_range"])
        .withColumn(before, F.col(before) + F.col("_below"))
        .drop("_range", "_below")
    )
