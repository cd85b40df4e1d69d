"""Product catalogue: search documents and change detection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comanda.functions.money import units
from comanda.session import cut_lineage
from comanda.sinks.parts import PART, PartStore


def search_documents(products: DataFrame, categories: DataFrame) -> DataFrame:
    """One document per product with a category: (id, name, price, available, category)."""
    kinds = categories.select(F.col("id").alias("category_id"), F.col("name").alias("category"))
    return products.join(kinds, "category_id").select(
        "id", "name", F.col("price").cast("double").alias("price"), "available", "category"
    )


def as_documents(documents: DataFrame) -> DataFrame:
    """(_id, _source) as a bulk index load takes them."""
    return documents.select(F.col("id").alias("_id"), F.struct(*documents.columns).alias("_source"))


def _text(col: str) -> Column:
    """Value with its length in front, so that neighbouring values cannot run into each other; NULL is '-'."""
    c = F.col(col).cast("string")
    return F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-"))


def fingerprint(products: DataFrame) -> DataFrame:
    """One row (products, digest) that changes with any product's id, name, price, category or availability.

    Each row is hashed, and the two halves of the hash are added up over all rows. The sums do not depend on the
    order of rows, so no global sort is needed and partial sums are merged.
    """
    rows = products.select("id", "name", units("price").alias("price"), "category_id", "available")
    digest = F.md5(F.concat(*[_text(c) for c in rows.columns]))

    sums = rows.select(digest.alias("row_digest")).agg(
        F.count(F.lit(1)).alias("products"), _half_sum(1).alias("head"), _half_sum(17).alias("tail")
    )
    text = F.concat_ws("|", F.col("products").cast("string"), F.col("head").cast("string"),
                       F.col("tail").cast("string"))
    return sums.select("products", F.md5(text).alias("digest"))


RANGE_BITS = 12  # ids of a range: 4,096


def _half_sum(start: int) -> Column:
    return F.sum(F.conv(F.substring("row_digest", start, 15), 16, 10).cast("decimal(20,0)"))


def range_digests(documents: DataFrame, bits: int = RANGE_BITS) -> DataFrame:
    """(id_range, documents, head, tail): sums of the row hashes for each range of ids, the leaves of a tree of digests.

    Sums add up, so the digest of any range of ranges, up to the whole catalogue, is the sum of its leaves.
    """
    priced = documents.withColumn("price", units("price")).select("id", "name", "price", "available", "category")
    hashed = priced.select(
        F.shiftright(F.col("id").cast("bigint"), bits).alias("id_range"), F.md5(F.concat(*[_text(c) for c in priced.columns])).alias("row_digest"))
    return hashed.groupBy("id_range").agg(
        F.count(F.lit(1)).alias("documents"), _half_sum(1).alias("head"), _half_sum(17).alias("tail"))


def refresh(documents: DataFrame, store: PartStore, bits: int = RANGE_BITS) -> int:
    """Write the ranges of search documents that changed since the last version of the store, and drop those that are gone;
    how many ranges. Unchanged ranges are neither written nor, beyond their digest, looked at."""
    leaves = range_digests(documents, bits).select(
        F.col("id_range").alias(PART), F.col("documents").alias("rows"), 
        F.concat_ws("|", F.col("head").cast("string"), F.col("tail").cast("string")).alias("digest"))
    now, before = cut_lineage(leaves), store.manifest()
    known = before.select(PART, "rows", "digest")
    changed = cut_lineage(now.join(known, [PART, "rows", "digest"], "left_anti"))
    gone = cut_lineage(before.select(PART).join(now, PART, "left_anti"))
    touched = changed.count() + gone.count()
    if touched:
        rows = as_documents(documents).withColumn(PART, F.shiftright(F.col("_id").cast("bigint"), bits))
        store.replace(rows.join(changed.select(PART), PART, "left_semi"), changed, gone)
    return touched
