"""Shared pieces of the text operators: words, readers, bounded-memory rows in sorted partitions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but these ASCII white-space characters (the ones bytes.split() knows).
WORD = r"[^\x20\x09-\x0D]+"
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z only; other letters keep their case."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """Array of the words of a text; null has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def remainder(doc_id: Column) -> Column:
    """The fold of a document: crc32 of its id as text, modulo 5 (null: fold of the empty string)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def small(df: DataFrame, rows: int, limit: int = 100_000) -> DataFrame:
    """Broadcast a table of narrow rows that were counted; a larger one is joined by shuffle, skewed keys split."""
    return F.broadcast(df) if rows <= limit else df


def fresh(df: DataFrame, wanted: str) -> str:
    """A column name that the table does not have yet."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def groups_of(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Consecutive rows with one key, from batches sorted by it; holds one group and one batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for start, end in zip(cuts, cuts[1:]):
            if held and held[-1].column(held[-1].schema.get_field_index(key))[0].as_py() != keys[start]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)
