"""Stored tables in parts: a change rewrites only the parts that it touches, and shows when a version is switched at the end.

    data/version=3/_part=17/..    the rows of a part, as version 3 wrote them
    versions/v=3/..               one file: for each part the version that holds its rows, their number and digest

A reader takes the last version and the parts it names. Older files stay as they are, so a reader of the version before
is not disturbed, and a run that fails before its version is written has changed nothing: the next one writes the same
number again. One writer at a time.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comanda.operators.graph import upsert
from comanda.session import cut_lineage

PART = "_part"
VERSIONS = f"{PART} long, version long, rows long, digest string, parts long"


class PartStore:
    """``parts`` is the number of hash parts, fixed for the life of the store; 0 where the writer makes the parts."""

    def __init__(self, spark: SparkSession, path: str, file_format: str = "parquet", parts: int = 0):
        self.spark, self.path, self.format, self.parts = spark, path.rstrip("/"), file_format, parts

    def version(self) -> int:
        """The last version; 0 before the first."""
        try:
            last = self.spark.read.schema(f"{VERSIONS}, v long").parquet(f"{self.path}/versions").agg(F.max("v")).first()[0]
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0
        return last or 0

    def manifest(self) -> DataFrame:
        """(_part, version, rows, digest, parts) of the last version; no rows before the first."""
        version = self.version()
        if not version:
            return self.spark.createDataFrame([], VERSIONS)
        found = self.spark.read.schema(VERSIONS).parquet(f"{self.path}/versions/v={version}")
        if self.parts and not found.filter(F.col("parts") != self.parts).isEmpty():
            raise ValueError(f"the store at {self.path} has another number of parts than {self.parts}")
        return found.filter(F.col(PART).isNotNull())

    def read(self, schema: str | None = None, parts: list[int] | None = None) -> DataFrame:
        """The rows of the last version, on request of some parts only: the files of others are not opened."""
        reader = self.spark.read.format(self.format)
        if schema:
            reader = reader.schema(f"{schema}, version long, {PART} long")
        stored = reader.load(f"{self.path}/data")
        current = self.manifest().select(F.col(PART).alias("_p"), F.col("version").alias("_v"))
        if parts is not None:
            stored, current = stored.filter(F.col(PART).isin(parts)), current.filter(F.col("_p").isin(parts))
        return stored.join(current, (F.col(PART) == F.col("_p")) & (F.col("version") == F.col("_v"))).drop(PART, "version", "_p", "_v")

    def replace(self, rows: DataFrame, sizes: DataFrame, gone: DataFrame | None = None) -> int:
        """A new version with ``rows`` (with a column _part) in place of those parts, without the parts in ``gone``.

        ``sizes`` has (_part, rows, digest) of the parts written. Returns the version.
        """
        before, version = cut_lineage(self.manifest()), self.version() + 1
        rows.hint("rebalance", PART).write.format(self.format).mode("overwrite").partitionBy(PART).save(
            f"{self.path}/data/version={version}")
        new = cut_lineage(sizes.select(PART, F.lit(version).cast("long").alias("version"), "rows", "digest",
                                       F.lit(self.parts).cast("long").alias("parts")))
        kept = before.join(new, PART, "left_anti")
        if gone is not None:
            kept = kept.join(gone, PART, "left_anti")
        own = self.spark.createDataFrame([(None, version, 0, None, self.parts)], VERSIONS)  # a store of no parts has a version, too
        kept.unionByName(new).unionByName(own).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/versions/v={version}")
        return version

    def merge(self, updates: DataFrame, keys: list[str], last_by: list[str]) -> list[int]:
        """Rows of ``updates`` replace those with the same keys, of repeated updates the last counts; the parts rewritten.

        Rows lie in parts by the hash of their keys. Only parts that get an update are read and written.
        """
        if not self.parts:
            raise ValueError("a store needs a number of parts for merging")
        part = F.pmod(F.xxhash64(*keys), F.lit(self.parts)).cast("long")
        columns = self.read().columns if self.version() else updates.columns
        updates = cut_lineage(updates)
        touched = sorted(r[0] for r in updates.select(part.alias(PART)).distinct().collect())  # at most as many as parts
        if not touched:
            return []
        schema = updates.select(*columns).schema
        before = self.read(parts=touched).select(*columns) if self.version() else self.spark.createDataFrame([], schema)
        merged = cut_lineage(upsert(before, updates, keys, last_by).withColumn(PART, part))
        sizes = merged.groupBy(PART).agg(F.count(F.lit(1)).alias("rows")).withColumn("digest", F.lit(None).cast("string"))
        self.replace(merged, sizes)
        return touched
