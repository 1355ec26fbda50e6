"""K2/K3/K5 into stored tables: merges that rewrite only what they change.

A table is kept as Parquet in folders ``_bucket=<n>`` by the hash of its key. A merge
reads only the buckets that hold a source key, finds the rows that really differ, and
overwrites only their buckets (dynamic partition overwrite); files of other buckets
stay as they are. So the cost follows the source, not the table, and a merge that
changes nothing writes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .upsert import merge_upsert

BUCKET = "_bucket"


class BucketedTable:
    """A table at ``path`` in ``buckets`` folders by the hash of ``keys``, which are unique and
    not NULL in it."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 64):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets

    def _bucket(self) -> Column:
        # keys as text, so that a table and its sources agree whatever their key types
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, mode: str) -> None:
        # a bucket's rows meet in one task, so each folder gets few files
        (rows.repartition(BUCKET).write.mode(mode).option("partitionOverwriteMode", "dynamic")
         .partitionBy(BUCKET).parquet(self.path))

    def create(self, rows: DataFrame) -> None:
        """Write the first state; the path must be free."""
        self._write(rows.withColumn(BUCKET, self._bucket()), "error")

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path).drop(BUCKET)

    def merge(self, source: DataFrame, update: Sequence[str]) -> list[int]:
        """INSERT ... ON DUPLICATE KEY UPDATE (see ``merge_upsert``; no ``update`` columns: insert
        if absent). ``source`` is unique on the keys and has no NULL key. Returns the buckets
        written.

        The new buckets are written to the shared scratch folder first and moved in by
        one overwrite. A run that fails can be repeated: a merge of merged rows changes
        nothing.
        """
        source = source.withColumn(BUCKET, self._bucket()).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # at most one number per bucket
            touched = sorted(r[0] for r in source.select(BUCKET).distinct().collect())
            if not touched:
                return []
            stored = self.spark.read.parquet(self.path)
            columns = [c for c in stored.columns if c != BUCKET]
            target = stored.where(F.col(BUCKET).isin(touched))
            rows = merge_upsert(target.select(*columns), source.drop(BUCKET), self.keys, update)
            rows = rows.withColumn(BUCKET, self._bucket())
            place = scratch_path(self.spark, f"merge-{uuid.uuid4().hex}")
            rows.repartition(BUCKET).write.partitionBy(BUCKET).parquet(place)
            merged = self.spark.read.schema(rows.schema).parquet(place)
            same = reduce(Column.__and__, [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in [BUCKET, *columns]])
            changed = merged.alias("n").join(target.alias("o"), same, "left_anti").select(BUCKET).distinct()
            written = sorted(r[0] for r in changed.collect())
            if written:
                self._write(merged.where(F.col(BUCKET).isin(written)).select(*columns, BUCKET), "overwrite")
            p = self.spark._jvm.org.apache.hadoop.fs.Path(place)
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
            return written
        finally:
            source.unpersist()
