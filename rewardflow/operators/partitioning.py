"""Input parallelism."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Round-robin ``df`` over the cluster when it arrives in fewer partitions
    than there are task slots (one large unsplittable file, one row group, a
    small CSV). A many-file input is returned unchanged, so it is never
    shuffled for this. Round-robin ignores key values, so no key can skew it.
    """
    target = partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df
