"""S2/S3: JDBC table scans. Operators take DataFrames, so a JDBC table, a
parquet table and a test view are interchangeable."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, user: str, password: str, table: str, driver: str | None = None) -> dict:
    opts = {"url": url, "user": user, "password": password, "dbtable": table}
    if driver:
        opts["driver"] = driver
    return opts


def read_table(spark: SparkSession, options: dict, partition_column: str | None = None,
               lower: int | None = None, upper: int | None = None,
               num_partitions: int | None = None, fetch_size: int = 10000) -> DataFrame:
    """One JDBC table. Give ``partition_column`` with bounds to read in
    parallel ranges; filters applied to the result are pushed to the DB."""
    r = spark.read.format("jdbc").options(**options).option("fetchsize", fetch_size)
    if partition_column is not None:
        r = (r.option("partitionColumn", partition_column)
              .option("lowerBound", lower).option("upperBound", upper)
              .option("numPartitions", num_partitions or 8))
    return r.load()


def write_table(df: DataFrame, options: dict, mode: str = "append", batch_size: int = 10000,
                num_partitions: int | None = None) -> None:
    """Write a DataFrame to a JDBC table in batches (e.g. a staging table that
    the database then merges from, instead of one statement per row).
    ``num_partitions`` caps the concurrent connections."""
    w = df.write.format("jdbc").options(**options).option("batchsize", batch_size).mode(mode)
    if num_partitions:
        w = w.option("numPartitions", num_partitions)
    w.save()
