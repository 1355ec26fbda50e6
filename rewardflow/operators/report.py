"""K1 reject file and K8 run report."""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.text import base_name, mask_pan
from ..schemas import SPEND_COLUMNS


def reject_rows(result: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Rejected spend rows with their reason; the card number keeps only its
    last four digits."""
    cols = [mask_pan("card_pan").alias("card_pan") if c == "card_pan" else F.col(c)
            for c in SPEND_COLUMNS]
    return (result.where(F.col("reject_reason").isNotNull())
            .select(*cols, *extra, F.col("reject_reason")))


def write_rejects(rejects: DataFrame, path: str, single_file: bool = False) -> None:
    """One headered CSV folder per run (the caller writes it only when there
    are rejects). ``single_file`` writes one part file, as a person opening
    the folder expects; it funnels all rejects through one task, so keep it
    for runs whose rejects are known to be few."""
    out = rejects.coalesce(1) if single_file else rejects
    out.write.mode("overwrite").option("header", True).csv(path)


def write_rejects_by_folder(rejects: DataFrame, folder: Column, staging: str, target,
                            max_records: int = 5_000_000, options: dict[str, str] | None = None) -> None:
    """The rejects of every folder as headered CSV, in one job however many folders there are:
    one write partitioned by folder below ``staging``, whose parts are then moved to
    ``target(folder)`` (a path). A folder with many rejects is written by many tasks, in
    files of at most ``max_records``; folders without rejects get none. ``options`` are
    those of Spark's CSV writer. Run again, it replaces what is there."""
    spark = rejects.sparkSession
    (rejects.withColumn("_folder", folder).write.mode("overwrite").option("header", True)
     .option("maxRecordsPerFile", max_records).options(**(options or {})).partitionBy("_folder").csv(staging))
    path = spark._jvm.org.apache.hadoop.fs.Path
    root = path(staging)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for part in fs.listStatus(root):
        name = part.getPath().getName()
        if part.isDirectory() and name.startswith("_folder="):
            place = path(target(unquote(name.split("=", 1)[1])))
            fs.delete(place, True)
            fs.mkdirs(place.getParent())
            if not fs.rename(part.getPath(), place):
                raise OSError(f"cannot move {part.getPath()} to {place}")
    fs.delete(root, True)


def run_report(result: DataFrame, filename: str | None = None, error_path: str | Column = "",
               by_file: bool = False) -> DataFrame:
    """Rows, processed (accepted) and rejected counts in one aggregate; the
    reject folder is reported only when something was rejected.

    ``by_file`` groups by ``source_file`` (one report per input file); ``error_path``
    may then be a column of it."""
    rejected = F.col("reject_reason").isNotNull()
    aggs = [F.count(F.lit(1)).alias("numberOfRows"),
            F.count_if(~rejected).alias("numberOfProcessed"),
            F.count_if(rejected).alias("numberOfRejected")]
    if by_file:
        r = result.groupBy("source_file").agg(*aggs).withColumn("filename", base_name("source_file"))
    else:
        r = result.agg(*aggs).withColumn("filename", F.lit(filename).cast("string"))
    url = F.when(F.col("numberOfRejected") > 0, error_path if isinstance(error_path, Column) else F.lit(error_path)).otherwise(F.lit(""))
    return r.select("filename", "numberOfRows", "numberOfProcessed", "numberOfRejected",
                    url.alias("errorFileURL"))


def observed(result: DataFrame) -> tuple[DataFrame, Observation]:
    """The result with its rows, accepted and rejected rows counted while it is written: run one
    action on the frame (a write), then read the report with ``observed_report``. The
    counts are taken in the tasks of the write, so no pass or held copy is needed."""
    counts = Observation(f"rows-{uuid.uuid4().hex}")
    rejected = F.col("reject_reason").isNotNull()
    return result.observe(counts, F.count(F.lit(1)).alias("numberOfRows"),
                          F.count_if(~rejected).alias("numberOfProcessed"),
                          F.count_if(rejected).alias("numberOfRejected")), counts


def observed_report(spark: SparkSession, counts: Observation, filename: str | None = None,
                    error_path: str = "") -> DataFrame:
    """``run_report`` from the counts of a finished write."""
    n = counts.get
    row = (filename, n["numberOfRows"], n["numberOfProcessed"], n["numberOfRejected"],
           error_path if n["numberOfRejected"] else "")
    return spark.createDataFrame([row], "filename string, numberOfRows long, numberOfProcessed long, "
                                        "numberOfRejected long, errorFileURL string")
