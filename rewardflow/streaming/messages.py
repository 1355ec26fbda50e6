"""K7: a message sink that can be rerun.

Runs that overlap or are repeated write the same messages again. This stream reads the
written messages as they arrive and passes each message key on once: the keys seen
are streaming state, kept until the watermark has passed the time within which a
repeat can come. State and outputs follow the checkpoint, so a restart neither loses nor
repeats a message.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..session import LET_GO, delete, scratch_path, settings, settle

#: keys seen lie in an embedded store on an executor's disk, with so many MB of memory in all, not in its heap
STORE = {"spark.sql.streaming.stateStore.providerClass":
         "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
         "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
         "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "300",
         # a count of all keys would cost a look-up a key
         "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false"}


def distinct_messages_stream(spark: SparkSession, input_path: str, schema: T.StructType, out_path: str,
                             checkpoint: str, key: str = "messageKey", within: str = "7 days", fmt: str = "parquet",
                             max_files_per_trigger: int | None = None, available_now: bool = True) -> StreamingQuery:
    """Start the stream from the message files under ``input_path`` to Parquet files under
    ``out_path``, each ``key`` once.

    A message's time is when its file was written. A repeat within ``within`` of the first
    is dropped; what comes later than that is taken as new. NULL keys count as one key. The
    keys are dealt by hash, and a task has the keys of its share in the state store, not
    the messages; the store is on disk (``STORE``; a checkpoint begun with another one goes
    on with that).
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.load(input_path).select("*", F.col("_metadata.file_modification_time").alias("_arrived"))
    once = src.withWatermark("_arrived", within).dropDuplicatesWithinWatermark([key]).drop("_arrived")
    out = (once.writeStream.outputMode("append").format("parquet").option("path", out_path)
           .option("checkpointLocation", checkpoint).option("compression", "zstd"))
    out = out.trigger(availableNow=True) if available_now else out.trigger(processingTime="30 seconds")
    with settings(spark, STORE | LET_GO):  # a stream keeps what holds when it starts
        return out.start()


def distinct_messages(spark: SparkSession, parts: list[DataFrame]) -> DataFrame:
    """The stream run over message batches that may repeat one another, one micro-batch
    each at least, then read back. Scratch folders lie under the shared checkpoint folder;
    a batch's input goes when the stream has taken it."""
    base = scratch_path(spark, f"messages-{uuid.uuid4().hex}")

    def arrive(k: int) -> None:
        with settings(spark, LET_GO):
            parts[k].write.mode("append").parquet(f"{base}/in", compression="zstd")
    return _passed_on(spark, base, parts[0].schema, len(parts), arrive)


def distinct_dealt_messages(spark: SparkSession, messages: DataFrame, batches: Column, n: int) -> DataFrame:
    """``distinct_messages`` of ``n`` batches that come from one frame, which is computed once:
    ``batches`` are the numbers of the batches that a message is in. They are written
    together and their files arrive batch by batch."""
    base = scratch_path(spark, f"messages-{uuid.uuid4().hex}")
    # with a writer a batch rows need not be sorted by batch; past as many they are
    with settings(spark, LET_GO | {"spark.sql.maxConcurrentOutputFileWriters": "16"}):
        (messages.withColumn("_arrives", F.explode(batches)).write.partitionBy("_arrives")
         .parquet(f"{base}/sent", compression="zstd"))
    settle(spark)
    path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    fs = path(base).getFileSystem(conf)

    def arrive(k: int) -> None:
        place, sent = path(f"{base}/in"), path(f"{base}/sent/_arrives={k}")
        fs.mkdirs(place)
        for f in fs.listStatus(sent) if fs.exists(sent) else ():
            # a task's files have one name in all batches, and the stream knows a file by its path
            if not fs.rename(f.getPath(), path(place, f"batch-{k}-{f.getPath().getName()}")):
                raise OSError(f"cannot move {f.getPath()} to {place}")
    out = _passed_on(spark, base, messages.schema, n, arrive)
    delete(spark, f"{base}/sent")
    return out


def _passed_on(spark: SparkSession, base: str, schema: T.StructType, n: int, arrive: Callable[[int], None]) -> DataFrame:
    """The stream run after each of ``n`` batches has arrived below ``base``; what it passed on."""
    for k in range(n):
        arrive(k)
        query = distinct_messages_stream(spark, f"{base}/in", schema, f"{base}/out", f"{base}/checkpoint")
        query.awaitTermination()
        if query.exception():
            raise query.exception()
        del query
        delete(spark, f"{base}/in")
        settle(spark)
    return spark.read.schema(schema).parquet(f"{base}/out")
