"""Helpers shared by the training-data operators."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rewardflow.session import scratch_path, settle

NO_ID = -(2 ** 63)
#: seconds that finished plans are given to be let go
SETTLE = 0.25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by a path that only Spark needs to read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Shared:
    """A broadcast object of this package's classes, pickled by value like the
    functions, so the executors need no copy of the package. ``value`` unpickles it:
    take it once a task."""

    def __init__(self, spark: SparkSession, value):
        self._held = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        return pickle.loads(self._held.value)

    def release(self) -> None:
        """Let executors drop it; the driver sends it again where it is still asked for."""
        self._held.unpersist()


class Scratch:
    """Tables written below the session's shared checkpoint folder.

    A written table cuts the lineage and survives the loss of any executor.
    ``drop`` removes one that no later plan reads; the others stay until the
    owner of the checkpoint folder clears it, because the frame that an
    operator returns is lazy and may still read them.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")

    def write(self, df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path, compression=compression)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(conf).delete(path, True)

    def settle(self) -> None:
        """Let Spark's cleaner remove shuffle files of plans that are done."""
        settle(self.spark, SETTLE)


def id_crc(mod: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``mod``. A NULL id counts as empty text (0)."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % mod


def text_bytes(text: str = "text") -> Column:
    """The text in UTF-8; a NULL text is empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")


def whole_groups(frames: Iterator, keys: list[str], enough: int = 200_000) -> Iterator:
    """Regroup the pandas batches of a partition sorted by ``keys`` into frames of
    about ``enough`` rows that never cut a group of equal keys."""
    import pandas as pd

    held: list = []
    rows = 0
    for frame in frames:
        if not len(frame):
            continue
        held.append(frame)
        rows += len(frame)
        if rows < enough:
            continue
        whole = pd.concat(held, ignore_index=True)
        last = (whole[keys] == whole[keys].iloc[-1]).all(axis=1).to_numpy()
        cut = len(whole) if not last.any() else int(last.argmax())
        if cut:
            yield whole.iloc[:cut]
        held, rows = [whole.iloc[cut:]], len(whole) - cut
    if held and rows:
        yield pd.concat(held, ignore_index=True)
