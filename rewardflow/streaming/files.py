"""S4: process spend and user files as they arrive.

A file-source stream (``readStream``) replaces the per-file trigger: the
checkpoint records exactly which files were taken, ``availableNow`` runs
everything that has arrived and stops, and each micro-batch runs the batch
operators through ``foreachBatch``. The duplicate check is scoped to the
source file, as each file is its own run. Outputs are written per batch id
with overwrite, so a replayed batch rewrites the same folders.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import reject_folder
from ..operators.messages import message_json, to_messages
from ..operators.partitioning import spread
from ..operators.report import reject_rows, run_report, write_rejects_by_folder
from ..plans.spend import process_spend
from ..schemas import SPEND_SCHEMA
from ..session import LET_GO, scratch_path, settings
from ..sources.files import read_csv

#: text outputs are packed by the fast level: messages are four times, rejects twice as large as the scored rows else
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def _arrivals(spark: SparkSession, input_path: str, fmt: str, schema,
              max_files: int | None) -> DataFrame:
    """A stream of the arriving rows with their ``source_file``; for CSV of the
    arriving files' paths only, which each batch then reads by their own headers."""
    r = spark.readStream
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if fmt == "csv":
        return (r.schema("path string, modificationTime timestamp, length long, content binary")
                .format("binaryFile").load(input_path).select(F.col("path").alias("source_file")))
    return r.schema(schema).format(fmt).load(input_path).withColumn(
        "source_file", F.col("_metadata.file_path"))


def _rows(spark: SparkSession, batch: DataFrame, fmt: str, schema) -> DataFrame:
    if fmt != "csv":
        return spread(batch)
    return read_csv(spark, [r.source_file for r in batch.collect()], schema, with_source=True,
                    spread_input=True)


def spend_batch_writer(dims: dict[str, DataFrame], tenant: str, out_dir: str,
                       to_spend: Callable[[DataFrame], DataFrame] | None = None,
                       form: str = "auto", fmt: str = "csv", schema=SPEND_SCHEMA,
                       within: Sequence[str] = (), counted: bool = False):
    """The ``foreachBatch`` function. Per batch: the scored rows
    (``result/batch=<id>``), the JSON messages (``messages/batch=<id>``), one report
    row per file (``report/batch=<id>``) and the rejects of each input folder as
    headered CSV (``error/<folder>/batch=<id>``, the report's errorFileURL). Messages and
    rejects are gzip files, the scored rows Zstandard Parquet, and shuffle files are let go
    before the other outputs are written."""
    out = out_dir.rstrip("/")

    def run(batch: DataFrame, batch_id: int) -> None:
        with settings(batch.sparkSession, LET_GO):
            write(batch, batch_id)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = _rows(spark, batch, fmt, schema)
        tx = to_spend(rows) if to_spend else rows
        cached: list = []
        res = process_spend(tx, dims["card_types"], dims["exclusions"], dims["rules"],
                            dims["categories"], tenant, scope=["source_file"], form=form,
                            cache=cached, within=within, counted=counted)
        folder = F.coalesce(reject_folder("source_file"), F.lit("error/"))
        url = F.concat(F.lit(f"{out}/"), folder, F.lit(f"batch={batch_id}"))
        try:
            def put(df: DataFrame, kind: str) -> None:
                df.write.mode("overwrite").parquet(f"{out}/{kind}/batch={batch_id}", compression="zstd")
            put(res, "result")
            # the other outputs are read from the scored rows just written
            res = spark.read.schema(res.schema).parquet(f"{out}/result/batch={batch_id}")
            write_rejects_by_folder(reject_rows(res, ("source_file",)), folder, f"{out}/_rejects/batch={batch_id}",
                                    lambda of: f"{out}/{of}batch={batch_id}", options=PACKED)
            (message_json(to_messages(res, tenant)).write.mode("overwrite").options(**PACKED)
             .json(f"{out}/messages/batch={batch_id}"))
            put(run_report(res, error_path=url, by_file=True), "report")
        finally:
            for df in cached:
                df.unpersist()
    return run


def _start(src: DataFrame, run, checkpoint: str, available_now: bool) -> StreamingQuery:
    w = src.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def spend_file_stream(spark: SparkSession, input_path: str, dims: dict[str, DataFrame],
                      tenant: str, out_dir: str, checkpoint: str, fmt: str = "csv",
                      schema=SPEND_SCHEMA, to_spend: Callable[[DataFrame], DataFrame] | None = None,
                      max_files_per_trigger: int | None = None,
                      available_now: bool = True, within: Sequence[str] = (),
                      counted: bool = False) -> StreamingQuery:
    """Start the stream over ``input_path`` (a folder or glob). ``within`` (columns of what
    ``to_spend`` returns) and ``counted``: as in ``validate_spend``."""
    src = _arrivals(spark, input_path, fmt, schema, max_files_per_trigger)
    run = spend_batch_writer(dims, tenant, out_dir, to_spend, fmt=fmt, schema=schema, within=within, counted=counted)
    return _start(src, run, checkpoint, available_now)


def spend_stream_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spend stream run over the lineitem file of ``sf_dir`` (each
    lineitem micro-batch becomes spend rows through the test adapter), then
    read back. Scratch folders live under the shared checkpoint folder."""
    from ..sources import testviews as tv

    li = tv.table(spark, sf_dir, "lineitem")
    base = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    q = spend_file_stream(
        spark, f"{sf_dir.rstrip('/')}/lineitem*.parquet", tv.dims(spark), tv.TENANT,
        f"{base}/out", f"{base}/checkpoint", fmt="parquet", schema=li.schema,
        to_spend=lambda b: tv.spend_from_lineitems(spark, sf_dir, b, "_order"), within=["_order"],
        counted=tv.lie_by_order(spark, sf_dir))
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return spark.read.parquet(f"{base}/out/result")


USER_TABLES = ("card_customer", "card", "card_type", "campaign_customer")
_TARGET_KEYS = {"card_customer": "card_customers", "card": "cards", "card_type": "card_types",
                "campaign_customer": "campaign_customers"}
_ROW_KEYS = {"card_customer": ["customer_id", "tenant"], "card": ["card_id", "tenant"],
             "card_type": ["name", "tenant"], "campaign_customer": ["card_type_id", "name"]}


COMMIT = "seq long, stream string, batch_id long, folder string, base string"


class UsersState:
    """The four tables as first given plus the changes of every committed file.

    A commit has a sequence number of its own, whatever checkpoint its batch came
    from. Its changed and inserted rows lie in a folder of its own
    (``seq=<n>-<token>/<table>``), written before it. The commit itself is one small
    record, ``_log/<n>.json``, moved to its name only if no other writer has taken the
    number; a writer that comes second finds its work based on an older state and does
    it again on the newer one. A table is its base with the last change of each key
    taken. Every ``compact_every`` commits the tables are written whole once and
    become the new base.

    Moving a file to a name that must be free is atomic on HDFS; a store without that
    needs one writer at a time.
    """

    def __init__(self, spark: SparkSession, out_dir: str,
                 initial: dict[str, DataFrame] | None = None):
        self.spark, self.out, self.initial = spark, out_dir.rstrip("/"), initial

    def _exists(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def commits(self) -> list:
        """(seq, stream, batch_id, folder, base) by seq. Only a missing log means none: a
        record that cannot be read is an error."""
        if not self._exists(f"{self.out}/_log"):
            return []
        return (self.spark.read.schema(COMMIT).option("mode", "FAILFAST").json(f"{self.out}/_log")
                .orderBy("seq").collect())

    def has(self, stream: str, batch_id: int, commits: list | None = None) -> bool:
        """Whether the batch is committed already."""
        done = self.commits() if commits is None else commits
        return any((r["stream"], r["batch_id"]) == (stream, batch_id) for r in done)

    def table(self, name: str, below: int, commits: list | None = None) -> DataFrame:
        """The table as of the commits below ``below``."""
        done = [r for r in (self.commits() if commits is None else commits) if r["seq"] < below]
        bases = [r["base"] for r in done if r["base"]]
        if bases:
            base = self.spark.read.parquet(f"{self.out}/{bases[-1]}/{name}")
        elif self.initial is None:
            raise ValueError("the tables' first state is needed")
        else:
            base = self.initial[_TARGET_KEYS[name]]
        last_base = max((r["seq"] for r in done if r["base"]), default=-1)
        since = [(r["seq"], r["folder"]) for r in done if r["seq"] > last_base]
        if not since:
            return base
        columns, keys = base.columns, _ROW_KEYS[name]
        changes = reduce(DataFrame.unionByName, [
            self.spark.read.parquet(f"{self.out}/{folder}/{name}").withColumn("_seq", F.lit(n))
            for n, folder in since])
        last = (changes.groupBy(*keys).agg(F.max_by(F.struct(*columns), "_seq").alias("_row"))
                .select("_row.*"))
        return base.join(last.select(*keys), keys, "left_anti").select(*columns).unionByName(last)

    def commit(self, seq: int, stream: str, batch_id: int, folder: str, compact_every: int) -> bool:
        """Record the rows in ``folder`` as commit ``seq``. False when another writer has that
        number: nothing is changed then."""
        done = self.commits()
        if any(r["seq"] == seq for r in done):
            return False
        base = None
        if compact_every and (seq + 1) % compact_every == 0:
            # this batch's rows are written already and count as committed
            base = f"base={seq}-{uuid.uuid4().hex[:12]}"
            mine = {"seq": seq, "folder": folder, "base": None}
            for name in USER_TABLES:
                self.table(name, seq + 1, [*done, mine]).write.parquet(f"{self.out}/{base}/{name}")
        record = {"seq": seq, "stream": stream, "batch_id": batch_id, "folder": folder, "base": base}
        return self._put_if_absent(f"_log/{seq:012d}.json", json.dumps(record) + "\n")

    def _put_if_absent(self, name: str, text: str) -> bool:
        """Write a file whole under a name that must be free; False when it is taken."""
        hadoop, conf = self.spark._jvm.org.apache.hadoop.fs, self.spark._jsc.hadoopConfiguration()
        place = hadoop.Path(f"{self.out}/{name}")
        fs = place.getFileSystem(conf)
        place = place.makeQualified(fs.getUri(), fs.getWorkingDirectory())
        part = hadoop.Path(place.getParent(), f".{uuid.uuid4().hex}")  # readers skip hidden files
        stream = fs.create(part, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        kind = getattr(hadoop, "Options$Rename")
        free = self.spark.sparkContext._gateway.new_array(kind, 1)
        free[0] = kind.NONE
        try:
            hadoop.FileContext.getFileContext(place.toUri(), conf).rename(part, place, free)
            return True
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in error.java_exception.getClass().getName():
                raise
            fs.delete(part, False)
            return False


def merge_users_file(state: UsersState, users: DataFrame, folder: str | None, tenant: str, stream: str,
                     batch_id: int, reward_types: dict | None = None, order: Sequence[str] = (),
                     keep: str = "first", compact_every: int = 50, attempts: int = 20) -> int:
    """Merge one file's users into the tables and commit; the number it got (the earlier one
    when the batch was committed before). ``folder``: the file's path, for its rejects."""
    from ..plans.users import write_users_run

    for _ in range(attempts):
        done = state.commits()
        for r in done:
            if (r["stream"], r["batch_id"]) == (stream, batch_id):
                return r["seq"]
        seq = done[-1]["seq"] + 1 if done else 0
        name = f"seq={seq}-{uuid.uuid4().hex[:12]}"
        place = f"{state.out}/{name}"
        targets = {_TARGET_KEYS[t]: state.table(t, seq, done) for t in USER_TABLES}
        write_users_run(state.spark, users, tenant, targets, place, reward_types, order, keep, changed_only=True)
        (state.spark.read.parquet(f"{place}/rejects").withColumn("reject_folder", reject_folder(F.lit(folder)))
         .write.parquet(f"{place}/rejects_by_folder"))
        if state.commit(seq, stream, batch_id, name, compact_every):
            return seq
    raise RuntimeError(f"no commit in {attempts} attempts: too many writers at a time")


def users_file_stream(spark: SparkSession, input_path: str, tenant: str,
                      initial_targets: dict[str, DataFrame], out_dir: str, checkpoint: str,
                      reward_types: dict | None = None, fmt: str = "csv", schema=None,
                      to_users: Callable[[DataFrame], DataFrame] | None = None,
                      available_now: bool = True, order: Sequence[str] = (), keep: str = "first",
                      compact_every: int = 50) -> StreamingQuery:
    """Merge each arriving user file into the four tables.

    One file per micro-batch, in arrival order, so later files update earlier ones.
    A batch reads the tables as of the commits before it (``UsersState``), writes the
    rows it changes or inserts and its rejects under ``<out_dir>/seq=<n>-<token>/`` and
    then commits; what it writes follows the file, not the tables. A batch that was
    committed is not done again, a new checkpoint goes on from the last commit, and of two
    writers that finish at once the second works again on the first one's state. Rejects
    carry the reject folder of their file.
    """
    from ..schemas import USER_SCHEMA

    state, columns = UsersState(spark, out_dir, initial_targets), schema or USER_SCHEMA

    def run(batch: DataFrame, batch_id: int) -> None:
        if state.has(checkpoint, batch_id):
            return
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            first = batch.select("source_file").first()
            folder = None if first is None else first["source_file"]
            rows = _rows(spark, batch, fmt, columns)
            users = to_users(rows) if to_users else rows.drop("source_file")
            merge_users_file(state, users, folder, tenant, checkpoint, batch_id, reward_types, order, keep,
                             compact_every)
        finally:
            batch.unpersist()

    return _start(_arrivals(spark, input_path, fmt, columns, 1), run, checkpoint, available_now)


def latest_users_snapshot(spark: SparkSession, out_dir: str,
                          initial_targets: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The four tables as of the last commit; ``initial_targets`` as given to the
    stream (not needed once the tables have been compacted)."""
    state = UsersState(spark, out_dir, initial_targets)
    if not state.commits():
        raise ValueError("no committed batch")
    return {t: state.table(t, 1 << 62) for t in USER_TABLES}


def users_stream_result(spark: SparkSession, sf_dir: str, table: str = "campaign_customer") -> DataFrame:
    """The users stream run over the orders of ``sf_dir`` as two files (each batch
    becomes user rows through the test adapter), merged into the test target
    tables; returns one table as of the last commit."""
    from ..sources import testviews as tv

    o = tv.table(spark, sf_dir, "orders")
    base = scratch_path(spark, f"ustream-{uuid.uuid4().hex}")
    targets = {"card_customers": tv.card_customers_target(spark, sf_dir),
               "cards": tv.cards_target(spark, sf_dir),
               "card_types": tv.campaign_card_types(spark),
               "campaign_customers": tv.campaign_customers_target(spark, sf_dir)}
    # two files, so the second batch reads what the first one changed
    halves = f"{base}/in"
    for k in range(2):
        o.where(F.floor(F.col("o_orderkey") / 6) % 2 == k).coalesce(1).write.mode("append").parquet(halves)
    q = users_file_stream(
        spark, halves, tv.TENANT, targets, f"{base}/out",
        f"{base}/checkpoint", fmt="parquet", schema=o.schema,
        to_users=lambda b: tv.users_from_orders(spark, sf_dir, b))
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return latest_users_snapshot(spark, f"{base}/out", targets)[table]
