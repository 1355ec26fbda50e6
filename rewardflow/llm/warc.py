"""WARC records in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each holding whole WARC
records, and a skippable frame at its end that lists every frame's compressed
and plain size (the Zstandard seekable format). The index maps a record id to a
bundle, a frame and the record's offset inside the plain frame, so one record
costs one range read. Bundles are written by the tasks straight to the shared
folder under fresh names; the index, written through Spark's committer, names
the bundles of committed tasks only, so a retried or duplicated task leaves at
most a file that nothing refers to.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rewardflow.llm.common import Scratch, text_bytes

# fixed values of the Zstandard seekable format
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 256 << 20
LEAST_SHARED = 100
#: compressed bytes of frames that one task reads back
TASK_BYTES = 8 << 20
RECORD = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, " \
         "record_type string, refers_to long"
INDEX = "record_id string, bundle string, frame long, frame_offset long, frame_bytes long, " \
        "offset long, bytes long"


def store(uri: str):
    """The Arrow file system of a folder's URI, and the path in it."""
    from pyarrow import fs

    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    if re.match(r"file:/[^/]", uri):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


def record_id(page_id) -> str:
    return f"<urn:page:{'' if page_id is None or pd.isna(page_id) else int(page_id)}>"


def encode_record(page_id, url, payload, payload_bytes, payload_digest, record_type,
                  refers_to) -> bytes:
    head = ["WARC/1.1", f"WARC-Type: {record_type}", f"WARC-Record-ID: {record_id(page_id)}",
            "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(
            r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append(f"WARC-Payload-Digest: sha256:{payload_digest}")
    if record_type == "revisit":
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"X-Payload-Length: {payload_bytes}"]
        payload = b""
    head += ["Content-Type: text/html", f"Content-Length: {len(payload)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def decode_records(plain: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of each record of a plain frame."""
    at = 0
    while at < len(plain):
        end = plain.index(b"\r\n\r\n", at)
        lines = plain[at:end].decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no WARC record at {at}")
        head = dict(line.split(": ", 1) for line in lines[1:])
        start = end + 4
        stop = start + int(head["Content-Length"])
        yield at, head, plain[start:stop]
        at = stop + 4


class BundleWriter:
    """Writes one bundle; ``add`` and ``close`` return the index rows of frames that are done."""

    def __init__(self, folder: str, frame_bytes: int = FRAME_BYTES):
        import zstandard

        self.uri = f"{folder.rstrip('/')}/{uuid.uuid4().hex}.warc.zst"
        files, path = store(self.uri)
        files.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.out = files.open_output_stream(path, compression=None)
        self.zstd, self.frame_bytes = zstandard.ZstdCompressor(level=3), frame_bytes
        self.sizes: list[tuple[int, int]] = []
        self.at = 0
        self._clear()

    def _clear(self) -> None:
        self.held, self.plain, self.rows = [], 0, []

    def add(self, name: str, record: bytes) -> list[tuple]:
        self.rows.append((name, self.plain, len(record)))
        self.held.append(record)
        self.plain += len(record)
        return self._frame() if self.plain >= self.frame_bytes else []

    def _frame(self) -> list[tuple]:
        if not self.held:
            return []
        packed = self.zstd.compress(b"".join(self.held))
        self.out.write(packed)
        rows = [(name, self.uri, len(self.sizes), self.at, len(packed), offset, n)
                for name, offset, n in self.rows]
        self.sizes.append((len(packed), self.plain))
        self.at += len(packed)
        self._clear()
        return rows

    def close(self) -> list[tuple]:
        rows = self._frame()
        table = b"".join(struct.pack("<II", *s) for s in self.sizes)
        table += struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.out.close()
        return rows


def seek_table(uri: str) -> list[tuple[int, int, int]]:
    """(offset, compressed bytes, plain bytes) of every frame, read from the footer."""
    files, path = store(uri)
    with files.open_input_file(path) as f:
        end = f.size()
        f.seek(end - 9)
        n, _, magic = struct.unpack("<IBI", f.read(9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError(f"{uri} has no seek table")
        f.seek(end - 9 - 8 * n)
        out, at = [], 0
        for packed, plain in struct.iter_unpack("<II", f.read(8 * n)):
            out.append((at, packed, plain))
            at += packed
    return out


def read_frame(uri: str, offset: int, packed: int, plain: int = 0) -> bytes:
    """A plain frame; its own header says its size when ``plain`` does not."""
    import zstandard

    files, path = store(uri)
    with files.open_input_file(path) as f:
        f.seek(offset)
        return zstandard.ZstdDecompressor().decompress(f.read(packed), max_output_size=plain)


def read_record(row) -> tuple[dict[str, str], bytes]:
    """Headers and block of one index row, by a single range read."""
    import zstandard

    files, path = store(row["bundle"])
    with files.open_input_file(path) as f:
        f.seek(row["frame_offset"])
        plain = zstandard.ZstdDecompressor().decompress(f.read(row["frame_bytes"]))
    _, head, block = next(decode_records(plain[row["offset"]:row["offset"] + row["bytes"]]))
    return head, block


def with_record_types(pages: DataFrame, scratch: Scratch, least: int = LEAST_SHARED) -> DataFrame:
    """Pages as records: of equal payloads of ``least`` bytes or more the smallest
    page_id is the response and the others revisit it. Rows that repeat the
    smallest page_id are responses too; a NULL page_id is never the smallest
    unless all are NULL. A NULL html is an empty payload."""
    pages = pages.select("page_id", "url", text_bytes("html").alias("payload"))
    digest = F.sha2("payload", 256)
    pages = pages.withColumns({"payload_bytes": F.length("payload").cast("long"),
                               "payload_digest": digest})
    shared = scratch.write(
        pages.where(F.col("payload_bytes") >= least).groupBy("payload_digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and first is not null").select("payload_digest", "first"), "shared")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return pages.join(shared, "payload_digest", "left").select(
        "page_id", "url", F.when(~again, F.col("payload")).alias("payload"), "payload_bytes",
        "payload_digest", F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first")).alias("refers_to"))


def write_bundles(records: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES,
                  bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Lazy frame that writes the bundles and returns the index; write it as a table once."""
    fields = [x.split()[0] for x in RECORD.split(", ")]
    names = [x.split()[0] for x in INDEX.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        writer = None
        for f in frames:
            rows = []
            for values in zip(*(f[c] for c in fields)):
                if writer is None:
                    writer = BundleWriter(folder, frame_bytes)
                rows += writer.add(record_id(values[0]), encode_record(*values[:3], int(values[3]), *values[4:]))
                if writer.at >= bundle_bytes:
                    rows += writer.close()
                    writer = None
            yield pd.DataFrame(rows, columns=names)
        if writer is not None:
            yield pd.DataFrame(writer.close(), columns=names)

    return records.select(*fields).mapInPandas(run, INDEX)


RECORD_BACK = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _page(urn: str) -> int | None:
    return int(urn[10:-1]) if len(urn) > 11 else None


def _row(where: str, head: dict[str, str], block: bytes) -> tuple:
    """A record as a row. A response's digest and size are taken from its block and must
    equal its header; a revisit has those of the payload it refers to."""
    digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
    kind, refers, size = head["WARC-Type"], None, len(block)
    if kind == "revisit":
        refers, size = _page(head["WARC-Refers-To"]), int(head["X-Payload-Length"])
    elif hashlib.sha256(block).hexdigest() != digest:
        raise ValueError(f"{where}: {head['WARC-Record-ID']} does not match its digest")
    return _page(head["WARC-Record-ID"]), size, digest, kind, refers


def _rows(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[x.split()[0] for x in RECORD_BACK.split(", ")])
    return out.astype({"page_id": "Int64", "refers_to": "Int64"})


def read_by_index(index: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Every record of the index: a frame is fetched by one range read and its records are cut
    out at their offsets; a record under another id than the index says is an error.

    Frames are dealt over as many tasks as their compressed bytes need (``task_bytes``
    each), by their place, so a bundle is read by many tasks.
    """
    place = ["bundle", "frame", "frame_offset", "frame_bytes"]
    # a frame holds some hundred records; a long record has a frame of its own
    frames = index.groupBy(*place).agg(F.collect_list(F.struct("record_id", "offset", "bytes")).alias("records"))
    total = index.select(*place).distinct().agg(F.sum("frame_bytes")).first()[0] or 0

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in parts:
            for uri, at, packed, records in zip(f["bundle"], f["frame_offset"], f["frame_bytes"], f["records"]):
                plain, rows = read_frame(uri, at, packed), []
                for r in records:
                    _, head, block = next(decode_records(plain[r["offset"]:r["offset"] + r["bytes"]]))
                    if head["WARC-Record-ID"] != r["record_id"]:
                        raise ValueError(f"{uri}: {head['WARC-Record-ID']} stands where {r['record_id']} should")
                    rows.append(_row(uri, head, block))
                yield _rows(rows)

    return frames.repartition(total // task_bytes + 1, "bundle", "frame").mapInPandas(run, RECORD_BACK)


def read_bundles(bundles: DataFrame, tasks: int) -> DataFrame:
    """Every record of the ``bundle`` files without an index: frames from the footers, dealt over
    ``tasks`` tasks, then one range read a frame."""
    def frames_of(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in parts:
            rows = [(uri, *frame) for uri in f["bundle"] for frame in seek_table(uri)]
            yield pd.DataFrame(rows, columns=["bundle", "at", "packed", "plain"])

    def records_of(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in parts:
            for uri, at, packed, plain in zip(f["bundle"], f["at"], f["packed"], f["plain"]):
                yield _rows([_row(uri, head, block) for _, head, block in
                             decode_records(read_frame(uri, at, packed, plain))])

    frames = bundles.mapInPandas(frames_of, "bundle string, at long, packed long, plain long")
    return frames.repartition(tasks, "bundle", "at").mapInPandas(records_of, RECORD_BACK)


def archive_pages(spark: SparkSession, pages: DataFrame, least: int = LEAST_SHARED,
                  frame_bytes: int = FRAME_BYTES) -> tuple[DataFrame, DataFrame]:
    """Writes every page as a WARC record; returns (index, records read back).

    Only page_id, url and html are read, so other columns do not matter. A payload is one
    record in one frame however long it is, and stands in memory once as text, record and
    frame. Repeated rows are records of their own; without rows both frames are empty.
    """
    scratch = Scratch(spark, "warc")
    records = with_record_types(pages, scratch, least)
    index = scratch.write(write_bundles(records, f"{scratch.root}/bundles", frame_bytes), "index")
    return index, read_by_index(index)


ORACLE = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n,
                  sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
SELECT p.page_id, p.n::BIGINT AS payload_bytes, p.d AS payload_digest,
       CASE WHEN f.first <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first <> p.page_id THEN f.first END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d AND p.n >= 100
"""
