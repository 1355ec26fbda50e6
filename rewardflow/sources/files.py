"""S1: header CSV scans, every column text; columns found by their header name."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.partitioning import spread

#: files whose headers are read one by one
FEW_FILES = 4
BAD, R_BAD_LINE = "_bad_line", "Malformed line"


def list_files(spark: SparkSession, path: str | list[str]) -> list[str]:
    """The files of a path, folder or glob (paths only; contents are not read)."""
    found = spark.read.format("binaryFile").load(path).select("path").collect()
    return sorted(r.path for r in found)


def _one_form(path: str) -> str:
    """A path with one slash after its scheme, as different readers write it differently."""
    return re.sub("^([A-Za-z][A-Za-z0-9+.-]*):/+", r"\1:/", path)


def _header_names(line: str) -> tuple[str, ...]:
    """Column names of a header line: blank ones and repeated ones are told apart by their place."""
    names = next(csv.reader([line.lstrip("\ufeff")], escapechar="\\"))
    seen = [n.lower() for n in names]
    return tuple(f"_c{i}" if not n.strip() else f"{n}{i}" if seen.count(n.lower()) > 1 else n
                 for i, n in enumerate(names))


def headers(spark: SparkSession, files: list[str]) -> dict[tuple[str, ...], list[str]]:
    """The files by their header. A few files are asked one by one (each reads a line); many are
    read as lines in one job, of which only the first block of each file counts, and
    come to the driver as one path each."""
    if len(files) <= FEW_FILES:
        found: dict[tuple[str, ...], list[str]] = {}
        for file in files:
            found.setdefault(tuple(spark.read.option("header", True).csv(file).columns), []).append(file)
        return found
    lines = spark.read.text(files).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value",
        F.monotonically_increasing_id().alias("at"))
    first = (lines.where("block = 0 and trim(value) <> ''").groupBy("file")
             .agg(F.min_by("value", "at").alias("line")))
    by_name = {_one_form(f): f for f in files}
    found = {}
    for r in first.groupBy("line").agg(F.collect_list("file").alias("files")).collect():
        found.setdefault(_header_names(r.line), []).extend(
            by_name.pop(_one_form(f), None) or by_name.pop(_one_form(unquote(f))) for f in r.files)
    if by_name:
        found.setdefault((), []).extend(by_name.values())  # files without a line
    return {h: sorted(f) for h, f in sorted(found.items())}


def _scan(spark: SparkSession, path: str | list[str], schema: T.StructType | None, required: Iterable[str] | None,
          with_source: bool, bad: str | None) -> DataFrame:
    by_header = headers(spark, list_files(spark, path))
    names = list(schema.names) if schema is not None else list(next(iter(by_header), ()))
    parts = []
    for header, files in by_header.items():
        missing = [c for c in [*names, *(required or ())] if c not in header]
        if missing:
            raise ValueError(f"CSV header of {files[0]} lacks columns: {missing}")
        text = T.StructType([T.StructField(c, T.StringType()) for c in [*header, *[bad] * bool(bad)]])
        reader = spark.read.option("header", True).option("mode", "PERMISSIVE").schema(text)
        if bad:  # a line is only known to be malformed when all its fields are parsed
            reader = reader.option("columnNameOfCorruptRecord", bad).option("columnPruning", False)
        extra = [F.col("_metadata.file_path").alias("source_file")] if with_source else []
        parts.append(reader.csv(files).select(*[F.col(f"`{c}`") for c in names], *extra,
                                              *[F.col(f"`{bad}`")] * bool(bad)))
    if not parts:
        none = [*names, *["source_file"] * with_source, *[bad] * bool(bad)]
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in none]))
    return reduce(DataFrame.unionByName, parts)


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None,
             required: Iterable[str] | None = None, with_source: bool = False,
             spread_input: bool = False) -> DataFrame:
    """Read headered CSV as strings.

    Columns are found by name in each file's own header: their order is free,
    other columns are ignored, and a file that lacks one of the ``schema``'s (or
    ``required``) names is an error. Without a ``schema`` the first header's columns
    are returned. Files with the same header are read together, and the headers of
    many files are found in one job (``headers``). ``with_source``
    adds ``source_file`` from the file metadata. ``spread_input`` spreads a file
    read in fewer splits than task slots over the cluster. A line with too few fields
    has NULLs for the rest, one with too many loses them; ``read_csv_checked`` sorts them out.
    """
    df = _scan(spark, path, schema, required, with_source, None)
    return spread(df) if spread_input else df


def read_csv_checked(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None,
                     required: Iterable[str] | None = None, with_source: bool = False,
                     spread_input: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows as ``read_csv``, dead letters): lines with too few or too many fields or an open
    quote are no rows but dead letters (source_file, line, reject_reason). Every field of
    a line is parsed for this. Both frames read the files."""
    found = _scan(spark, path, schema, required, True, BAD)
    # the parser does not allow to ask for the malformed line alone, so a count asks for
    # the first field too
    asked = F.coalesce(F.length(F.col(f"`{found.columns[0]}`")), F.lit(0)) >= 0
    good = found.where(F.col(BAD).isNull() & asked).drop(BAD, *["source_file"] * (not with_source))
    bad = found.where(F.col(BAD).isNotNull() & asked).select("source_file", F.col(BAD).alias("line"),
                                                             F.lit(R_BAD_LINE).alias("reject_reason"))
    return (spread(good) if spread_input else good), bad
