"""CSV and Parquet readers that resolve columns by name."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Iterator, Mapping
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairlead.schemas import RAW_TRADE, conform

# Format of the published files (fixed values): Latin-1, semicolons, quoted, with header.
CSV_FORMAT = {
    "sep": ";",
    "header": "true",
    "encoding": "ISO-8859-1",
    "quote": '"',
    "escape": '"',
}

# Dataset of a path: the published file, or the folder of that name.
DATASET = r"^(.*?[A-Z_]+(?:_[0-9]{4})?\.csv)"

# Column holding the published file a row came from, e.g. EXP_2020.
SOURCE = "arquivo"


# Text of a line that cannot be read by the schema of its file, where asked for.
CORRUPT = "linha_com_erro"


class BadHeader(ValueError):
    """A published file without a column of its contract, or with part files that disagree."""


class MissingColumns(BadHeader):
    """A published file without a column of its contract."""


def first_lines(spark: SparkSession, paths: Iterable[str]) -> dict[str, list[list[str]]]:
    """The distinct headers of each CSV dataset, over all its files; none for a dataset without lines.

    One job for all datasets: every file is one task that stops after its first line, so
    little is read of a file of any size. A row per file comes back.
    """
    paths = list(paths)
    if not paths:
        return {}
    # A session of its own: its settings give each file a partition of its own, uncut.
    apart = spark.newSession()
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        apart.conf.set(key, str(1 << 44))
    apart.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    text = apart.read.text(paths)
    lines = text.select("_metadata.file_path", "_metadata.file_block_start", F.col("value").cast("binary"))
    begun = lines.where("file_block_start = 0").select(F.col("file_path").alias("path"), "value")

    def headers(first_only: bool) -> list[Row]:
        found = begun.mapInArrow(lambda batches: _first_lines(batches, first_only), "path string, value binary")
        return found.collect()

    rows = headers(True)
    if len(rows) < len(text.inputFiles()):
        # Files without lines, or a session that packs several files into a task: no task may stop early.
        rows = headers(False)
    found: dict[str, set[tuple[str, ...]]] = {_bare(path): set() for path in paths}
    for row in rows:
        dataset = re.match(DATASET, unquote(row["path"]))[1]
        line = bytes(row["value"]).decode(CSV_FORMAT["encoding"])
        found[_bare(dataset)].add(tuple(next(csv.reader([line], delimiter=CSV_FORMAT["sep"]))))
    return {path: [list(header) for header in sorted(found[_bare(path)])] for path in paths}


def _first_lines(batches: Iterator[pa.RecordBatch], first_only: bool) -> Iterator[pa.RecordBatch]:
    """The first line of each file that is not blank, or of the first file only."""
    seen: set[str] = set()
    for batch in batches:
        for row, (path, line) in enumerate(zip(batch["path"].to_pylist(), batch["value"].to_pylist())):
            if path not in seen and line.strip():
                seen.add(path)
                yield batch.slice(row, 1)
                if first_only:
                    return


def _bare(path: str) -> str:
    """A path without scheme, host and last slash, as listings and queries spell these differently."""
    return re.sub(r"^[a-z0-9]+:(//[^/]*)?", "", path).rstrip("/")


def header_fault(path: str, headers: list[list[str]], schema: T.StructType) -> BadHeader | None:
    """Why a dataset with these headers cannot be read by name; None if it can."""
    if len(headers) > 1:
        return BadHeader(f"{path} has part files with different headers")
    header = headers[0] if headers else []
    lacking = [name for name in schema.names if name not in header]
    if lacking:
        return MissingColumns(f"{path} lacks {', '.join(lacking)}")
    if len({name.lower() for name in header}) < len(header):
        return BadHeader(f"{path} repeats a column name")
    return None


def read_trade_csv(
    spark: SparkSession,
    paths: Iterable[str],
    direction: str,
    headers: Mapping[str, list[list[str]]] | None = None,
    mark_errors: bool = False,
) -> DataFrame:
    """Raw trade rows of CSV files, typed, with their ``SOURCE``.

    The reader matches a given schema by position, so files are grouped by header and
    each group gets a schema in its own column order; ``enforceSchema=false`` makes a
    header that differs inside a group an error instead of swapped data. There is one
    scan per distinct header, not per file. A malformed row or number fails the read, or is
    marked by its text in ``CORRUPT`` if ``mark_errors``; a header without a column of the
    contract fails it always. ``headers`` spares reading them again.
    """
    paths = list(paths)
    headers = headers or first_lines(spark, paths)
    schema = RAW_TRADE[direction]
    types = {f.name: f.dataType for f in schema.fields}
    by_header: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        fault = header_fault(path, headers[path], schema)
        if fault:
            raise fault
        by_header.setdefault(tuple(headers[path][0]), []).append(path)
    if not by_header:
        raise ValueError(f"no {direction} files to read")

    options = {"mode": "FAILFAST"}
    marks = []
    if mark_errors:
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
        marks = [T.StructField(CORRUPT, T.StringType())]
    scans = []
    for header, group in by_header.items():
        fields = [T.StructField(name, types.get(name, T.StringType())) for name in header]
        scan = (
            spark.read.options(**CSV_FORMAT, **options, enforceSchema="false")
            .schema(T.StructType(fields + marks))
            .csv(group)
            .withColumn(SOURCE, source_label(F.col("_metadata.file_path")))
        )
        scans.append(conform(scan, schema, SOURCE, *[m.name for m in marks]))
    return reduce(DataFrame.unionByName, scans)


def read_code_csv(spark: SparkSession, path: str) -> DataFrame:
    """A code table with every column as text, so leading zeros survive."""
    return spark.read.options(**CSV_FORMAT, mode="FAILFAST", enforceSchema="false").csv(path)


def read_parquet_by_name(
    spark: SparkSession,
    paths: Iterable[str],
    schema: T.StructType,
    derived: Mapping[str, str] | None = None,
    label: Column | None = None,
) -> DataFrame:
    """Union of Parquet datasets by column name; codes may be text in one, numbers in another.

    Datasets whose schemas agree on the types of the columns they share are one scan: Spark
    merges their schemas in one job over all footers. Where that fails, the sorted list is
    halved until it does not, so jobs and scans grow with the number of generations of files,
    not of files. ``derived`` names further columns with the expression that stands in
    where a dataset does not store them; ``label`` is a further column of its own.
    """
    paths = sorted(paths)
    if not paths:
        raise ValueError("no Parquet datasets to read")
    scans = []
    for scan in _mergeable(spark, paths):
        more = [
            f"coalesce({name}, {made}) AS {name}" if name in scan.columns else f"{made} AS {name}"
            for name, made in (derived or {}).items()
        ]
        labels = [] if label is None else [label]
        scans.append(conform(scan, schema, *more, *labels))
    return reduce(DataFrame.unionByName, scans)


def _mergeable(spark: SparkSession, paths: list[str]) -> list[DataFrame]:
    try:
        return [spark.read.option("mergeSchema", "true").parquet(*paths)]
    except (PySparkException, Py4JJavaError):
        if len(paths) == 1:
            raise
        middle = len(paths) // 2
        return _mergeable(spark, paths[:middle]) + _mergeable(spark, paths[middle:])


def source_label(path: Column) -> Column:
    """Published file name without extension, from a file path or a dataset folder."""
    return F.regexp_extract(path, r"([A-Z_]+(?:_[0-9]{4})?)\.csv", 1)
