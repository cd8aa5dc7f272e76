"""Which folders make up the warehouse: one small file, replaced as a whole."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable
from dataclasses import astuple, dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairlead import sinks
from fairlead.config import Layout
from fairlead.sources.landing import list_files

# Snapshots whose folders stay, so that a reader of the last one can finish.
KEPT = 2

_SCHEMA = (
    "tabela string, arquivo string, pasta string, linhas long, ano_min int, ano_max int, "
    "publicado_em timestamp, janela string"
)


@dataclass(frozen=True)
class Entry:
    """A folder of a table: all of it, or the rows of one published file (``part``).

    ``window`` names the years it was built for.
    """

    table: str
    part: str
    folder: str
    rows: int | None = None
    first_year: int | None = None
    last_year: int | None = None
    published: datetime | None = None
    window: str = ""


def read(spark: SparkSession, layout: Layout) -> DataFrame | None:
    """The published entries as a table; None before the first build."""
    number = _newest(spark, layout)
    return None if number is None else _stored(spark, layout, number)


def current(spark: SparkSession, layout: Layout) -> list[Entry]:
    """The published entries: a row per table, and per published file for the fact and its totals."""
    table = read(spark, layout)
    return [] if table is None else [Entry(*row) for row in table.collect()]


def scan(spark: SparkSession, root: str, places: list[str], schema: T.StructType) -> DataFrame:
    """The rows in some folders of the builds of one table, as one scan."""
    if not places:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*places).select(*schema.names)


def folders(entries: Iterable[Entry], table: str) -> list[str]:
    return sorted(e.folder for e in entries if e.table == table)


def publish(spark: SparkSession, layout: Layout, entries: Iterable[Entry]) -> None:
    """Make ``entries`` the warehouse, in one step.

    Their folders are written before, under names nobody reads yet; what readers resolve is
    the snapshot with the largest number, a single file that a job commits whole or not at
    all. Nothing is renamed over anything, so a run that dies leaves the last snapshot,
    on any kind of store. Two builds that end at once want the same number: the second fails.

    Afterwards folders that none of the last ``KEPT`` snapshots names are dropped.
    """
    number = (_newest(spark, layout) or 0) + 1
    now = datetime.now()
    rows = [astuple(replace(e, published=e.published or now)) for e in entries]
    spark.createDataFrame(rows, _SCHEMA).coalesce(1).write.parquet(_path(layout, number))
    old = number - KEPT
    if old > 0:
        kept = {row["pasta"] for k in range(old + 1, number + 1) for row in _stored(spark, layout, k).collect()}
        gone = {row["pasta"] for row in _stored(spark, layout, old).collect()} - kept
        live = {_build_of(folder) for folder in kept}
        # A build none of whose folders is named goes as a whole.
        for folder in sorted({f if _build_of(f) in live else _build_of(f) for f in gone}):
            sinks.discard(spark, folder)
        sinks.discard(spark, _path(layout, old))


def _stored(spark: SparkSession, layout: Layout, number: int) -> DataFrame:
    return spark.read.schema(_SCHEMA).parquet(_path(layout, number))


def _build_of(folder: str) -> str:
    return re.sub(r"(/versao=[^/]*)/.*", r"\1", folder)


def build_id() -> str:
    """Name of the folders of one build, one partition of a table."""
    return f"versao={uuid.uuid4().hex}"


def _path(layout: Layout, number: int) -> str:
    return f"{layout.snapshots()}/{number:012d}"


def _newest(spark: SparkSession, layout: Layout) -> int | None:
    files = list_files(spark, layout.snapshots(), "*.parquet")
    if files is None:
        return None
    newest = files.select(F.max(F.regexp_extract("path", r"/([0-9]{12})/[^/]*$", 1))).first()[0]
    return int(newest) if newest else None
