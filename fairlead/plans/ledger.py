"""What was converted, and from which state of its file."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairlead import sinks
from fairlead.config import JobConfig, Layout
from fairlead.sources import landing
from fairlead.sources.files import SOURCE

_LEDGER = f"{SOURCE} string, bytes long, modificado timestamp, convertido_em timestamp"


def entries(spark: SparkSession, layout: Layout) -> DataFrame:
    """One row per converted file: label, bytes and last change of what was converted, and when."""
    path = layout.ledger()
    if not landing.exists(spark, path):
        return spark.createDataFrame([], _LEDGER)
    return spark.read.schema(_LEDGER).parquet(path)


def pending(spark: SparkSession, layout: Layout, landed: DataFrame) -> DataFrame:
    """Landed files that were never converted, or have another size or time since."""
    return landed.join(entries(spark, layout), [SOURCE, "bytes", "modificado"], "left_anti")


def settled(spark: SparkSession, config: JobConfig, landed: DataFrame) -> set[str]:
    """Labels of landed files that are converted as they are."""
    known = landed.join(entries(spark, config.layout), [SOURCE, "bytes", "modificado"], "left_semi")
    return {row[0] for row in known.select(SOURCE).collect()}


def record(spark: SparkSession, config: JobConfig, landed: DataFrame, labels: Iterable[str]) -> None:
    """Note the state of files just converted in place of earlier notes.

    Written after the rows: if a run dies in between, the file is converted again.
    """
    labels = list(labels)
    if not labels:
        return
    done = spark.createDataFrame([(label,) for label in labels], f"{SOURCE} string")
    new = landed.join(done, SOURCE, "left_semi").select(
        SOURCE, "bytes", "modificado", F.current_timestamp().alias("convertido_em")
    )
    kept = entries(spark, config.layout).join(done, SOURCE, "left_anti")
    sinks.write_table(kept.unionByName(new).coalesce(1), config.layout.ledger())
