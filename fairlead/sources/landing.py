"""What lies in the landing zone and what should."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairlead.schemas import CODE_TABLES, DIRECTIONS
from fairlead.sources.files import DATASET, SOURCE, source_label

_LISTING = f"{SOURCE} string, conjunto string, bytes long, modificado timestamp"


def list_files(spark: SparkSession, root: str, pattern: str) -> DataFrame | None:
    """path, length, modificationTime of the files below ``root``; None if it does not exist.

    Only the listing is read, never file contents.
    """
    try:
        return (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", pattern)
            .load(root)
            .select("path", "length", "modificationTime")
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a Parquet table with at least one file is stored at ``path``."""
    files = list_files(spark, path, "*.parquet")
    return files is not None and not files.isEmpty()


def inventory(spark: SparkSession, root: str, pattern: str = "*.csv") -> DataFrame:
    """Published files below ``root``: label, dataset path, bytes, last change.

    A dataset is one ``EXP_2020.csv`` file or a folder of that name holding part files.
    """
    files = list_files(spark, root, pattern)
    if files is None:
        return spark.createDataFrame([], _LISTING)
    return (
        files.select(
            source_label(F.col("path")).alias(SOURCE),
            F.regexp_extract("path", DATASET, 1).alias("conjunto"),
            "length",
            "modificationTime",
        )
        .where(F.col(SOURCE) != "")
        .groupBy(SOURCE, "conjunto")
        .agg(F.sum("length").alias("bytes"), F.max("modificationTime").alias("modificado"))
    )


def unknown(spark: SparkSession, root: str) -> DataFrame:
    """CSV files below ``root`` that ``inventory`` leaves out, by path: their name is no published one."""
    files = list_files(spark, root, "*.[cC][sS][vV]")
    if files is None:
        return spark.createDataFrame([], "conjunto string, bytes long")
    published = f"^({'|'.join(DIRECTIONS)})_[0-9]{{4}}$|^({'|'.join(CODE_TABLES)})$"
    return files.where(~source_label(F.col("path")).rlike(published)).selectExpr("path AS conjunto", "length AS bytes")


def expected(
    spark: SparkSession, years: Iterable[int], directions: Iterable[str], code_tables: bool = True
) -> DataFrame:
    """Labels of every file a complete landing zone holds."""
    labels = [f"{d}_{y}" for d in directions for y in years]
    labels += list(CODE_TABLES) if code_tables else []
    return spark.createDataFrame([(label,) for label in labels], f"{SOURCE} string")


def missing(expected_files: DataFrame, landed: DataFrame) -> DataFrame:
    return expected_files.join(landed, SOURCE, "left_anti")
