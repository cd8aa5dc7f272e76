"""CSV to Parquet conversion of the landing zone, with a report."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairlead import sinks
from fairlead.config import JobConfig
from fairlead.jobs import side_by_side
from fairlead.plans import ledger
from fairlead.schemas import CODE_TABLES, RAW_TRADE
from fairlead.sources import landing
from fairlead.sources.files import CORRUPT, SOURCE, BadHeader, first_lines, header_fault, read_code_csv, read_trade_csv

OK = "OK"
SKIPPED = "SKIPPED"
FAILED = "FAILED"
# A CSV file whose name is none of the published ones.
UNKNOWN = "UNKNOWN"

# What a failed Spark job raises: not every JVM error has a Python class.
JOB_FAILURES = (PySparkException, Py4JJavaError, BadHeader)

# Whether a row cannot be read: keeps bad rows apart while a file is converted.
_BAD = "com_erro"
YEAR_COLUMN = "ano"


@dataclass(frozen=True)
class Outcome:
    """How the conversion of a file ended, its columns as landed, and why it failed."""

    status: str
    columns: int | None = None
    reason: str | None = None


def convert(spark: SparkSession, config: JobConfig) -> DataFrame:
    """Convert the selected files; return one report row per file.

    Without ``force`` a file already converted is skipped, or with ``revised`` only one whose
    size and time are those of its last conversion; with ``force`` its partition is
    replaced and other years stay. A file that cannot be parsed, or lacks a column of the
    contract, is reported as FAILED with the reason and leaves nothing behind; the others are
    converted. CSV files with a name of no published file are reported as UNKNOWN. Two files
    of one label stop the conversion before anything is written.

    Each file is read once, whether others are bad or not, and the number of jobs does not
    depend on the number of files: lines that cannot be read are marked and written
    apart, so the listing of what was written tells the bad files, and only those are read again for
    the reason.
    """
    outcome: dict[str, Outcome] = {}
    landed = landing.inventory(spark, config.landing_root)
    datasets: dict[str, str] = {}
    for row in landed.collect():
        if row[SOURCE] in datasets:
            # Reading one of them would lose the other's rows; reading both could double them.
            raise ValueError(f"{row[SOURCE]} landed twice: {datasets[row[SOURCE]]} and {row['conjunto']}")
        datasets[row[SOURCE]] = row["conjunto"]
    settled = ledger.settled(spark, config, landed) if config.revised else None
    for direction in config.directions:
        outcome |= _convert_direction(spark, config, direction, datasets, settled)
    if config.code_tables:
        present = [name for name in CODE_TABLES if name in datasets]
        converted = side_by_side(
            spark, lambda name: _convert_code_table(spark, config, name, datasets[name], settled), present
        )
        outcome |= dict(zip(present, converted))
    ledger.record(spark, config, landed, [label for label, o in outcome.items() if o.status == OK])
    return _report(spark, config, landed, outcome)


def converted(report: DataFrame) -> list[str]:
    """Labels of the files that a conversion has written."""
    return sorted(row[0] for row in report.where(F.col("status") == OK).select(SOURCE).collect())


def _convert_direction(
    spark: SparkSession, config: JobConfig, direction: str, datasets: dict[str, str], settled: set[str] | None
) -> dict[str, Outcome]:
    chosen = {
        label: path
        for label, path in sorted(datasets.items())
        if label.startswith(f"{direction}_")
        and (config.file_years is None or int(label.rsplit("_", 1)[1]) in config.file_years)
    }
    if not chosen:
        return {}
    headers = first_lines(spark, chosen.values())
    columns = {label: len(headers[path][0]) if headers[path] else 0 for label, path in chosen.items()}
    target = config.layout.raw(direction)
    held = set(sinks.stored_partitions(spark, target, SOURCE))
    skipped = set() if config.force else held & set(chosen)
    if not config.force and settled is not None:
        # A file whose conversion gave no rows has no partition; the ledger knows it all the same.
        skipped = settled & set(chosen)
    outcome = {label: Outcome(SKIPPED, columns[label]) for label in skipped}
    pending: dict[str, str] = {}
    for label in sorted(chosen.keys() - skipped):
        fault = header_fault(chosen[label], headers[chosen[label]], RAW_TRADE[direction])
        if fault:
            outcome[label] = Outcome(FAILED, columns[label], _reason(fault))
        else:
            pending[label] = chosen[label]
    if not pending:
        return outcome
    try:
        reasons = _write(spark, pending, direction, target, headers, held)
    except JOB_FAILURES:
        # A file that cannot be read at all, such as a broken archive, fails the shared job.
        labels = sorted(pending)
        faults = side_by_side(spark, lambda label: _unreadable(spark, pending[label], direction, headers), labels)
        reasons = {label: fault for label, fault in zip(labels, faults) if fault is not None}
        if not reasons:
            raise
        others = {label: path for label, path in pending.items() if label not in reasons}
        if others:
            reasons |= _write(spark, others, direction, target, headers, held)
    return outcome | {
        label: Outcome(FAILED if label in reasons else OK, columns[label], reasons.get(label)) for label in pending
    }


def _rows(
    spark: SparkSession, paths: Iterable[str], direction: str, headers: dict[str, list[list[str]]]
) -> DataFrame:
    """Rows of the files with the integer year that the models filter on; bad ones have a text in CORRUPT."""
    rows = read_trade_csv(spark, paths, direction, headers, mark_errors=True)
    year = f"try_cast(CO_ANO AS INT) AS {YEAR_COLUMN}"
    no_year = "CO_ANO IS NOT NULL AND try_cast(CO_ANO AS INT) IS NULL"
    return rows.selectExpr("* EXCEPT (" + CORRUPT + ")", year, f"ifnull({CORRUPT}, if({no_year}, concat('CO_ANO ', CO_ANO), NULL)) AS {CORRUPT}")


def _write(
    spark: SparkSession,
    files: dict[str, str],
    direction: str,
    target: str,
    headers: dict[str, list[list[str]]],
    held: set[str],
) -> dict[str, str]:
    """Convert files into their partitions; returns the reasons of those that cannot be read.

    Partitioned by file, not by the year in the rows: a stray row of another year must not
    replace that year's partition. Every input split belongs to one file, so no shuffle is
    needed to keep the number of output files low. Rows wait beside the table, bad ones
    apart from good ones, and the partitions of the good files take their places when all are written.
    """
    rows = _rows(spark, files.values(), direction, headers)
    marked = rows.selectExpr(f"* EXCEPT ({CORRUPT})", f"{CORRUPT} IS NOT NULL AS {_BAD}")
    staged = sinks.write_unpublished(marked, f"{target}/rows", [_BAD, SOURCE])
    try:
        bad = set(sinks.stored_partitions(spark, f"{staged}/{_BAD}=true", SOURCE))
        good = set(sinks.stored_partitions(spark, f"{staged}/{_BAD}=false", SOURCE)) - bad
        for label in sorted(good):
            sinks.publish(spark, f"{staged}/{_BAD}=false/{SOURCE}={label}", f"{target}/{SOURCE}={label}")
        # A file that has lost all its rows.
        for label in sorted(held & files.keys() - good - bad):
            sinks.discard(spark, f"{target}/{SOURCE}={label}")
    finally:
        sinks.discard(spark, staged)
    return _reasons(spark, {label: files[label] for label in bad}, direction, headers) if bad else {}


def _unreadable(spark: SparkSession, path: str, direction: str, headers: dict[str, list[list[str]]]) -> str | None:
    """Why a file cannot be read to its end; None if it can."""
    try:
        _rows(spark, [path], direction, headers).write.format("noop").mode("overwrite").save()
        return None
    except JOB_FAILURES as failure:
        return _reason(failure)


def _reasons(
    spark: SparkSession, files: dict[str, str], direction: str, headers: dict[str, list[list[str]]]
) -> dict[str, str]:
    """How many lines of each bad file cannot be read, and one of them."""
    bad = _rows(spark, files.values(), direction, headers).where(F.col(CORRUPT).isNotNull())
    # The reader only parses columns that are used: without the hash it would find less to mark.
    counted = bad.groupBy(SOURCE).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.substring(CORRUPT, 1, 200)).alias("line"),
        F.max(F.xxhash64(*RAW_TRADE[direction].names)),
    )
    return {row[SOURCE]: f"{row['n']} malformed rows, such as: {row['line']}" for row in counted.collect()}


def _reason(failure: Exception) -> str:
    """First line of what went wrong; the whole trace is in Spark's log."""
    return (str(failure).strip() or type(failure).__name__).splitlines()[0]


def _convert_code_table(
    spark: SparkSession, config: JobConfig, name: str, path: str, settled: set[str] | None
) -> Outcome:
    target = config.layout.code_table(name)
    try:
        table = read_code_csv(spark, path)
        if not config.force and landing.exists(spark, target) and (settled is None or name in settled):
            return Outcome(SKIPPED, len(table.columns))
        sinks.write_table(table, target)
        return Outcome(OK, len(table.columns))
    except JOB_FAILURES as failure:
        return Outcome(FAILED, reason=_reason(failure))


def _report(
    spark: SparkSession, config: JobConfig, landed: DataFrame, outcome: dict[str, Outcome]
) -> DataFrame:
    """File, rows, columns as landed, CSV and Parquet bytes, ratio, status, reason of a failure."""
    statuses = spark.createDataFrame(
        [(label, o.status, o.columns, o.reason) for label, o in sorted(outcome.items())],
        f"{SOURCE} string, status string, colunas int, motivo string",
    )
    stored = [_stored(spark, config.layout.raw(d)) for d in config.directions]
    stored += [_stored(spark, config.layout.code_table(name), name) for name in CODE_TABLES if name in outcome]
    sizes = None
    for part in stored:
        if part is not None:
            sizes = part if sizes is None else sizes.unionByName(part)
    report = statuses.join(landed.select(SOURCE, F.col("bytes").alias("bytes_csv")), SOURCE, "left")
    if sizes is None:
        empty = {"linhas": "long", "bytes_parquet": "long"}
        report = report.select("*", *[F.lit(None).cast(t).alias(n) for n, t in empty.items()])
    else:
        report = report.join(sizes, SOURCE, "left")
    # A failed file keeps what an earlier run stored, but that is not its result.
    done = f"status != '{FAILED}'"
    known = report.selectExpr(
        SOURCE,
        f"if({done}, ifnull(linhas, 0), NULL) AS linhas",
        f"if({done}, colunas, NULL) AS colunas",
        "bytes_csv",
        f"if({done}, bytes_parquet, NULL) AS bytes_parquet",
        f"if({done}, bytes_csv / nullif(bytes_parquet, 0), NULL) AS razao",
        "status",
        "motivo",
    )
    unknown = landing.unknown(spark, config.landing_root).selectExpr(
        f"conjunto AS {SOURCE}", "bytes AS bytes_csv", f"'{UNKNOWN}' AS status"
    )
    return known.unionByName(unknown, allowMissingColumns=True)


def _stored(spark: SparkSession, path: str, label: str | None = None) -> DataFrame | None:
    """Rows and bytes per converted file; row counts come from the Parquet footers."""
    if not landing.exists(spark, path):
        return None
    table = spark.read.parquet(path)
    source = F.lit(label) if label else F.col(SOURCE)
    per_file = table.select(
        source.alias(SOURCE),
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_size").alias("_size"),
    )
    return (
        per_file.groupBy(SOURCE, "_path")
        .agg(F.count(F.lit(1)).alias("_rows"), F.max("_size").alias("_size"))
        .groupBy(SOURCE)
        .agg(
            F.sum("_rows").alias("linhas"),
            F.sum("_size").alias("bytes_parquet"),
        )
    )
