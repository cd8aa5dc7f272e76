"""The batch job: convert, test code tables, write fact, totals and marts, test them, publish all at once."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairlead import sinks, snapshots
from fairlead.config import JobConfig, Layout
from fairlead.functions.codes import YEAR
from fairlead.jobs import side_by_side
from fairlead.operators import filters
from fairlead.plans import core, ingest, ledger, marts, quality, staging
from fairlead.schemas import CODE_TABLES, DIRECTIONS, EXPORT, IMPORT, RAW_TRADE, TRADE
from fairlead.snapshots import Entry
from fairlead.sources import landing
from fairlead.sources.files import SOURCE, read_parquet_by_name

# Staged trade models and their direction.
TRADE_MODELS = {"stg_exportacoes": EXPORT, "stg_importacoes": IMPORT}
FACT = "core_comercio"
PRODUCTS = "core_produtos"

_FILE = T.StructField(SOURCE, T.StringType())


def run(spark: SparkSession, config: JobConfig) -> DataFrame:
    """Convert the landing zone and build the warehouse; return the quality report.

    With ``config.revised`` only files that are new or changed are converted, and if the
    warehouse was built for the same years, only their part of it is built anew.
    """
    absent = missing_files(spark, config)
    if absent and not config.allow_missing:
        raise RuntimeError(f"files not landed: {', '.join(absent)}")
    results = ingest.convert(spark, config).cache()
    try:
        failed = [row[0] for row in results.where(F.col("status") == ingest.FAILED).select("arquivo").collect()]
        done = ingest.converted(results)
    finally:
        results.unpersist()
    if failed:
        raise RuntimeError(f"files not converted: {', '.join(sorted(failed))}")
    if config.revised and not config.force:
        return refresh(spark, config, [label for label in done if label not in CODE_TABLES])
    return build(spark, config, stored_raw(spark, config.layout))


def refresh(spark: SparkSession, config: JobConfig, files: Iterable[str]) -> DataFrame:
    """Build anew what depends on some published files; return the quality report.

    The fact and its totals are stored per file: those of ``files`` are written again, the
    others are not read. Marts are made from the totals of all files. The warehouse
    equals a whole build; the tests of fact rows cover the rows just written, all other tests
    cover everything. Without a warehouse, or with one of other years, all is built.
    """
    files = set(files)
    held = snapshots.current(spark, config.layout)
    if not held or any(e.window != _window(config) for e in held):
        return build(spark, config, stored_raw(spark, config.layout))
    kept = [e for e in held if e.part and e.part not in files]
    return build(spark, config, stored_raw(spark, config.layout, files), kept=kept)


def missing_files(spark: SparkSession, config: JobConfig) -> list[str]:
    """Expected files that the landing zone lacks: chosen years, directions and code tables."""
    years = config.file_years or range(config.first_year, config.last_year + 1)
    wanted = landing.expected(spark, years, config.directions, config.code_tables)
    absent = landing.missing(wanted, landing.inventory(spark, config.landing_root))
    return sorted(row[0] for row in absent.select("arquivo").collect())


def stored_raw(spark: SparkSession, layout: Layout, files: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """The converted tables with the published file of each row. A direction never converted is an empty table.

    ``files`` limits the trade rows to some files. What this library converted, by its
    ledger, has the raw contract for a schema and is one scan without a look at its footers;
    files stored by others are united by column name, whichever types they were stored with.
    """
    own = {row[0] for row in ledger.entries(spark, layout).select(SOURCE).collect()}
    raw = {}
    for direction in DIRECTIONS:
        path = layout.raw(direction)
        schema = RAW_TRADE[direction]
        stored = set(sinks.stored_partitions(spark, path, SOURCE))
        if files is not None:
            stored &= set(files)
        scans = []
        if stored & own:
            ours = T.StructType([*schema.fields, T.StructField("ano", T.IntegerType()), _FILE])
            reader = spark.read.schema(ours).option("basePath", path)
            scans.append(reader.parquet(*[f"{path}/{SOURCE}={label}" for label in sorted(stored & own)]))
        if stored - own:
            label = F.regexp_extract("_metadata.file_path", f"/{SOURCE}=([^/]+)/", 1).alias(SOURCE)
            paths = [f"{path}/{SOURCE}={label}" for label in sorted(stored - own)]
            scans.append(read_parquet_by_name(spark, paths, schema, {"ano": YEAR}, label))
        raw[direction] = (
            reduce(DataFrame.unionByName, scans)
            if scans
            else spark.createDataFrame([], T.StructType([*schema.fields, _FILE]))
        )
    for name in CODE_TABLES:
        raw[name] = spark.read.parquet(layout.code_table(name))
    return raw


def stage(raw: Mapping[str, DataFrame], first_year: int, last_year: int) -> dict[str, DataFrame]:
    return {
        "stg_exportacoes": staging.exports(raw[EXPORT], first_year, last_year),
        "stg_importacoes": staging.imports(raw[IMPORT], first_year, last_year),
    } | stage_code_tables(raw)


def stage_code_tables(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "stg_ncm": staging.products(raw["NCM"], raw["NCM_SH"]),
        "stg_paises": staging.countries(raw["PAIS"]),
        "stg_uf": staging.states(raw["UF"]),
        "stg_vias": staging.modes(raw["VIA"]),
        "stg_urf": staging.customs_units(raw["URF"]),
        "stg_blocos": staging.country_blocs(raw["PAIS_BLOCO"]),
    }


def build(
    spark: SparkSession,
    config: JobConfig,
    raw: Mapping[str, DataFrame],
    checks: Iterable[quality.Check] = quality.CHECKS + quality.GRAIN_CHECKS,
    kept: Iterable[Entry] = (),
) -> DataFrame:
    """Build core and marts from raw tables, test them, and publish all of them or nothing.

    Every table goes to a folder of its own. Only when the last test has passed does one
    small file name these folders as the warehouse (see ``snapshots``): until then, and if
    anything fails, readers see the whole of the last build.

    The fact is written once, by published file, direction and year; its row-level tests are counted
    while it is written. Totals of each file are written next; marts and the tests of
    references add them up and do not read the fact again. ``kept`` are folders of fact and
    totals of an earlier build that go into this one as they are.
    """
    layout = config.layout
    checks = list(checks)
    mart_checks = [c for c in checks if c.layer == quality.MARTS]
    code_checks = [c for c in checks if c.layer == quality.STAGING and c.model not in TRADE_MODELS]
    core_checks = [c for c in checks if c not in mart_checks and c not in code_checks]
    models = stage_code_tables(raw)
    reports = [_tested(spark, config, models, code_checks, quality.STAGING)]

    version = snapshots.build_id()
    written: list[str] = []

    def new(path: str) -> str:
        written.append(f"{path}/{version}")
        return written[-1]

    try:
        products = sinks.write_new(core.products(models["stg_ncm"]), new(layout.core(PRODUCTS)))
        models[PRODUCTS] = spark.read.parquet(products)
        fact, known = _write_fact(config, raw, new(layout.core(FACT)), core_checks)
        entries = [*kept, *_file_entries(config, fact, f"{layout.core(FACT)}/{version}")]
        parts = {e.part: e for e in entries if e.table == FACT and e not in kept}

        def write_total(name: str) -> None:
            rows = sinks.rebalanced(marts.file_totals(name, fact, SOURCE), SOURCE)
            sinks.write_new(rows, new(layout.core(name)), [SOURCE])

        side_by_side(spark, write_total, marts.TOTALS)
        for name in marts.TOTALS:
            entries += [
                Entry(name, part, f"{layout.core(name)}/{version}/{SOURCE}={part}", window=_window(config)) for part in parts
            ]
        totals = {name: _added(spark, layout, entries, name) for name in marts.TOTALS}

        models[FACT] = fact.drop(SOURCE)
        for model, direction in TRADE_MODELS.items():
            models[model] = filters.direction(models[FACT], direction)
        reports.append(_tested(spark, config, models, core_checks, quality.CORE, known, _rows_by_key(totals)))

        states, product_years = totals["estado_mes"], totals["produto_ano"].drop(marts.ROWS)
        plans: dict[str, Callable[[], DataFrame]] = {
            "mart_top_produtos": lambda: marts.named_top_products(product_years, models[PRODUCTS]),
            "mart_blocos_economicos": lambda: marts.economic_blocs(totals["pais_mes"], models["stg_blocos"]),
            "mart_balanca_comercial": lambda: marts.trade_balance(states),
            "mart_exportacoes_por_estado": lambda: marts.exports_by_state(states),
            "mart_importacoes_por_estado": lambda: marts.imports_by_state(states),
        }
        places = {name: new(layout.mart(name)) for name in plans}
        side_by_side(spark, lambda name: sinks.write_new(plans[name](), places[name]), plans)
        models |= {name: spark.read.parquet(path) for name, path in places.items()}
        reports.append(_tested(spark, config, models, mart_checks, quality.MARTS))

        places[PRODUCTS] = products
        entries += [Entry(name, "", path, window=_window(config)) for name, path in places.items()]
        snapshots.publish(spark, layout, entries)
    except Exception:
        for path in written:
            sinks.discard(spark, path)
        raise
    return reduce(DataFrame.unionByName, [r for r in reports if r is not None])


def publish_fact(spark: SparkSession, config: JobConfig, raw: Mapping[str, DataFrame]) -> None:
    """A warehouse of nothing but the fact, without tests."""
    path = f"{config.layout.core(FACT)}/{snapshots.build_id()}"
    fact, _ = _write_fact(config, raw, path, [])
    snapshots.publish(spark, config.layout, _file_entries(config, fact, path))


def _write_fact(
    config: JobConfig, raw: Mapping[str, DataFrame], path: str, checks: list[quality.Check]
) -> tuple[DataFrame, dict[quality.Check, int]]:
    """Write the fact by file, direction and year; returns it and the failures seen on the way.

    Input splits belong to one file, so the write needs no shuffle.
    """
    years = (config.first_year, config.last_year)
    named = {d: raw[d] if SOURCE in raw[d].columns else raw[d].withColumn(SOURCE, F.lit(d)) for d in DIRECTIONS}
    fact = core.trade(
        staging.exports(named[EXPORT], *years, SOURCE), staging.imports(named[IMPORT], *years, SOURCE), SOURCE
    )
    counters: dict[quality.Check, F.Column] = {}
    for model in (FACT, *TRADE_MODELS):
        rows = f"direcao = '{TRADE_MODELS[model]}'" if model in TRADE_MODELS else "true"
        counters |= quality.row_counters([c for c in checks if c.model == model], rows)
    observed = Observation()
    columns = [F.count(F.lit(1)).alias("n"), *[column.alias(f"n{i}") for i, column in enumerate(counters.values())]]
    sinks.write_new(fact.observe(observed, *columns), path, [SOURCE, "direcao", "ano"])
    seen = observed.get
    known = quality.known_failures({check: seen.get(f"n{i}", 0) for i, check in enumerate(counters)})
    spark = fact.sparkSession
    schema = T.StructType([*TRADE.fields, _FILE])
    if not seen.get("n", 0):
        return spark.createDataFrame([], schema), known
    return spark.read.schema(schema).parquet(path), known


def _file_entries(config: JobConfig, fact: DataFrame, path: str) -> list[Entry]:
    """Rows and years of each file from the footers and folder names of the fact."""
    per_file = fact.groupBy(SOURCE, "ano").agg(F.count(F.lit(1)).alias("n")).groupBy(SOURCE)
    rows = per_file.agg(F.sum("n"), F.min("ano"), F.max("ano")).orderBy(SOURCE).collect()
    return [
        Entry(FACT, part, f"{path}/{SOURCE}={part}", n, first, last, window=_window(config)) for part, n, first, last in rows
    ]


def _window(config: JobConfig) -> str:
    return f"{config.first_year}-{config.last_year}"


def _added(spark: SparkSession, layout: Layout, entries: Iterable[Entry], name: str) -> DataFrame:
    """A total over the stored totals of all files."""
    total = marts.TOTALS[name]
    schema = T.StructType([*[TRADE[c] for c in (*total.keys, *total.measures)], T.StructField(marts.ROWS, T.LongType())])
    return marts.added(name, snapshots.scan(spark, layout.core(name), snapshots.folders(entries, name), schema))


def _rows_by_key(totals: Mapping[str, DataFrame]) -> dict[tuple[str, str], DataFrame]:
    """Rows of the trade models per value of the columns whose references are tested."""
    found = {}
    for column, name in (("co_ncm", "produto_ano"), ("co_pais", "pais_mes"), ("sg_uf", "estado_mes")):
        found[FACT, column] = totals[name]
        for model, direction in TRADE_MODELS.items():
            found[model, column] = filters.direction(totals[name], direction)
    return found


def stored_totals(spark: SparkSession, layout: Layout, trade: DataFrame) -> dict[str, DataFrame]:
    """Totals of a fact per state, product and country, written once, whatever is read of them."""
    plans = {
        "estado_mes": marts.state_months,
        "produto_ano": marts.product_totals,
        "pais_mes": marts.country_month_totals,
    }

    def write(name: str) -> None:
        sinks.write_table(plans[name](trade), layout.core(name))

    side_by_side(spark, write, plans)
    return {name: spark.read.parquet(layout.core(name)) for name in plans}


def stored_core(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    """The published fact and products."""
    entries = _published(spark, layout)
    # The schema is given: reading back must not guess the partition columns' types.
    fact = snapshots.scan(spark, layout.core(FACT), snapshots.folders(entries, FACT), TRADE)
    return {FACT: fact, PRODUCTS: spark.read.parquet(*snapshots.folders(entries, PRODUCTS))}


def stored_marts(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    """The published marts."""
    entries = _published(spark, layout)
    return {name: spark.read.parquet(*snapshots.folders(entries, name)) for name in quality.MART_GRAINS}


def _published(spark: SparkSession, layout: Layout) -> list[Entry]:
    entries = snapshots.current(spark, layout)
    if not entries:
        raise LookupError(f"no warehouse published at {layout.root}")
    return entries


def _tested(
    spark: SparkSession,
    config: JobConfig,
    models: Mapping[str, DataFrame],
    checks: list[quality.Check],
    name: str,
    known: Mapping[quality.Check, int] | None = None,
    counted: Mapping[tuple[str, str], DataFrame] | None = None,
) -> DataFrame | None:
    """Run tests once, keep their report as a table, stop the build on errors."""
    if not checks:
        return None
    path = config.layout.report(name)
    sinks.write_table(quality.report(models, checks, known, counted).coalesce(1), path)
    results = spark.read.parquet(path)
    if config.fail_fast:
        quality.enforce(results)
    return results


def freshness(spark: SparkSession, layout: Layout) -> DataFrame:
    """Fact rows, covered years and when the fact was last published: read from the snapshot, not from the fact."""
    published = snapshots.read(spark, layout)
    if published is None:
        raise LookupError(f"no warehouse published at {layout.root}")
    return published.where(F.col("tabela") == FACT).agg(
        F.ifnull(F.sum("linhas"), F.lit(0)).alias("linhas_core"),
        F.min("ano_min").alias("ano_min"),
        F.max("ano_max").alias("ano_max"),
        F.max("publicado_em").alias("atualizado_em"),
    )


def warehouse_exists(spark: SparkSession, layout: Layout) -> bool:
    return bool(snapshots.current(spark, layout))
