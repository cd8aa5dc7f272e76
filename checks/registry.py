"""One entry per operator, model and query."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.star_models import (
    BALANCE_COLUMNS,
    COUNTRY_COLUMNS,
    FIRST_YEAR,
    LAST_YEAR,
    PRODUCT_COLUMNS,
    TOTAL_COLUMNS,
    StarModels,
)
from fairlead import sinks
from fairlead.config import JobConfig, scratch_dir
from fairlead.functions.codes import share
from fairlead.functions.formats import percentage, usd_billions, usd_millions
from fairlead.operators import filters
from fairlead.operators.ranking import share_and_rank_small
from fairlead.plans import analytics, core, ingest, marts, pipeline, quality, staging
from fairlead.schemas import CODE_TABLES, DIRECTIONS, EXPORT, IMPORT, RAW_EXPORTS
from fairlead.sources import landing
from fairlead.sources.files import SOURCE, read_code_csv, read_parquet_by_name, read_trade_csv

Query = Callable[[SparkSession, str], DataFrame]

YEAR = 1998
# Label of a file that cannot be read.
BROKEN_YEAR = 2003
TOP_N = 10
STATES = ("Brand#1", "Brand#7", "Brand#13")
BLOCS = ("10", "12", "99")
PARTNERS = ("003", "011")
PERIOD = (FIRST_YEAR, LAST_YEAR)

_QUERIES: dict[str, Query] = {}


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def query(build: Callable[[StarModels], DataFrame]) -> Callable[[StarModels], DataFrame]:
    _QUERIES[build.__name__] = lambda spark, folder: build(StarModels(spark, folder))
    return build


def _warehouse(m: StarModels) -> JobConfig:
    return JobConfig("", scratch_dir(m.spark, "warehouse"), first_year=FIRST_YEAR, last_year=LAST_YEAR)


# -- sources and sinks ---------------------------------------------------------


def _landed(m: StarModels, direction: str) -> list[str]:
    root = scratch_dir(m.spark, "landing")
    m.land(root, direction)
    return [row["conjunto"] for row in landing.inventory(m.spark, root).collect()]


@query
def scan_exports_csv(m):
    return read_trade_csv(m.spark, _landed(m, EXPORT), EXPORT).drop(SOURCE)


@query
def scan_imports_csv(m):
    return read_trade_csv(m.spark, _landed(m, IMPORT), IMPORT).drop(SOURCE)


def _scan_code_table(m: StarModels, name: str) -> DataFrame:
    root = scratch_dir(m.spark, "landing")
    m.land_code_table(root, name)
    return read_code_csv(m.spark, f"{root}/aux/{name}.csv")


@query
def scan_aux_ncm(m):
    return _scan_code_table(m, "NCM")


@query
def scan_aux_ncm_sh(m):
    return _scan_code_table(m, "NCM_SH")


@query
def scan_aux_pais(m):
    return _scan_code_table(m, "PAIS")


@query
def scan_aux_pais_bloco(m):
    return _scan_code_table(m, "PAIS_BLOCO")


@query
def scan_aux_uf(m):
    return _scan_code_table(m, "UF")


@query
def scan_aux_via(m):
    return _scan_code_table(m, "VIA")


@query
def scan_aux_urf(m):
    return _scan_code_table(m, "URF")


@query
def scan_union_by_name(m):
    """Two generations of files: numeric codes in another order without CO_VIA, then text."""
    root = scratch_dir(m.spark, "generations")
    rows = m.raw(EXPORT)
    old = rows.where(F.expr(f"int(CO_ANO) < {YEAR}")).drop("CO_VIA")
    new = rows.where(F.expr(f"int(CO_ANO) >= {YEAR}"))
    sinks.write_table(old.select(*reversed(old.columns)), f"{root}/old")
    sinks.write_table(
        new.withColumns({c: F.col(c).cast("string") for c in ("CO_NCM", "CO_PAIS", "CO_URF")}),
        f"{root}/new",
    )
    return read_parquet_by_name(m.spark, [f"{root}/old", f"{root}/new"], RAW_EXPORTS)


def _converted(
    m: StarModels, directions: tuple[str, ...], broken: bool = False, **options
) -> tuple[JobConfig, DataFrame]:
    """Land every file of both directions and the code tables, convert the selected ones.

    ``broken`` adds a year of exports with text for an amount in every second month.
    """
    config = JobConfig(
        landing_root=scratch_dir(m.spark, "landing"),
        warehouse_root=scratch_dir(m.spark, "warehouse"),
        directions=directions,
        **options,
    )
    for direction in (EXPORT, IMPORT):
        m.land(config.landing_root, direction)
    if broken:
        odd = f"CASE WHEN CO_MES IN ('02', '04', '06', '08', '10', '12') THEN 'n/a' ELSE string(VL_FOB) END"
        rows = m.raw(EXPORT).where(f"CO_ANO = '{YEAR}'").withColumn("VL_FOB", F.expr(odd))
        rows = rows.selectExpr("*", f"'{EXPORT}_{BROKEN_YEAR}' AS {SOURCE}")
        sinks.land_csv(rows, f"{config.landing_root}/broken")
    if config.code_tables:
        for name in CODE_TABLES:
            m.land_code_table(config.landing_root, name)
    return config, ingest.convert(m.spark, config)


@query
def ingest_select(m):
    config, _ = _converted(m, (IMPORT,), file_years=(1997, 1998), code_tables=False)
    return (
        m.spark.read.parquet(config.layout.raw(IMPORT))
        .groupBy(SOURCE)
        .agg(F.expr("count(1) AS linhas"), F.expr("sum(VL_FOB) AS vl_fob"))
    )


@query
def ingest_report_rows(m):
    """The part of the conversion report that does not depend on file sizes."""
    report = _converted(m, (EXPORT, IMPORT), broken=True)[1]
    return report.selectExpr(
        SOURCE,
        "linhas",
        "colunas",
        "bytes_csv > 0 AS tem_csv",
        "razao > 0 AS tem_razao",
        "status",
        "substring_index(motivo, ',', 1) AS motivo",
    )


@query
def ingest_revised(m):
    """Land one year again with doubled values and offer all files: only that one is converted again."""
    config, _ = _converted(m, (EXPORT,))
    twice = m.labelled(EXPORT).where(f"CO_ANO = '{YEAR}'").withColumn("VL_FOB", F.col("VL_FOB") * 2)
    # One file in the place of the folder's files, as a revision lands: the whole year again.
    sinks.land_csv_file(twice, f"{config.landing_root}/{EXPORT.lower()}", f"{EXPORT}_{YEAR}")
    report = ingest.convert(m.spark, replace(config, force=False, revised=True))
    sums = m.spark.read.parquet(config.layout.raw(EXPORT)).groupBy(SOURCE).agg(F.expr("sum(VL_FOB) AS vl_fob"))
    return report.select(SOURCE, "status").join(sums, SOURCE, "left")


@query
def landing_missing(m):
    root = scratch_dir(m.spark, "landing")
    m.land(root, EXPORT)
    m.land(root, IMPORT)
    m.land_code_table(root, "PAIS")
    m.land_code_table(root, "PAIS_BLOCO")
    wanted = landing.expected(m.spark, range(1993, 2004), (EXPORT, IMPORT))
    return landing.missing(wanted, landing.inventory(m.spark, root))


def _stored_exports(m: StarModels) -> str:
    path = f"{scratch_dir(m.spark, 'sink')}/exp"
    sinks.refresh_partitions(sinks.rebalanced(m.labelled(EXPORT), SOURCE), path, [SOURCE])
    return path


@query
def sink_parquet_roundtrip(m):
    return m.spark.read.parquet(_stored_exports(m))


@query
def sink_skip_existing(m):
    """Offer every file again with doubled values: files already stored stay as they are."""
    path = f"{scratch_dir(m.spark, 'sink')}/exp"
    rows = m.labelled(EXPORT)
    early = rows.where(F.expr(f"int(CO_ANO) < {YEAR}"))
    sinks.refresh_partitions(sinks.rebalanced(early, SOURCE), path, [SOURCE])
    doubled = rows.withColumn("VL_FOB", F.col("VL_FOB") * 2)
    sinks.add_new_partitions(sinks.rebalanced(doubled, SOURCE), path, SOURCE)
    return m.spark.read.parquet(path)


@query
def sink_refresh_year(m):
    """Revise one year; the others keep their rows."""
    path = f"{scratch_dir(m.spark, 'sink')}/exp"
    rows = m.labelled(EXPORT)
    sinks.refresh_partitions(sinks.rebalanced(rows, SOURCE), path, [SOURCE])
    revised = rows.where(F.expr(f"int(CO_ANO) = {YEAR}")).withColumn("VL_FOB", F.col("VL_FOB") * 2)
    sinks.refresh_partitions(sinks.rebalanced(revised, SOURCE), path, [SOURCE])
    return m.spark.read.parquet(path)


@query
def refresh_year_to_marts(m):
    """Build the warehouse, revise one file, build only what depends on it: the balance of all years."""
    config = _warehouse(m)
    m.store_raw(config.layout)
    pipeline.build(m.spark, config, pipeline.stored_raw(m.spark, config.layout))
    revised = m.labelled(EXPORT).where(f"CO_ANO = '{YEAR}'").withColumn("VL_FOB", F.col("VL_FOB") * 2)
    sinks.refresh_partitions(sinks.rebalanced(staging.dated(revised), SOURCE), config.layout.raw(EXPORT), [SOURCE])
    pipeline.refresh(m.spark, config, [f"{EXPORT}_{YEAR}"])
    return pipeline.stored_marts(m.spark, config.layout)["mart_balanca_comercial"]


@query
def sink_csv_roundtrip(m):
    detail = analytics.balance_detail(m.balance(), None, *PERIOD)
    path = f"{scratch_dir(m.spark, 'export')}/detail"
    sinks.export_csv(detail, path)
    return m.spark.read.options(header="true", escape='"').schema(detail.schema).csv(path)


# -- filters -------------------------------------------------------------------


@query
def filter_year_window(m):
    """The window on a stored raw table, whose integer year the scan can use."""
    config = JobConfig(landing_root="", warehouse_root=scratch_dir(m.spark, "warehouse"))
    m.store_raw(config.layout)
    rows = pipeline.stored_raw(m.spark, config.layout)[EXPORT]
    return filters.year_window(rows.select("ano", "CO_MES", "VL_FOB"), *PERIOD)


@query
def filter_direction(m):
    return filters.direction(m.trade("ano", "mes", "direcao", "co_ncm", "vl_fob_usd"), IMPORT)


@query
def filter_optional_in_uf(m):
    return filters.any_of(m.balance(), "sg_uf", STATES)


@query
def filter_optional_in_uf_empty(m):
    return filters.any_of(m.balance(), "sg_uf", ())


@query
def filter_optional_in_bloc(m):
    return filters.any_of(m.blocs(), "co_bloco", BLOCS)


@query
def filter_optional_in_bloc_empty(m):
    return filters.any_of(m.blocs(), "co_bloco", None)


# -- joins ---------------------------------------------------------------------


@query
def join_left_sh_hierarchy(m):
    products = staging.products(m.code("NCM"), m.code("NCM_SH"))
    return products.select("co_ncm", "co_sh6", "co_sh4", "co_sh2", "no_sh6_pt")


@query
def join_inner_bloc_fanout(m):
    return marts.fan_out_blocs(marts.country_month_totals(m.trade(*COUNTRY_COLUMNS)), m.country_blocs())


@query
def join_left_product_dim(m):
    return marts.with_product_names(marts.product_totals(m.trade(*PRODUCT_COLUMNS)), m.products())


# -- aggregates, windows, unions -----------------------------------------------


@query
def agg_sum_by_state_month(m):
    trade = m.trade(*BALANCE_COLUMNS, "kg_liquido")
    return marts.state_month_totals(trade, EXPORT, "vl_fob_usd", "kg_liquido")


@query
def agg_conditional_pivot(m):
    return m.balance().select("ano", "mes", "sg_uf", "vl_exp_fob_usd", "vl_imp_fob_usd")


@query
def window_share_month(m):
    return m.exports_by_state().select("ano", "mes", "sg_uf", "share_nacional_mes")


@query
def window_rank_month(m):
    return m.imports_by_state().select("ano", "mes", "sg_uf", "rank_mes")


def _product_ranks(m: StarModels) -> DataFrame:
    return marts.with_product_rank(marts.product_totals(m.trade(*PRODUCT_COLUMNS)))


@query
def window_share_year_direction(m):
    return _product_ranks(m).drop("rank_ano_direcao")


@query
def window_rank_year_direction(m):
    return _product_ranks(m).drop("share_direcao_ano")


@query
def union_all_trade(m):
    return m.trade(
        "ano", "mes", "direcao", "co_ncm", "co_via", "co_urf", "qt_estat", "vl_fob_usd", "vl_frete_usd", "vl_cif_usd"
    )


# -- scalars -------------------------------------------------------------------


@query
def scalar_pad_codes(m):
    return m.staged(IMPORT, "mes", "co_ncm", "co_pais", "co_urf")


@query
def scalar_casts(m):
    return m.staged(EXPORT, "ano", "co_unid", "qt_estat", "kg_liquido", "vl_fob_usd")


@query
def scalar_month_start(m):
    return m.trade("ano", "mes", "data_ref").distinct()


@query
def scalar_cif(m):
    return m.staged(IMPORT, "vl_fob_usd", "vl_frete_usd", "vl_seguro_usd", "vl_cif_usd")


@query
def scalar_safe_share(m):
    """Yearly share of each mode in imported freight, NULL where the year has none."""
    by_mode = (
        m.trade("ano", "direcao", "co_via", "vl_frete_usd")
        .groupBy("ano", "direcao", "co_via")
        .agg(F.expr("coalesce(sum(vl_frete_usd), 0D) AS vl_frete_usd"))
    )
    return share_and_rank_small(by_mode, ["ano", "direcao"], "vl_frete_usd", "peso", "posicao")


@query
def format_kpis(m):
    return analytics.formatted_kpis(m.balance(), None, *PERIOD)


@query
def format_missing(m):
    """Export charges are never known: the texts show the mark for a missing number."""
    yearly = (
        m.trade("ano", "direcao", "vl_fob_usd", "vl_frete_usd")
        .groupBy("ano", "direcao")
        .agg(*marts.sums("vl_fob_usd", "vl_frete_usd"))
    )
    return yearly.selectExpr(
        "ano",
        "direcao",
        f"{usd_billions('vl_frete_usd')} AS frete_bi",
        f"{usd_millions('vl_frete_usd')} AS frete_mi",
        f"{percentage(share('vl_frete_usd', 'vl_fob_usd'), 2)} AS peso_frete",
    )


# -- models --------------------------------------------------------------------


@query
def stg_exports(m):
    return m.staged(EXPORT)


@query
def stg_imports(m):
    return m.staged(IMPORT)


@query
def stg_products(m):
    return staging.products(m.code("NCM"), m.code("NCM_SH"))


@query
def stg_countries(m):
    return m.countries()


@query
def stg_states(m):
    return staging.states(m.code("UF"))


@query
def stg_modes(m):
    return staging.modes(m.code("VIA"))


@query
def stg_customs_units(m):
    return staging.customs_units(m.code("URF"))


@query
def stg_country_blocs(m):
    return m.country_blocs()


@query
def core_trade(m):
    return m.trade()


@query
def core_products(m):
    return m.products()


@query
def mart_trade_balance(m):
    return m.balance()


@query
def mart_exports_by_state(m):
    return m.exports_by_state()


@query
def mart_imports_by_state(m):
    return m.imports_by_state()


@query
def mart_top_products(m):
    return m.top_products()


@query
def mart_economic_blocs(m):
    return m.blocs()


# -- analytic queries ----------------------------------------------------------


@query
def list_states(m):
    return analytics.list_states(m.balance())


@query
def list_blocs(m):
    return analytics.list_blocs(m.blocs())


@query
def year_range(m):
    return analytics.year_range(m.balance())


@query
def warehouse_status(m):
    return analytics.warehouse_status(m.trade("ano", "direcao"))


@query
def warehouse_freshness(m):
    """Status of a published fact; the time itself differs from run to run."""
    config = _warehouse(m)
    pipeline.publish_fact(m.spark, config, {d: m.labelled(d) for d in DIRECTIONS})
    status = pipeline.freshness(m.spark, config.layout)
    return status.withColumn("atualizado_em", F.col("atualizado_em").isNotNull())


@query
def balance_kpis(m):
    return analytics.balance_kpis(m.balance(), None, *PERIOD)


@query
def balance_kpis_states(m):
    return analytics.balance_kpis(m.balance(), STATES, 1997, 1999)


@query
def balance_kpis_empty_period(m):
    return analytics.balance_kpis(m.balance(), None, 1901, 1902)


@query
def balance_monthly_series(m):
    return analytics.balance_monthly_series(m.balance(), STATES, *PERIOD)


@query
def balance_top_states(m):
    return analytics.balance_top_states(m.balance(), (), *PERIOD, TOP_N)


@query
def balance_detail(m):
    return analytics.balance_detail(m.balance(), None, *PERIOD)


def _product_year(m: StarModels, direction: str) -> DataFrame:
    """The fact of one year and direction: a whole group of the product mart."""
    return filters.year_window(filters.direction(m.trade(*PRODUCT_COLUMNS), direction), YEAR, YEAR)


@query
def top_products(m):
    return analytics.top_products_of_fact(m.trade(*PRODUCT_COLUMNS), m.products(), EXPORT, YEAR, TOP_N)


@query
def top_products_mart(m):
    mart = marts.top_products(_product_year(m, EXPORT), m.products())
    return analytics.top_products(mart, EXPORT, YEAR, TOP_N)


@query
def top_chapters(m):
    # The chapter totals use neither share nor rank, so those are not worked out.
    totals = marts.product_totals(_product_year(m, EXPORT))
    return analytics.top_chapters(marts.with_product_names(totals, m.products()), EXPORT, YEAR)


@query
def bloc_annual_series(m):
    return analytics.bloc_annual_series(m.blocs(), BLOCS, EXPORT)


@query
def bloc_annual_share(m):
    return analytics.bloc_annual_share(m.blocs(), EXPORT)


@query
def bloc_detail(m):
    return analytics.bloc_detail(m.blocs(), (), IMPORT)


@query
def top_export_states_year(m):
    return analytics.top_export_states(m.exports_by_state(), YEAR)


@query
def balance_by_year(m):
    return analytics.balance_by_year(m.balance())


def _partner_shares(m: StarModels, partners: tuple[str, ...] | None) -> DataFrame:
    trade = m.trade("ano", "direcao", "co_pais", "vl_fob_usd")
    return analytics.partner_import_share(trade, m.countries(), partners)


@query
def partner_import_share(m):
    return _partner_shares(m, None)


@query
def partner_import_share_selected(m):
    return _partner_shares(m, PARTNERS)


# -- data quality --------------------------------------------------------------


def _warehouse_tests(m: StarModels, kinds: tuple[str, ...] = ()) -> DataFrame:
    """Build the warehouse in shared scratch space, running the tests of some kinds.

    The raw tables are stored first, as the converter does: each test of a model then
    reads a few columns of a table instead of joining the star tables again.
    """
    config = _warehouse(m)
    m.store_raw(config.layout)
    raw = pipeline.stored_raw(m.spark, config.layout)
    return pipeline.build(m.spark, config, raw, quality.select_checks(kinds=kinds))


@query
def dq_not_null(m):
    return _warehouse_tests(m, (quality.NOT_NULL,))


@query
def dq_unique(m):
    models = m.staged_code_tables()
    models["core_produtos"] = core.products(models["stg_ncm"])
    return quality.report(models, quality.select_checks(kinds=[quality.UNIQUE]))


@query
def dq_accepted_values(m):
    return _warehouse_tests(m, (quality.ACCEPTED,))


@query
def dq_relationships(m):
    models = m.staged_code_tables() | {
        "stg_exportacoes": m.staged(EXPORT, "co_ncm", "co_pais", "sg_uf"),
        "stg_importacoes": m.staged(IMPORT, "co_ncm", "co_pais"),
        "core_comercio": m.trade("ano", "co_ncm"),
        "core_produtos": m.products(),
    }
    return quality.report(models, quality.select_checks(kinds=[quality.RELATIONSHIPS]))


@query
def dq_grain(m):
    """Keys of the marts from totals stored once; share and rank add no rows, so they are not worked out."""
    layout = JobConfig(landing_root="", warehouse_root=scratch_dir(m.spark, "warehouse")).layout
    totals = pipeline.stored_totals(m.spark, layout, m.trade(*TOTAL_COLUMNS))
    states = totals["estado_mes"]
    marts_only = {
        "mart_balanca_comercial": marts.trade_balance(states),
        "mart_exportacoes_por_estado": marts.state_month_totals(states, EXPORT, "vl_fob_usd"),
        "mart_importacoes_por_estado": marts.state_month_totals(states, IMPORT, "vl_fob_usd"),
        "mart_top_produtos": marts.with_product_names(totals["produto_ano"], m.products()),
        "mart_blocos_economicos": marts.economic_blocs(totals["pais_mes"], m.country_blocs()),
    }
    return quality.report(marts_only, quality.select_checks(kinds=[quality.COMBINATION]))


@query
def dq_report(m):
    return _warehouse_tests(m)
