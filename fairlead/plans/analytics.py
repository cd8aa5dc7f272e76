"""Parametrised queries over the marts.

Every function returns a DataFrame. A filter given as None or empty is no filter.
Sorted results put NULL last in ascending order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairlead.functions.codes import share
from fairlead.functions.formats import percentage, usd_billions, usd_millions, whole_number
from fairlead.operators import filters
from fairlead.plans import marts
from fairlead.schemas import IMPORT

Names = Sequence[str] | None

# Total of a year over rows already summed per year and bloc or country.
_YEAR_TOTAL = "sum(vl_fob_usd) OVER (PARTITION BY ano)"


_up = F.asc_nulls_last
_down = F.desc_nulls_last


def _exprs(*texts: str) -> list[Column]:
    return [F.expr(text) for text in texts]


# -- catalogue -----------------------------------------------------------------


def list_states(balance: DataFrame) -> DataFrame:
    return balance.where("sg_uf IS NOT NULL").select("sg_uf").distinct().orderBy(_up("sg_uf"))


def list_blocs(blocs: DataFrame) -> DataFrame:
    return blocs.select("co_bloco", "no_bloco").distinct().orderBy(_up("no_bloco"), _up("co_bloco"))


def year_range(balance: DataFrame) -> DataFrame:
    return balance.agg(*_exprs("min(ano) AS ano_min", "max(ano) AS ano_max"))


def warehouse_status(trade: DataFrame) -> DataFrame:
    return trade.agg(
        *_exprs("count(1) AS linhas_core", "min(ano) AS ano_min", "max(ano) AS ano_max")
    )


# -- trade balance -------------------------------------------------------------


def _period(balance: DataFrame, states: Names, first_year: int, last_year: int) -> DataFrame:
    return filters.any_of(filters.year_window(balance, first_year, last_year), "sg_uf", states)


_SIDES = (
    "sum(vl_exp_fob_usd) AS exp_usd",
    "sum(vl_imp_fob_usd) AS imp_usd",
    "sum(saldo_fob_usd) AS saldo_usd",
)
_FLOW = "sum(corrente_comercio_usd) AS corrente_usd"


def balance_kpis(balance: DataFrame, states: Names, first_year: int, last_year: int) -> DataFrame:
    """One row: total balance and flow, states in surplus, states. One pass over the mart."""
    by_state = (
        _period(balance, states, first_year, last_year)
        .groupBy("sg_uf")
        .agg(*_exprs("sum(saldo_fob_usd) AS saldo", "sum(corrente_comercio_usd) AS corrente"))
    )
    return by_state.agg(
        *_exprs(
            "sum(saldo) AS saldo_total",
            "sum(corrente) AS corrente_total",
            "count_if(saldo > 0) AS ufs_positivas",
            "count(1) AS ufs_total",
        )
    )


def balance_monthly_series(
    balance: DataFrame, states: Names, first_year: int, last_year: int
) -> DataFrame:
    return (
        _period(balance, states, first_year, last_year)
        .groupBy("data_ref")
        .agg(*_exprs(*_SIDES, _FLOW))
        .orderBy(_up("data_ref"))
    )


def balance_top_states(
    balance: DataFrame, states: Names, first_year: int, last_year: int, top_n: int = 10
) -> DataFrame:
    """Exactly ``top_n`` states; equal balances are ordered by state."""
    return (
        _period(balance, states, first_year, last_year)
        .groupBy("sg_uf")
        .agg(*_exprs(*_SIDES))
        .orderBy(_down("saldo_usd"), _up("sg_uf"))
        .limit(top_n)
    )


def balance_detail(balance: DataFrame, states: Names, first_year: int, last_year: int) -> DataFrame:
    return (
        _period(balance, states, first_year, last_year)
        .groupBy("ano", "sg_uf")
        .agg(*_exprs(*_SIDES, _FLOW))
        .orderBy(_up("ano"), _down("saldo_usd"))
    )


def balance_by_year(balance: DataFrame) -> DataFrame:
    return (
        balance.groupBy("ano")
        .agg(
            *_exprs(
                "sum(vl_exp_fob_usd) / 1e9D AS exp_bi",
                "sum(vl_imp_fob_usd) / 1e9D AS imp_bi",
                "sum(saldo_fob_usd) / 1e9D AS saldo_bi",
            )
        )
        .orderBy(_up("ano"))
    )


def top_export_states(exports_by_state: DataFrame, year: int, top_n: int = 5) -> DataFrame:
    return (
        filters.year_window(exports_by_state, year, year)
        .groupBy("sg_uf")
        .agg(F.expr("sum(vl_fob_usd) / 1e9D AS exp_bilhoes_usd"))
        .orderBy(_down("exp_bilhoes_usd"), _up("sg_uf"))
        .limit(top_n)
    )


def formatted_kpis(balance: DataFrame, states: Names, first_year: int, last_year: int) -> DataFrame:
    """Yearly KPIs as text: billions, millions, export share of the flow, states."""
    yearly = (
        _period(balance, states, first_year, last_year)
        .groupBy("ano")
        .agg(*_exprs(*_SIDES, _FLOW, "count(1) AS linhas"))
    )
    return yearly.selectExpr(
        "ano",
        f"{usd_billions('corrente_usd')} AS corrente",
        f"{usd_millions('saldo_usd')} AS saldo",
        f"{percentage(share('exp_usd', 'corrente_usd'))} AS peso_exp",
        f"{whole_number('linhas')} AS linhas",
    ).orderBy(_up("ano"))


# -- products ------------------------------------------------------------------


def _product_year(products: DataFrame, direction: str, year: int) -> DataFrame:
    return filters.year_window(filters.direction(products, direction), year, year)


def top_products(products: DataFrame, direction: str, year: int, top_n: int) -> DataFrame:
    """Products ranked ``top_n`` or better; a tie at the limit returns more rows."""
    return (
        _product_year(products, direction, year)
        .where(F.col("rank_ano_direcao") <= top_n)
        .select(
            "co_ncm",
            "no_ncm_pt",
            "co_sh2",
            "no_sh2_pt",
            "vl_fob_usd",
            "kg_liquido",
            "share_direcao_ano",
            "rank_ano_direcao",
        )
        .orderBy(_up("rank_ano_direcao"))
    )


def top_products_of_fact(
    trade: DataFrame, products: DataFrame, direction: str, year: int, top_n: int
) -> DataFrame:
    """The same from the fact, for where no mart is stored: only the leading products are ranked and named."""
    return top_products(marts.leading_products(_product_year(trade, direction, year), products, top_n), direction, year, top_n)


def top_chapters(products: DataFrame, direction: str, year: int) -> DataFrame:
    """FOB per chapter; unknown chapters form one row, chapters without value go."""
    return (
        _product_year(products, direction, year)
        .groupBy("co_sh2", "no_sh2_pt")
        .agg(F.expr("sum(vl_fob_usd) AS vl_fob_usd"))
        .where("vl_fob_usd > 0")
        .orderBy(_down("vl_fob_usd"))
    )


# -- economic blocs ------------------------------------------------------------


def _bloc_rows(blocs: DataFrame, codes: Names, direction: str) -> DataFrame:
    return filters.any_of(filters.direction(blocs, direction), "co_bloco", codes)


def _bloc_years(blocs: DataFrame, codes: Names, direction: str) -> DataFrame:
    rows = _bloc_rows(blocs, codes, direction)
    return rows.groupBy("ano", "no_bloco").agg(F.expr("sum(vl_fob_usd) AS vl_fob_usd"))


def bloc_annual_series(blocs: DataFrame, codes: Names, direction: str) -> DataFrame:
    """By bloc name: codes that share a name are merged."""
    return _bloc_years(blocs, codes, direction).orderBy(_up("ano"), _up("no_bloco"))


def bloc_annual_share(blocs: DataFrame, direction: str) -> DataFrame:
    """Weight of each bloc in the year's total over all blocs, overlaps included."""
    by_name = _bloc_years(blocs, None, direction)
    return by_name.selectExpr("*", f"{share('vl_fob_usd', _YEAR_TOTAL)} AS share_ano").orderBy(
        _up("ano"), _up("no_bloco")
    )


def bloc_detail(blocs: DataFrame, codes: Names, direction: str) -> DataFrame:
    return (
        _bloc_rows(blocs, codes, direction)
        .groupBy("ano", "mes", "no_bloco", "direcao")
        .agg(*_exprs("sum(vl_fob_usd) AS vl_fob_usd", "sum(kg_liquido) AS kg_liquido"))
        .orderBy(_up("ano"), _up("mes"), _down("vl_fob_usd"))
    )


# -- partners ------------------------------------------------------------------


def partner_import_share(trade: DataFrame, countries: DataFrame, partners: Names = None) -> DataFrame:
    """Each country's share of a year's imports; ``partners`` are country codes.

    The share is taken before the filter, so its whole is every import of the year.
    """
    by_country = (
        filters.direction(trade, IMPORT)
        .groupBy("ano", "co_pais")
        .agg(F.expr("sum(vl_fob_usd) AS vl_fob_usd"))
    )
    shares = by_country.selectExpr("*", f"{share('vl_fob_usd', _YEAR_TOTAL)} AS share_importacoes")
    return (
        filters.any_of(shares, "co_pais", partners)
        .join(countries.select("co_pais", "no_pais"), "co_pais", "left")
        .select("ano", "co_pais", "no_pais", "vl_fob_usd", "share_importacoes")
        .orderBy(_up("ano"), _down("vl_fob_usd"), _up("co_pais"))
    )
