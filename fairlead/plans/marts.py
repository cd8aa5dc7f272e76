"""The five aggregates.

Each aggregates the fact before anything else, so what reaches a join or a window has
one row per key of the mart, not per transaction; partial aggregation makes a hot
state, product or country cheap to shuffle.

Totals keep the column names of what they sum, so a mart can be built from the fact or
from stored totals of it: ``trade_balance(state_months(fact))`` equals
``trade_balance(fact)``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairlead.operators import filters
from fairlead.operators.ranking import share_and_rank, share_and_rank_small, top_ranked
from fairlead.schemas import EXPORT, IMPORT

MONTH = ("ano", "mes", "data_ref")


@dataclass(frozen=True)
class Total:
    keys: tuple[str, ...]
    measures: tuple[str, ...]


# What the marts are made of: sums of the fact by these keys.
TOTALS = {
    "estado_mes": Total((*MONTH, "sg_uf", "direcao"), ("vl_fob_usd", "vl_cif_usd", "kg_liquido")),
    "produto_ano": Total(("ano", "direcao", "co_ncm"), ("vl_fob_usd", "kg_liquido")),
    "pais_mes": Total((*MONTH, "direcao", "co_pais"), ("vl_fob_usd", "kg_liquido")),
}
# Rows of the fact behind a total.
ROWS = "linhas"


def file_totals(name: str, trade: DataFrame, file: str) -> DataFrame:
    """A total of the fact for each published file (column ``file``) on its own, with the rows behind it."""
    total = TOTALS[name]
    return trade.groupBy(file, *total.keys).agg(*sums(*total.measures), F.expr(f"count(1) AS {ROWS}"))


def added(name: str, totals: DataFrame) -> DataFrame:
    """The totals of all files as one: files may share a key, as rows can lie in the file of another year."""
    total = TOTALS[name]
    return totals.groupBy(*total.keys).agg(*sums(*total.measures, ROWS))


def sums(*measures: str) -> list[Column]:
    return [F.expr(f"sum({measure}) AS {measure}") for measure in measures]


def state_months(trade: DataFrame) -> DataFrame:
    """Totals per month, state and direction: all that the three state marts need."""
    return trade.groupBy(*TOTALS["estado_mes"].keys).agg(*sums(*TOTALS["estado_mes"].measures))


def trade_balance(trade: DataFrame) -> DataFrame:
    """Exports, imports, balance and flow (FOB) per month and state."""

    sides = trade.groupBy(*MONTH, "sg_uf").agg(
        *[
            F.expr(f"sum(if(direcao = '{direction}', vl_fob_usd, 0D)) AS {name}")
            for direction, name in ((EXPORT, "vl_exp_fob_usd"), (IMPORT, "vl_imp_fob_usd"))
        ]
    )
    return sides.selectExpr(
        "*",
        "vl_exp_fob_usd - vl_imp_fob_usd AS saldo_fob_usd",
        "vl_exp_fob_usd + vl_imp_fob_usd AS corrente_comercio_usd",
    )


def state_month_totals(trade: DataFrame, direction: str, *measures: str) -> DataFrame:
    return (
        filters.direction(trade, direction)
        .groupBy(*MONTH, "sg_uf")
        .agg(*sums(*measures))
    )


def exports_by_state(trade: DataFrame) -> DataFrame:
    return _ranked_states(state_month_totals(trade, EXPORT, "vl_fob_usd", "kg_liquido"))


def imports_by_state(trade: DataFrame) -> DataFrame:
    return _ranked_states(state_month_totals(trade, IMPORT, "vl_fob_usd", "vl_cif_usd", "kg_liquido"))


def _ranked_states(totals: DataFrame) -> DataFrame:
    return share_and_rank_small(totals, ["ano", "mes"], "vl_fob_usd", "share_nacional_mes", "rank_mes")


def product_totals(trade: DataFrame) -> DataFrame:
    return trade.groupBy(*TOTALS["produto_ano"].keys).agg(*sums(*TOTALS["produto_ano"].measures))


def with_product_names(totals: DataFrame, products: DataFrame) -> DataFrame:
    """Products missing from the dimension keep NULL names."""
    names = products.select("co_ncm", "no_ncm_pt", "co_sh2", "no_sh2_pt", "co_sh4", "no_sh4_pt")
    return totals.join(names, "co_ncm", "left")


PRODUCT_GROUP = ("ano", "direcao")


def with_product_rank(totals: DataFrame) -> DataFrame:
    return share_and_rank(totals, PRODUCT_GROUP, "vl_fob_usd", "share_direcao_ano", "rank_ano_direcao")


def top_products(trade: DataFrame, products: DataFrame) -> DataFrame:
    """Products per year and direction with names, share and rank."""
    return named_top_products(product_totals(trade), products)


def named_top_products(totals: DataFrame, products: DataFrame) -> DataFrame:
    """The same from ``product_totals``.

    Share and rank come before the names; the unique test on the dimension keeps a repeated
    product from repeating rows.
    """
    return _product_columns(with_product_rank(totals), products)


def leading_products(trade: DataFrame, products: DataFrame, top_n: int) -> DataFrame:
    """The rows of ``top_products`` ranked ``top_n`` or better, without ranking the others."""
    best = top_ranked(
        product_totals(trade), PRODUCT_GROUP, "vl_fob_usd", top_n, "share_direcao_ano", "rank_ano_direcao"
    )
    return _product_columns(best, products)


def _product_columns(ranked: DataFrame, products: DataFrame) -> DataFrame:
    return with_product_names(ranked, products).select(
        "ano",
        "direcao",
        "co_ncm",
        "no_ncm_pt",
        "co_sh2",
        "no_sh2_pt",
        "co_sh4",
        "no_sh4_pt",
        "vl_fob_usd",
        "kg_liquido",
        "share_direcao_ano",
        "rank_ano_direcao",
    )


def country_month_totals(trade: DataFrame) -> DataFrame:
    return trade.groupBy(*TOTALS["pais_mes"].keys).agg(*sums(*TOTALS["pais_mes"].measures))


def fan_out_blocs(totals: DataFrame, blocs: DataFrame) -> DataFrame:
    """One row per bloc of each country; countries in no bloc drop out."""
    return totals.join(blocs, "co_pais", "inner")


def economic_blocs(trade: DataFrame, blocs: DataFrame) -> DataFrame:
    """Trade per month, direction and bloc; blocs overlap, so never add them up.

    The fact is summed by country first: the fan-out then touches one row per country
    and month instead of one per transaction, with the same sums.
    """
    return (
        fan_out_blocs(country_month_totals(trade), blocs)
        .groupBy(*MONTH, "direcao", "co_bloco", "no_bloco")
        .agg(*sums("vl_fob_usd", "kg_liquido"))
    )
