"""Typed views of the raw tables; always lazy.

Raw rows that come with a stored integer ``ano`` are filtered on that column, so that the
scan can leave out what lies outside the window; otherwise the year is read from the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from fairlead.functions.codes import YEAR, cif, code, money, month_start, text, whole
from fairlead.operators.filters import year_window


def exports(raw: DataFrame, first_year: int, last_year: int, *keep: str) -> DataFrame:
    return _trade(raw, first_year, last_year, [*keep])


def imports(raw: DataFrame, first_year: int, last_year: int, *keep: str) -> DataFrame:
    charges = [
        money("VL_FRETE", "vl_frete_usd"),
        money("VL_SEGURO", "vl_seguro_usd"),
        cif("VL_FOB", ("VL_FRETE", "VL_SEGURO"), "vl_cif_usd"),
    ]
    return _trade(raw, first_year, last_year, [*charges, *keep])


def dated(raw: DataFrame) -> DataFrame:
    """``raw`` with its year as an integer; a year that is no number is an error."""
    return raw if "ano" in raw.columns else raw.selectExpr("*", f"{YEAR} AS ano")


def _trade(raw: DataFrame, first_year: int, last_year: int, more: list[str]) -> DataFrame:
    return year_window(dated(raw), first_year, last_year).selectExpr(
        "ano",
        code("CO_MES", "mes"),
        month_start("CO_ANO", "CO_MES", "data_ref"),
        code("CO_NCM", "co_ncm"),
        text("CO_UNID", "co_unid"),
        code("CO_PAIS", "co_pais"),
        text("SG_UF_NCM", "sg_uf"),
        text("CO_VIA", "co_via"),
        code("CO_URF", "co_urf"),
        whole("QT_ESTAT", "qt_estat"),
        whole("KG_LIQUIDO", "kg_liquido"),
        money("VL_FOB", "vl_fob_usd"),
        *more,
    )


def products(ncm: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """Products with their classification; unknown subheadings keep NULL names."""
    items = ncm.selectExpr(
        code("CO_NCM", "co_ncm"),
        text("NO_NCM_POR", "no_ncm_pt"),
        text("CO_UNID", "co_unid"),
        code("CO_SH6", "co_sh6"),
    )
    levels = hierarchy.selectExpr(
        code("CO_SH6", "co_sh6"),
        code("CO_SH4", "co_sh4"),
        code("CO_SH2", "co_sh2"),
        text("NO_SH6_POR", "no_sh6_pt"),
        text("NO_SH4_POR", "no_sh4_pt"),
        text("NO_SH2_POR", "no_sh2_pt"),
    )
    return items.join(levels, "co_sh6", "left").select(
        "co_ncm",
        "no_ncm_pt",
        "co_unid",
        "co_sh6",
        "co_sh4",
        "co_sh2",
        "no_sh6_pt",
        "no_sh4_pt",
        "no_sh2_pt",
    )


def countries(pais: DataFrame) -> DataFrame:
    return pais.selectExpr(
        code("CO_PAIS", "co_pais"),
        code("CO_PAIS_ISON3", "co_pais_ison3"),
        text("CO_PAIS_ISOA3", "co_pais_isoa3"),
        text("NO_PAIS", "no_pais"),
        text("NO_PAIS_ING", "no_pais_en"),
        text("NO_PAIS_ESP", "no_pais_es"),
    )


def states(uf: DataFrame) -> DataFrame:
    return uf.selectExpr(
        text("SG_UF", "sg_uf"), text("CO_UF", "co_uf"), text("NO_UF", "no_uf"), text("NO_REGIAO", "no_regiao")
    )


def modes(via: DataFrame) -> DataFrame:
    return via.selectExpr(text("CO_VIA", "co_via"), text("NO_VIA", "no_via"))


def customs_units(urf: DataFrame) -> DataFrame:
    return urf.selectExpr(code("CO_URF", "co_urf"), text("NO_URF", "no_urf"))


def country_blocs(pais_bloco: DataFrame) -> DataFrame:
    """(country, bloc) pairs; a country may appear several times."""
    return pais_bloco.selectExpr(
        code("CO_PAIS", "co_pais"), text("CO_BLOCO", "co_bloco"), text("NO_BLOCO", "no_bloco")
    )
