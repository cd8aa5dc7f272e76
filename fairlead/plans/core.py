"""The unified trade fact and the product dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fairlead.schemas import EXPORT, IMPORT, TRADE, conform


def trade(exports: DataFrame, imports: DataFrame, *keep: str) -> DataFrame:
    """Both directions in one bag: duplicates stay, exports have NULL charges; ``keep`` names further columns."""
    outgoing = conform(exports.selectExpr("*", f"'{EXPORT}' AS direcao"), TRADE, *keep)
    incoming = conform(imports.selectExpr("*", f"'{IMPORT}' AS direcao"), TRADE, *keep)
    return outgoing.unionByName(incoming)


def products(staged: DataFrame) -> DataFrame:
    return staged.select(
        "co_ncm",
        "no_ncm_pt",
        "co_unid",
        "co_sh2",
        "no_sh2_pt",
        "co_sh4",
        "no_sh4_pt",
        "co_sh6",
        "no_sh6_pt",
    )
