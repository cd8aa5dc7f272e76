"""Raw trade tables derived from an order-processing star schema.

Lets every model run on tables that hold no trade statistics: line items with open
status become exports, filled ones imports. The mapping keeps the raw contract's
awkward spots on purpose (numeric unpadded codes, missing freight, products without a
dimension row, countries in two blocs or in none).

The dimension lookups are left joins on a primary key, so they neither drop nor repeat
line items. A lookup whose columns nobody asked for is therefore left out.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairlead.schemas import EXPORT, IMPORT, RAW_TRADE

# Line status of each direction (fixed values of the mapping).
STATUS = {EXPORT: "O", IMPORT: "F"}


class StarTables:
    """The star tables of one folder; each is listed and its schema read only once."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self._opened: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._opened[name]


def raw_trade(
    tables: StarTables, direction: str, columns: Collection[str] | None = None
) -> DataFrame:
    """Raw exports or imports; ``columns`` lists the raw columns to fill, the others come back as NULL."""
    schema = RAW_TRADE[direction]
    wanted = set(schema.names if columns is None else columns)
    lines = tables["lineitem"].where(f"l_linestatus = '{STATUS[direction]}'")
    if wanted & {"CO_UNID", "SG_UF_NCM"}:
        parts = tables["part"].select("p_partkey", "p_brand", "p_size")
        lines = lines.join(parts, F.expr("l_partkey = p_partkey"), "left")
    if "CO_PAIS" in wanted:
        lines = _with_country(tables, lines, direction)

    return lines.selectExpr(
        *[
            f"{_FILLED[f.name]} AS {f.name}"
            if f.name in wanted
            else f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}"
            for f in schema.fields
        ]
    )


def _with_country(tables: StarTables, lines: DataFrame, direction: str) -> DataFrame:
    if direction == IMPORT:
        suppliers = tables["supplier"].selectExpr("s_suppkey", "s_nationkey AS _country")
        return lines.join(suppliers, F.expr("l_suppkey = s_suppkey"), "left")
    # Customers meet the orders first: line items, the largest table, move only once.
    customers = tables["customer"].selectExpr("c_custkey", "c_nationkey AS _country")
    buyers = (
        tables["orders"]
        .join(customers, F.expr("o_custkey = c_custkey"), "left")
        .select("o_orderkey", "_country")
    )
    return lines.join(buyers, F.expr("l_orderkey = o_orderkey"), "left")


_FILLED = {
    "CO_ANO": "string(year(l_shipdate))",
    "CO_MES": "lpad(string(month(l_shipdate)), 2, '0')",
    "CO_NCM": "l_partkey",
    "CO_UNID": "string(p_size)",
    "CO_PAIS": "_country",
    "SG_UF_NCM": "p_brand",
    "CO_VIA": "l_returnflag",
    "CO_URF": "l_suppkey",
    "QT_ESTAT": "bigint(l_linenumber)",
    "KG_LIQUIDO": "bigint(l_quantity)",
    "VL_FOB": "bigint(round(l_extendedprice * 100))",
    "VL_FRETE": "nullif(bigint(round(l_extendedprice * l_tax * 100)), 0)",
    "VL_SEGURO": "nullif(bigint(round(l_extendedprice * l_discount * 10)), 0)",
}


def code_table(tables: StarTables, name: str) -> DataFrame:
    return _CODE_TABLES[name](tables)


def _products(tables: StarTables) -> DataFrame:
    # Every 97th part is left out of the dimension: trade rows without a product.
    return tables["part"].where("p_partkey % 97 != 0").selectExpr(
        "p_partkey AS CO_NCM",
        "p_size AS CO_SH6",
        "string(p_size) AS CO_UNID",
        "p_name AS NO_NCM_POR",
    )


def _hierarchy(tables: StarTables) -> DataFrame:
    # Size 50 is left out: products whose hierarchy is unknown.
    sizes = tables["part"].where("p_size != 50").select("p_size").distinct()
    return sizes.selectExpr(
        "p_size AS CO_SH6",
        "p_size div 5 AS CO_SH4",
        "p_size div 25 AS CO_SH2",
        "concat('SH6 ', p_size) AS NO_SH6_POR",
        "concat('SH4 ', p_size div 5) AS NO_SH4_POR",
        "concat('SH2 ', p_size div 25) AS NO_SH2_POR",
    )


def _countries(tables: StarTables) -> DataFrame:
    return tables["nation"].selectExpr(
        "n_nationkey AS CO_PAIS",
        "n_nationkey AS CO_PAIS_ISON3",
        "concat('N', n_nationkey) AS CO_PAIS_ISOA3",
        "n_name AS NO_PAIS",
        "n_name AS NO_PAIS_ING",
        "n_name AS NO_PAIS_ESP",
    )


def _country_blocs(tables: StarTables) -> DataFrame:
    # Country 24 is in no bloc; even ones are in their region's bloc and in CROSS.
    nations = tables["nation"].where("n_nationkey != 24")
    regional = nations.join(tables["region"], F.expr("n_regionkey = r_regionkey"), "inner")
    crossing = nations.where("n_nationkey % 2 = 0")
    return regional.selectExpr(
        "n_nationkey AS CO_PAIS", "n_regionkey + 10 AS CO_BLOCO", "r_name AS NO_BLOCO"
    ).unionByName(
        crossing.selectExpr("n_nationkey AS CO_PAIS", "99 AS CO_BLOCO", "'CROSS' AS NO_BLOCO")
    )


def _states(tables: StarTables) -> DataFrame:
    brands = tables["part"].select("p_brand").distinct()
    return brands.selectExpr(
        "p_brand AS SG_UF",
        "substring_index(p_brand, '#', -1) AS CO_UF",
        "p_brand AS NO_UF",
        "concat('R', int(substring_index(p_brand, '#', -1)) % 5) AS NO_REGIAO",
    )


def _modes(tables: StarTables) -> DataFrame:
    flags = tables["lineitem"].select("l_returnflag").distinct()
    return flags.selectExpr("l_returnflag AS CO_VIA", "concat('VIA ', l_returnflag) AS NO_VIA")


def _customs_units(tables: StarTables) -> DataFrame:
    return tables["supplier"].selectExpr("s_suppkey AS CO_URF", "s_name AS NO_URF")


_CODE_TABLES = {
    "NCM": _products,
    "NCM_SH": _hierarchy,
    "PAIS": _countries,
    "PAIS_BLOCO": _country_blocs,
    "UF": _states,
    "VIA": _modes,
    "URF": _customs_units,
}
