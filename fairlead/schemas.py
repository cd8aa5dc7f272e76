"""Column contracts of the raw files, the fact and the marts.

The names, widths and value lists below are fixed values: they are the public
data contract and must not be changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXPORT = "EXP"
IMPORT = "IMP"
DIRECTIONS = (EXPORT, IMPORT)

MONTHS = tuple(f"{month:02d}" for month in range(1, 13))

CODE_TABLES = ("NCM", "NCM_SH", "PAIS", "PAIS_BLOCO", "UF", "VIA", "URF")

# Width of every zero-padded code.
CODE_WIDTHS = {
    "mes": 2,
    "co_ncm": 8,
    "co_pais": 3,
    "co_pais_ison3": 3,
    "co_urf": 7,
    "co_sh6": 6,
    "co_sh4": 4,
    "co_sh2": 2,
}


RAW_EXPORTS = T.StructType(
    [
        T.StructField("CO_ANO", T.StringType()),
        T.StructField("CO_MES", T.StringType()),
        T.StructField("CO_NCM", T.StringType()),
        T.StructField("CO_UNID", T.StringType()),
        T.StructField("CO_PAIS", T.StringType()),
        T.StructField("SG_UF_NCM", T.StringType()),
        T.StructField("CO_VIA", T.StringType()),
        T.StructField("CO_URF", T.StringType()),
        T.StructField("QT_ESTAT", T.LongType()),
        T.StructField("KG_LIQUIDO", T.LongType()),
        T.StructField("VL_FOB", T.LongType()),
    ]
)
RAW_IMPORTS = T.StructType(
    [
        *RAW_EXPORTS.fields,
        T.StructField("VL_FRETE", T.LongType()),
        T.StructField("VL_SEGURO", T.LongType()),
    ]
)
RAW_TRADE = {EXPORT: RAW_EXPORTS, IMPORT: RAW_IMPORTS}

TRADE = T.StructType(
    [
        T.StructField("ano", T.IntegerType()),
        T.StructField("mes", T.StringType()),
        T.StructField("data_ref", T.DateType()),
        T.StructField("direcao", T.StringType()),
        T.StructField("co_ncm", T.StringType()),
        T.StructField("co_unid", T.StringType()),
        T.StructField("co_pais", T.StringType()),
        T.StructField("sg_uf", T.StringType()),
        T.StructField("co_via", T.StringType()),
        T.StructField("co_urf", T.StringType()),
        T.StructField("qt_estat", T.LongType()),
        T.StructField("kg_liquido", T.LongType()),
        T.StructField("vl_fob_usd", T.DoubleType()),
        T.StructField("vl_frete_usd", T.DoubleType()),
        T.StructField("vl_seguro_usd", T.DoubleType()),
        T.StructField("vl_cif_usd", T.DoubleType()),
    ]
)

# One row per listed key in every mart.
MART_GRAINS = {
    "mart_balanca_comercial": ("ano", "mes", "sg_uf"),
    "mart_exportacoes_por_estado": ("ano", "mes", "sg_uf"),
    "mart_importacoes_por_estado": ("ano", "mes", "sg_uf"),
    "mart_top_produtos": ("ano", "direcao", "co_ncm"),
    "mart_blocos_economicos": ("ano", "mes", "direcao", "co_bloco"),
}


def conform(df: DataFrame, schema: T.StructType, *keep: str | Column) -> DataFrame:
    """Select ``schema`` by name, casting each column and filling absent ones with NULL.

    Casting before any union matters: a union of a string code with a numeric one
    widens to the number and drops the leading zeros.
    """
    present = set(df.columns)
    fields = [
        f"CAST({f.name if f.name in present else 'NULL'} AS {f.dataType.simpleString()}) AS {f.name}"
        for f in schema.fields
    ]
    return df.select(*[F.expr(x) if isinstance(x, str) else x for x in (*fields, *keep)])
