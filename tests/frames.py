"""Small hand-built tables."""

from pyspark.sql import types as T

from fairlead.schemas import RAW_EXPORTS, RAW_IMPORTS, TRADE


def raw_exports(spark, *rows):
    return _frame(spark, RAW_EXPORTS, rows, CO_ANO="2020", CO_MES="01", CO_NCM="1", CO_PAIS="1", CO_URF="1")


def raw_imports(spark, *rows):
    return _frame(spark, RAW_IMPORTS, rows, CO_ANO="2020", CO_MES="01", CO_NCM="1", CO_PAIS="1", CO_URF="1")


def trade(spark, *rows):
    return _frame(spark, TRADE, rows, ano=2020, mes="01", direcao="EXP")


def table(spark, columns, *rows):
    """``columns`` is a DDL schema."""
    return spark.createDataFrame(rows, columns)


def rows_of(df, *columns):
    names = columns or df.columns
    return sorted((tuple(row[c] for c in names) for row in df.collect()), key=repr)


def _frame(spark, schema: T.StructType, rows, **defaults):
    values = [tuple({**defaults, **row}.get(name) for name in schema.names) for row in rows]
    return spark.createDataFrame(values, schema)
