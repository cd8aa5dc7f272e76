"""Every registered query against its SQL, run by DuckDB on the same tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from checks import oracle, registry

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    return con


SPARK_KINDS = {
    "VARCHAR": "string",
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "DATE": "date",
    "BOOLEAN": "boolean",
}


def sortable(row):
    return tuple((value is None, str(type(value)), value if value is not None else 0) for value in row)


@pytest.mark.parametrize("name", sorted(registry.registered()))
def test_matches_sql(spark, duck, name):
    frame = registry.registered()[name](spark, FOLDER)
    columns = sorted(frame.columns)
    rows = [tuple(row[c] for c in columns) for row in frame.collect()]
    result = duck.execute(oracle.statements()[name])
    kinds = {d[0]: SPARK_KINDS[str(d[1])] for d in result.description}
    positions = [[d[0] for d in result.description].index(c) for c in columns]
    expected = [tuple(row[p] for p in positions) for row in result.fetchall()]

    assert kinds == dict(frame.dtypes)
    assert len(rows) == len(expected)
    assert sorted(rows, key=sortable) == sorted(expected, key=sortable)
    assert not any(isinstance(v, float) and math.isnan(v) for row in rows for v in row)


# What each sorted query promises; a minus is descending. NULL comes last in both engines.
SORTED = {
    "list_states": ("sg_uf",),
    "list_blocs": ("no_bloco", "co_bloco"),
    "balance_monthly_series": ("data_ref",),
    "balance_top_states": ("-saldo_usd", "sg_uf"),
    "balance_detail": ("ano", "-saldo_usd"),
    "balance_by_year": ("ano",),
    "top_products": ("rank_ano_direcao",),
    "top_products_mart": ("rank_ano_direcao",),
    "top_chapters": ("-vl_fob_usd",),
    "top_export_states_year": ("-exp_bilhoes_usd", "sg_uf"),
    "bloc_annual_series": ("ano", "no_bloco"),
    "bloc_annual_share": ("ano", "no_bloco"),
    "bloc_detail": ("ano", "mes", "-vl_fob_usd"),
    "partner_import_share": ("ano", "-vl_fob_usd", "co_pais"),
}


@pytest.mark.parametrize("name", SORTED)
def test_sorted_queries_keep_their_order(spark, duck, name):
    """The sort keys of the rows, in the order they come, against the same order in SQL."""
    keys = [key.lstrip("-") for key in SORTED[name]]
    found = [tuple(row[k] for k in keys) for row in registry.registered()[name](spark, FOLDER).collect()]
    order = ", ".join(f"{key.lstrip('-')} {'DESC' if key[0] == '-' else 'ASC'} NULLS LAST" for key in SORTED[name])
    sql = f"SELECT {', '.join(keys)} FROM ({oracle.statements()[name]}) ORDER BY {order}"
    assert found == duck.execute(sql).fetchall()
    assert len(found) > 1


def test_every_statement_belongs_to_a_query():
    assert set(registry.registered()) == set(oracle.statements())
    assert set(registry.registered()) <= set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry_returns_rows(spark):
    assert entry_point.entry(spark).count() > 0
