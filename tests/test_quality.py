"""Each kind of test on rows that break it."""

from collections import Counter

from frames import rows_of, table, trade

from fairlead.plans import quality
from fairlead.plans.quality import Check


def failures(models, check):
    return [row.failures for row in quality.report(models, [check]).collect()]


def test_declared_tests():
    kinds = Counter(c.kind for c in quality.CHECKS)
    assert kinds == {"not_null": 43, "unique": 6, "accepted_values": 5, "relationships": 6}
    layers = Counter(c.layer for c in quality.CHECKS)
    assert layers == {"staging": 31, "core": 10, "marts": 19}
    assert all((c.severity == "warn") == (c.kind == "relationships") for c in quality.CHECKS)
    assert len(quality.GRAIN_CHECKS) == 5


def test_not_null_counts_rows(spark):
    models = {"m": table(spark, "k string", ("a",), (None,), (None,))}
    assert failures(models, Check("core", "m", "not_null", ("k",))) == [2]


def test_unique_counts_repeated_keys_and_ignores_null(spark):
    models = {"m": table(spark, "k string", ("a",), ("a",), ("a",), ("b",), (None,), (None,))}
    assert failures(models, Check("core", "m", "unique", ("k",))) == [1]


def test_accepted_values_counts_unexpected_values_and_ignores_null(spark):
    models = {"core_comercio": trade(spark, *[{"direcao": d} for d in ("EXP", "X", "X", "Y", None)])}
    check = next(c for c in quality.CHECKS if c.model == "core_comercio" and c.kind == "accepted_values")
    assert failures(models, check) == [2]


def test_month_13_is_reported(spark):
    models = {"stg_exportacoes": trade(spark, {"mes": "13"}, {"mes": "12"})}
    check = next(c for c in quality.CHECKS if c.model == "stg_exportacoes" and c.kind == "accepted_values")
    assert failures(models, check) == [1]


def test_relationships_count_orphan_rows_and_only_warn(spark):
    models = {
        "child": table(spark, "k string", ("a",), ("x",), ("x",), ("y",), (None,)),
        "parent": table(spark, "k string", ("a",), (None,)),
    }
    check = Check("core", "child", "relationships", ("k",), parent="parent", severity="warn")
    results = quality.report(models, [check])
    assert rows_of(results, "failures", "status") == [(3, "warn")]
    quality.enforce(results)


def test_grain_finds_one_bloc_code_with_two_names(spark):
    rows = [(2020, "01", "EXP", "10", "EU"), (2020, "01", "EXP", "10", "Europe"), (2020, "02", "EXP", "10", "EU")]
    mart = table(spark, "ano int, mes string, direcao string, co_bloco string, no_bloco string", *rows)
    check = next(c for c in quality.GRAIN_CHECKS if c.model == "mart_blocos_economicos")
    assert failures({"mart_blocos_economicos": mart}, check) == [1]
