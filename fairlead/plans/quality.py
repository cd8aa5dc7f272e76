"""Declarative data tests, evaluated as one report DataFrame.

Failure counts: NULL rows (not_null), keys that repeat (unique, unique_combination),
distinct unexpected values (accepted_values), child rows without a parent
(relationships). NULL passes every test but not_null.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairlead.schemas import DIRECTIONS, MART_GRAINS, MONTHS

STAGING = "staging"
CORE = "core"
MARTS = "marts"

NOT_NULL = "not_null"
UNIQUE = "unique"
ACCEPTED = "accepted_values"
RELATIONSHIPS = "relationships"
COMBINATION = "unique_combination"


@dataclass(frozen=True)
class Check:
    layer: str
    model: str
    kind: str
    columns: tuple[str, ...]
    values: tuple[str, ...] = ()
    parent: str = ""
    severity: str = "error"

    @property
    def column(self) -> str:
        return ", ".join(self.columns)


class QualityError(Exception):
    """A test of severity ``error`` failed."""


# The declared tests (fixed values): required columns, keys, value lists and parents.
_REQUIRED = {
    (STAGING, "stg_exportacoes"): ("ano", "mes", "data_ref", "co_ncm", "co_pais", "vl_fob_usd"),
    (STAGING, "stg_importacoes"): ("ano", "mes", "co_ncm", "co_pais", "vl_fob_usd", "vl_cif_usd"),
    (STAGING, "stg_ncm"): ("co_ncm",),
    (STAGING, "stg_paises"): ("co_pais",),
    (STAGING, "stg_uf"): ("sg_uf",),
    (STAGING, "stg_vias"): ("co_via",),
    (STAGING, "stg_urf"): ("co_urf",),
    (STAGING, "stg_blocos"): ("co_pais", "co_bloco"),
    (CORE, "core_comercio"): ("ano", "mes", "direcao", "co_ncm", "co_pais", "vl_fob_usd"),
    (CORE, "core_produtos"): ("co_ncm",),
    (MARTS, "mart_balanca_comercial"): ("ano", "mes", "sg_uf", "saldo_fob_usd"),
    (MARTS, "mart_exportacoes_por_estado"): ("ano", "sg_uf", "rank_mes"),
    (MARTS, "mart_importacoes_por_estado"): ("ano", "sg_uf"),
    (MARTS, "mart_top_produtos"): ("ano", "direcao", "co_ncm", "rank_ano_direcao"),
    (MARTS, "mart_blocos_economicos"): ("ano", "direcao", "co_bloco", "no_bloco"),
}
_KEYS = {
    (STAGING, "stg_ncm"): "co_ncm",
    (STAGING, "stg_paises"): "co_pais",
    (STAGING, "stg_uf"): "sg_uf",
    (STAGING, "stg_vias"): "co_via",
    (STAGING, "stg_urf"): "co_urf",
    (CORE, "core_produtos"): "co_ncm",
}
_VALUE_LISTS = {
    (STAGING, "stg_exportacoes"): ("mes", MONTHS),
    (STAGING, "stg_importacoes"): ("mes", MONTHS),
    (CORE, "core_comercio"): ("direcao", DIRECTIONS),
    (MARTS, "mart_top_produtos"): ("direcao", DIRECTIONS),
    (MARTS, "mart_blocos_economicos"): ("direcao", DIRECTIONS),
}
_PARENTS = {
    (STAGING, "stg_exportacoes"): {"co_ncm": "stg_ncm", "co_pais": "stg_paises", "sg_uf": "stg_uf"},
    (STAGING, "stg_importacoes"): {"co_ncm": "stg_ncm", "co_pais": "stg_paises"},
    (CORE, "core_comercio"): {"co_ncm": "core_produtos"},
}

CHECKS: tuple[Check, ...] = (
    *(Check(*at, NOT_NULL, (c,)) for at, names in _REQUIRED.items() for c in names),
    *(Check(*at, UNIQUE, (c,)) for at, c in _KEYS.items()),
    *(Check(*at, ACCEPTED, (c,), values=v) for at, (c, v) in _VALUE_LISTS.items()),
    *(
        Check(*at, RELATIONSHIPS, (c,), parent=p, severity="warn")
        for at, links in _PARENTS.items()
        for c, p in links.items()
    ),
)
GRAIN_CHECKS = tuple(Check(MARTS, model, COMBINATION, grain) for model, grain in MART_GRAINS.items())


def select_checks(layers: Iterable[str] = (), kinds: Iterable[str] = ()) -> list[Check]:
    """Declared and grain checks of the given layers and kinds; empty means all."""
    layers, kinds = set(layers), set(kinds)
    return [
        c
        for c in CHECKS + GRAIN_CHECKS
        if (not layers or c.layer in layers) and (not kinds or c.kind in kinds)
    ]


def row_counters(checks: Iterable[Check], rows: str = "true") -> dict[Check, Column]:
    """What to observe while a model is written: rows that fail each of its row-level checks.

    ``rows`` limits a model to some of the rows that are written.
    """
    return {
        c: F.count_if(F.expr(f"({rows}) AND {_fails(c)}")) for c in checks if c.kind in (NOT_NULL, ACCEPTED)
    }


def known_failures(observed: Mapping[Check, int]) -> dict[Check, int]:
    """Failures of the checks that the observed rows settle.

    Unexpected values are counted as distinct ones: where there are any, the model must be read.
    """
    return {c: n for c, n in observed.items() if c.kind == NOT_NULL or n == 0}


def report(
    models: Mapping[str, DataFrame],
    checks: Iterable[Check],
    known: Mapping[Check, int] | None = None,
    counted: Mapping[tuple[str, str], DataFrame] | None = None,
) -> DataFrame:
    """One row per check: model, columns, test, severity, failures, status.

    All row-level checks of a model share one aggregate over it, and so do its relationships,
    so a model is scanned once for each of these kinds however many checks there are.
    Failures in ``known`` are not worked out again; ``counted`` gives the rows of a
    model per value of a column (that column and ``linhas``), in place of the model's rows.
    """
    known = known or {}
    checks = list(checks)
    parts = []
    settled = [c for c in checks if c in known]
    if settled:
        rows = [(c.model, c.column, c.kind, c.severity, known[c]) for c in settled]
        spark = next(iter(models.values())).sparkSession
        parts.append(spark.createDataFrame(rows, "model string, columns string, test string, severity string, failures long"))
    checks = [c for c in checks if c not in known]
    for model in dict.fromkeys(c.model for c in checks):
        mine = [c for c in checks if c.model == model]
        row_level = [c for c in mine if c.kind in (NOT_NULL, ACCEPTED)]
        if row_level:
            parts.append(_row_level(models[model], row_level))
        for check in mine:
            if check.kind in (UNIQUE, COMBINATION):
                parts.append(_labelled(_repeated_keys(models[model], check), check))
        links = [c for c in mine if c.kind == RELATIONSHIPS]
        if links:
            parts.append(_orphans(models, links, counted or {}))
    return reduce(DataFrame.unionByName, parts).selectExpr(
        "*",
        "CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status",
    )


def enforce(results: DataFrame) -> None:
    """Raise when an error-severity check failed; the report has one row per check."""
    failed = [
        f"{r['model']}.{r['columns']} {r['test']}: {r['failures']}"
        for r in results.where("status = 'fail'").collect()
    ]
    if failed:
        raise QualityError("; ".join(sorted(failed)))


def _row_level(df: DataFrame, checks: list[Check]) -> DataFrame:
    return _rows_of(df.agg(*[F.expr(f"{_counter(c)} AS n{i}") for i, c in enumerate(checks)]), checks)


def _rows_of(counted: DataFrame, checks: list[Check]) -> DataFrame:
    """One row per check from one row that holds their failures as n0, n1, ..."""
    rows = ", ".join(f"struct({_labels(c)}, n{i} AS failures)" for i, c in enumerate(checks))
    return counted.selectExpr(f"inline(array({rows}))")


def _fails(check: Check) -> str:
    column = check.columns[0]
    if check.kind == NOT_NULL:
        return f"{column} IS NULL"
    values = ", ".join(f"'{value}'" for value in check.values)
    return f"{column} NOT IN ({values})"


def _counter(check: Check) -> str:
    if check.kind == NOT_NULL:
        return f"count_if({_fails(check)})"
    return f"count(DISTINCT if({_fails(check)}, {check.columns[0]}, NULL))"


def _repeated_keys(df: DataFrame, check: Check) -> DataFrame:
    keyed = df.dropna(subset=list(check.columns))
    repeated = keyed.groupBy(*check.columns).count().where("count > 1")
    return repeated.agg(F.expr("count(1) AS failures"))


def _orphans(
    models: Mapping[str, DataFrame], checks: list[Check], counted: Mapping[tuple[str, str], DataFrame]
) -> DataFrame:
    """All relationships of one child model, which is scanned once at most.

    Child rows are counted per (check, key) first: a hot key reaches the join as one row.
    """
    frames = []
    scanned = []
    for i, c in enumerate(checks):
        key = f"{i} AS test, string({c.columns[0]}) AS key"
        rows = counted.get((c.model, c.columns[0]))
        if rows is None:
            scanned.append(f"struct({key})")
        else:
            frames.append(rows.selectExpr(*key.split(", ", 1), "linhas"))
    if scanned:
        rows = models[checks[0].model].selectExpr(f"inline(array({', '.join(scanned)}))")
        frames.append(rows.selectExpr("test", "key", "1L AS linhas"))
    child = reduce(DataFrame.unionByName, frames).where("key IS NOT NULL")
    per_key = child.groupBy("test", "key").agg(F.expr("sum(linhas) AS linhas"))
    known = [
        models[c.parent].selectExpr(f"{i} AS test", f"string({c.columns[0]}) AS key") for i, c in enumerate(checks)
    ]
    orphans = per_key.join(reduce(DataFrame.unionByName, known), ["test", "key"], "left_anti")
    failures = [F.expr(f"coalesce(sum(if(test = {i}, linhas, 0)), 0) AS n{i}") for i in range(len(checks))]
    return _rows_of(orphans.agg(*failures), checks)


def _labelled(counted: DataFrame, check: Check) -> DataFrame:
    return counted.selectExpr(f"inline(array(struct({_labels(check)}, failures)))")


def _labels(check: Check) -> str:
    named = {
        "model": check.model,
        "columns": check.column,
        "test": check.kind,
        "severity": check.severity,
    }
    return ", ".join(f"'{value}' AS {name}" for name, value in named.items())
