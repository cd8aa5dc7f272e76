"""Shapes of the plans that matter at scale."""

import pytest

from checks import registry
from checks.star_models import StarModels
from fairlead.operators import filters
from fairlead.plans import marts

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text):
    return [line.split("FileScan parquet ")[1] for line in text.splitlines() if "FileScan parquet" in line]


def test_unneeded_lookups_are_not_joined(spark):
    tables = plan(StarModels(spark, FOLDER).balance())
    assert "part.parquet" in tables
    for absent in ("orders", "customer", "supplier"):
        assert f"{absent}.parquet" not in tables


def test_only_needed_columns_are_read_and_filters_reach_the_scan(spark):
    lines = [s for s in scans(plan(StarModels(spark, FOLDER).balance())) if "lineitem.parquet" in s]
    assert len(lines) == 2
    for scan in lines:
        assert "l_quantity" not in scan and "l_tax" not in scan
        assert "EqualTo(l_linestatus" in scan


def test_relationships_and_grain_read_the_line_items_once_per_model(spark):
    lines = [s for s in scans(plan(registry.registered()["dq_relationships"](spark, FOLDER))) if "lineitem.parquet" in s]
    assert len(lines) <= 4  # exports, imports, and both for the fact
    grain = scans(plan(registry.registered()["dq_grain"](spark, FOLDER)))
    assert not [s for s in grain if "lineitem.parquet" in s]  # totals were stored before


def test_direction_filter_removes_the_other_branch(spark):
    trade = StarModels(spark, FOLDER).trade("ano", "mes", "data_ref", "direcao", "sg_uf", "vl_fob_usd")
    text = plan(filters.direction(trade, "EXP"))
    assert "Union" not in text
    assert len([s for s in scans(text) if "lineitem.parquet" in s]) == 1


def test_blocs_join_after_the_first_aggregate(spark):
    text = plan(StarModels(spark, FOLDER).blocs())
    bloc_join = next(i for i, line in enumerate(text.splitlines()) if "Join [co_pais" in line)
    below = text.splitlines()[bloc_join + 1 :]
    assert any("HashAggregate(keys=[ano" in line and "co_pais" in line for line in below)


def test_state_windows_share_one_shuffle(spark):
    text = plan(StarModels(spark, FOLDER).exports_by_state())
    assert text.count("Exchange hashpartitioning(ano") == 2


def test_top_states_are_a_top_k(spark):
    assert "TakeOrderedAndProject" in plan(registry.registered()["balance_top_states"](spark, FOLDER))


@pytest.mark.parametrize(
    "name", "mart_trade_balance mart_top_products mart_economic_blocs partner_import_share dq_relationships".split()
)
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(registry.registered()[name](spark, FOLDER))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert unwanted not in text


def test_without_broadcast_the_joins_are_sort_merge(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        m = StarModels(spark, FOLDER)
        text = plan(marts.economic_blocs(m.trade(), m.country_blocs()))
        assert "BroadcastExchange" not in text and "SortMergeJoin" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_product_is_split_in_the_lookup_join(spark, tmp_path):
    """A third of the lines share one part: the join splits that partition."""
    for name in ("part", "lineitem"):
        rows = spark.read.parquet(f"{FOLDER}/{name}.parquet")
        if name == "lineitem":
            rows = rows.selectExpr(
                "* EXCEPT (l_partkey)", "if(l_orderkey % 3 = 0, 7L, l_partkey) AS l_partkey"
            )
        rows.repartition(8).write.parquet(str(tmp_path / f"{name}.parquet"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.files.maxPartitionBytes": "32KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        balance = StarModels(spark, str(tmp_path)).balance()
        balance.collect()
        final = plan(balance).split("Initial Plan")[0]
        assert "SortMergeJoin(skew=true)" in final
    finally:
        for key in settings:
            spark.conf.unset(key)
