"""The scalable share and rank against the window form."""

import random

from frames import rows_of, table, trade
from pyspark.sql import functions as F

from fairlead.operators.ranking import share_and_rank, share_and_rank_small, top_ranked
from fairlead.plans import marts
from fairlead.schemas import TRADE

COLUMNS = "ano int, direcao string, item string, v double, kg bigint"
KEYS = ["ano", "direcao"]


def both(df):
    return [
        rows_of(share_and_rank_small(df, KEYS, "v", "peso", "posicao")),
        rows_of(share_and_rank(df, KEYS, "v", "peso", "posicao")),
    ]


def test_same_as_windows_on_ties_nulls_signs_and_a_hot_group(spark):
    pick = random.Random(7)
    values = [None, 0.0, -0.0, 1.0, -1.0, 5.0, 5.0, 2.0**40, -(2.0**30)]
    rows = []
    for i in range(3000):
        # A third of the rows share one group and one value.
        if i % 3 == 0:
            rows.append((2020, "EXP", str(i), 77.0, 1))
        else:
            value = pick.choice(values + [float(pick.randint(-(10**6), 10**9))])
            rows.append((2020 + i % 2, pick.choice(["EXP", "IMP"]), str(i), value, pick.choice([None, 3])))
    windows, ranged = both(table(spark, COLUMNS, *rows))
    assert ranged == windows


def test_zero_total_has_no_share(spark):
    windows, ranged = both(
        table(spark, COLUMNS, (2020, "EXP", "a", 2.0, 1), (2020, "EXP", "b", -2.0, 1), (2021, "EXP", "c", None, 1))
    )
    assert ranged == windows
    assert {row[5] for row in ranged} == {None}


def test_neighbouring_values_are_told_apart(spark):
    rows = [(2020, "EXP", str(i), 10.0**12 + i, 1) for i in range(500)]
    windows, ranged = both(table(spark, COLUMNS, *rows))
    assert ranged == windows


def test_fractions_and_nan_rank_like_the_window(spark):
    rows = [(2020, "EXP", str(i), i / 7, 1) for i in range(400)] + [(2021, "EXP", "n", float("nan"), 1), (2021, "EXP", "m", 1.0, 1)]
    df = table(spark, COLUMNS, *rows)
    small = share_and_rank_small(df, KEYS, "v", "peso", "posicao").select("ano", "item", "posicao")
    large = share_and_rank(df, KEYS, "v", "peso", "posicao").select("ano", "item", "posicao")
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))


def test_no_task_sorts_a_group_of_neighbouring_values(spark):
    df = spark.range(200_000).selectExpr("2020 AS ano", "'EXP' AS direcao", "string(id) AS item", "1e12D + id AS v", "1 AS kg")
    values = df.selectExpr("ano", "direcao", "v AS _value", "bigint(1) AS _rows")
    parts = values.repartitionByRange(8, "ano", "direcao", F.desc_nulls_last("_value"))
    largest = parts.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert largest < 2 * 200_000 / 8
    ranked = share_and_rank(df, KEYS, "v", "peso", "posicao")
    assert ranked.where("posicao <> 200000 - bigint(item)").isEmpty()


def test_stored_fact_is_scanned_once(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows = [{"co_ncm": str(i), "vl_fob_usd": float(i), "kg_liquido": i} for i in range(50)]
    trade(spark, *rows).write.partitionBy("direcao", "ano").parquet(path)
    fact = spark.read.schema(TRADE).parquet(path)
    ranked = marts.with_product_rank(marts.product_totals(fact))
    for columns in (["*"], ["rank_ano_direcao"]):
        chosen = ranked.select(*columns)
        assert chosen.count() == 50
        assert path not in chosen._jdf.queryExecution().executedPlan().toString()


def test_leading_rows_equal_the_whole_rank_on_ties_and_nulls(spark):
    pick = random.Random(11)
    rows = [
        (2020 + i % 3, pick.choice(["EXP", "IMP"]), str(i), pick.choice([None, 1.0, 1.0, 2.0, 7.0, float(pick.randint(-9, 9))]), 1)
        for i in range(900)
    ]
    rows += [(2030, "EXP", "only null", None, 1), (2031, "EXP", "a", None, 1), (2031, "EXP", "b", 3.0, 1)]
    df = table(spark, COLUMNS, *rows).repartition(6)
    whole = share_and_rank_small(df, KEYS, "v", "peso", "posicao")
    for n in (1, 3, 40, 5000):
        assert rows_of(top_ranked(df, KEYS, "v", n, "peso", "posicao")) == rows_of(whole.where(f"posicao <= {n}"))


def test_leading_rows_are_cut_before_they_move(spark):
    df = spark.range(400_000, numPartitions=6).selectExpr(
        "2020 + id % 1 AS ano", "if(id >= 0, 'EXP', 'IMP') AS direcao", "id AS item", "double(id) AS v"
    )
    best = top_ranked(df, KEYS, "v", 10, "peso", "posicao")
    text = best._jdf.queryExecution().executedPlan().toString()
    below = text.split("Exchange hashpartitioning(ano")[1:]
    assert any("WindowGroupLimit" in part and "Partial" in part for part in below)
    assert [row.item for row in best.orderBy("posicao").collect()] == list(range(399_999, 399_989, -1))
