"""Share of a group's total and rank inside the group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairlead.functions.codes import share
from fairlead.sinks import stored

def share_and_rank_small(
    df: DataFrame, keys: Sequence[str], value: str, share_as: str, rank_as: str
) -> DataFrame:
    """Window form, for groups whose size is bounded by a code table (states of a month).

    Total and rank use the same partitioning, so one shuffle serves both.
    """
    group = f"PARTITION BY {', '.join(keys)}"
    return df.selectExpr(
        "*",
        f"{share(value, f'sum({value}) OVER ({group})')} AS {share_as}",
        f"bigint(rank() OVER ({group} ORDER BY {value} DESC NULLS LAST)) AS {rank_as}",
    )


def share_and_rank(df: DataFrame, keys: Sequence[str], value: str, share_as: str, rank_as: str) -> DataFrame:
    """Share and rank for groups of any size; no task holds a whole group.

    Both depend on a row only through its group and value, so they are worked out once per
    distinct value and joined back:

    * ``df`` is stored, so that it is computed once; rows are counted per (group, value), and
      ties collapse before the shuffle;
    * the distinct values are range-partitioned by group and falling value into a stored
      table that keeps the partition's number. Values that lie close together, in whatever
      numbers, are split like any others;
    * a partition sums its own rows ahead; those of earlier partitions, one number per
      partition and group, are added.

    A NULL value ranks last and NaN first; the total adds the partitions' sums in their
    order, so NaN makes every share of its group NaN. A row with a NULL key is kept, but gets
    neither share nor rank.
    """
    spark = df.sparkSession
    rows = stored(df, "ranked-rows")
    levels = rows.groupBy(*keys, F.col(value).alias("_value")).agg(F.expr("count(1) AS _rows"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [*[F.col(k) for k in keys], F.desc_nulls_last("_value")]
    ranged = stored(
        levels.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "ranked-values"
    )
    group = f"PARTITION BY {', '.join(keys)}"
    sums = ranged.groupBy(*keys, "_part").agg(F.expr("sum(_rows) AS _part_rows"), F.expr("sum(_value * _rows) AS _part_total"))
    # One row per group and partition: bounded by the number of partitions.
    ahead = sums.selectExpr(
        *[f"{key} AS _b_{key}" for key in keys],
        "_part AS _b_part",
        f"coalesce(sum(_part_rows) OVER ({group} ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _ahead",
        f"sum(_part_total) OVER ({group} ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS _total",
    )
    inside = (
        f"sum(_rows) OVER ({group}, _part ORDER BY _value DESC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    )
    placed = ranged.join(ahead, _equal(keys, "_b_", "_part = _b_part"), "inner").selectExpr(
        *[f"{key} AS _v_{key}" for key in keys],
        "_value",
        f"{share('_value', '_total')} AS {share_as}",
        f"1 + _ahead + coalesce({inside}, 0) AS {rank_as}",
    )
    return rows.join(placed, _equal(keys, "_v_", f"{value} <=> _value"), "left").select(*df.columns, share_as, rank_as)


def top_ranked(
    df: DataFrame, keys: Sequence[str], value: str, top_n: int, share_as: str, rank_as: str
) -> DataFrame:
    """The rows that ``share_and_rank`` ranks ``top_n`` or better, all ties at the limit included.

    Each task keeps its own best rows of a group before they move, so about ``top_n`` rows a task
    reach the task that ranks the group, whatever its size; the total of a group is
    a sum of its own. A NULL value ranks last and NaN first. Rows with a NULL key have no rank.
    """
    known = df.dropna(subset=list(keys))
    totals = known.groupBy(*keys).agg(F.expr(f"sum({value}) AS _total"))
    group = f"PARTITION BY {', '.join(keys)}"
    ranked = known.selectExpr("*", f"rank() OVER ({group} ORDER BY {value} DESC NULLS LAST) AS _rank")
    best = ranked.where(F.col("_rank") <= top_n)  # on the bare rank: that is what tasks can cut by themselves
    return best.join(totals, list(keys)).selectExpr(
        *df.columns, f"{share(value, '_total')} AS {share_as}", f"bigint(_rank) AS {rank_as}"
    )


def _equal(keys: Sequence[str], prefix: str, last: str):
    return F.expr(" AND ".join([f"{key} = {prefix}{key}" for key in keys] + [last]))
