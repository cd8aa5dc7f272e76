"""Shuffled shards of equal row counts by a two-pass external shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fairlead.config import scratch_dir
from fairlead.llm.common import shuffle_partitions, stored, text_bytes

# Bytes of text that one bucket should hold; a task shuffles one bucket in memory.
BUCKET_BYTES = 16 << 20
LAW = "rows"
# Buckets whose rows are added up together, and copies of a row that one row makes again.
BUCKET_GROUP = 1024
COPIES = 1000
_COPY = "_copy"


def write_shards(docs: DataFrame, path: str, shards: int, seed: int) -> DataFrame:
    """Writes every row of ``docs`` to ``path`` in shuffled order, and returns it from there.

    Adds ``shard`` and ``slot``: rows are numbered in a seeded random order and dealt to the
    shards in turn, so counts differ by one at most and slots have no gap. Files of shard s
    lie below ``shard=s``, each in the order of slots.

    First pass: a seeded hash of doc_id, text and the number of the copy scatters rows
    uniformly to buckets that fit in memory, whatever ids, sources or copies are frequent. Second
    pass: a task sorts a bucket, so that a rerun sees the same order, and shuffles it by Fisher
    and Yates with a generator seeded for that bucket. The order depends on the rows and the
    seed only, not on files or partitions. Rows that repeat as a whole are counted first and
    their copies numbered, so they scatter like any others.

    Every column is kept, but ``shard`` and ``slot`` must not be taken. Null ids and texts
    are hashed as nulls and kept; an empty table gives no rows.
    """
    spark = docs.sparkSession
    buckets = max(2 * shuffle_partitions(spark), -(-text_bytes(docs) // BUCKET_BYTES))
    columns = docs.columns
    docs = _numbered(docs)
    bucket = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text", _COPY), F.lit(buckets))
    offsets = _offsets(docs.groupBy(bucket.alias("bucket")).count())
    if buckets <= 1_000_000:  # 16 bytes a row
        offsets = F.broadcast(offsets)
    given = docs.select(F.struct(*columns).alias("row"), bucket.alias("bucket"), F.xxhash64("doc_id", "text").alias("key"))
    scattered = (
        given.join(offsets, "bucket")
        .repartition(max(shuffle_partitions(spark), buckets // 2), "bucket")
        .sortWithinPartitions("bucket", "row.doc_id", "key", "row.text")
    )
    kind = scattered.schema["row"].dataType.simpleString()

    def shuffle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _shuffled(batches, seed, shards)

    dealt = scattered.select("bucket", "offset", "row").mapInArrow(shuffle, f"row {kind}, shard int, slot long")
    ordered = dealt.select("row.*", "shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.option("compression", "zstd").partitionBy("shard").parquet(path)
    schema = ordered.schema
    return spark.read.schema(schema).parquet(path)


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with the number of each row among rows that are equal as a whole.

    Mostly no row repeats, and all numbers are 0. Where rows do, equal ones are counted before they
    move, and their copies made again, some at a time in any task.
    """
    repeated = docs.groupBy("doc_id", F.xxhash64("text")).count().where("count > 1")
    if repeated.isEmpty():
        return docs.withColumn(_COPY, F.lit(0).cast("long"))
    unique = stored(docs.groupBy(*docs.columns).agg(F.count(F.lit(1)).alias("_n")), "shard-rows")
    spans = unique.withColumn("_from", F.explode(F.expr(f"sequence(0, _n - 1, {COPIES})")))
    parts = shuffle_partitions(docs.sparkSession)
    dealt = spans.repartition(parts, F.xxhash64("doc_id", "text", "_from"))
    last = F.expr(f"least(_from + {COPIES}, _n) - 1")
    return dealt.select(*docs.columns, F.explode(F.sequence("_from", last)).alias(_COPY))


def _offsets(counted: DataFrame) -> DataFrame:
    """(bucket, rows in all buckets before it), summed in groups of buckets first."""
    grouped = counted.withColumn("group", F.expr(f"bucket div {BUCKET_GROUP}"))
    sums = grouped.groupBy("group").agg(F.sum("count").alias("rows"))
    ahead = F.sum("rows").over(Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1))
    inside = F.sum("count").over(Window.partitionBy("group").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    starts = sums.select("group", F.ifnull(ahead, F.lit(0)).alias("start"))
    return grouped.withColumn("before", F.ifnull(inside, F.lit(0))).join(starts, "group").select(
        "bucket", (F.col("start") + F.col("before")).alias("offset")
    )


def _shuffled(batches: Iterator[pa.RecordBatch], seed: int, shards: int) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    current = offset = None

    def deal() -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        order = np.random.Generator(np.random.PCG64([seed, current])).permutation(table.num_rows)
        place = offset + np.arange(table.num_rows, dtype=np.int64)
        done = pa.table(
            {
                "row": table["row"].take(pa.array(order)),
                "shard": pa.array((place % shards).astype(np.int32)),
                "slot": pa.array(place // shards),
            }
        )
        yield from done.to_batches(max_chunksize=4096)

    for batch in batches:
        numbers = batch["bucket"].to_numpy()
        edges = np.flatnonzero(np.diff(numbers)) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(numbers)]):
            if a == b:
                continue
            if held and numbers[a] != current:
                yield from deal()
                held = []
            current, offset = int(numbers[a]), batch["offset"][a].as_py()
            held.append(batch.slice(a, b - a))
    if held:
        yield from deal()


def shard_documents(docs: DataFrame, shards: int = 8, seed: int = 2024) -> DataFrame:
    """One row per row of ``docs``, read back from the written shards.

    Columns: doc_id, size (UTF-8 bytes of the text plus 1), text_crc32, law, shard, slot,
    grown_shard (null: rows move when the number of shards changes).

    Only ``doc_id`` and ``text`` are read, so other columns may have any name. A null text
    has no bytes; repeated rows take a slot each; an empty table gives no rows.
    """
    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    written = write_shards(kept, scratch_dir(docs.sparkSession, "shards"), shards, seed)
    text = F.coalesce("text", F.lit(""))
    return written.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
