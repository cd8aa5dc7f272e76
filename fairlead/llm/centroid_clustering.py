"""Exact integer k-means with heap-ordered bounds: only vectors whose gap expired are scanned again."""

from __future__ import annotations

import heapq
import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fairlead.config import scratch_dir
from fairlead.llm.common import shuffle_partitions, stored

CLUSTERS = 40
ROUNDS = 5
DIMENSIONS = 64
# A component x counts as floor(SCALE * x).
SCALE = 256
SEED = 2
# Vectors of one block, and the bits of a heap entry that number them.
BLOCK_BITS = 11
# Steps of a gap: bounds are kept in units of 1/1024, rounded to the safe side.
GAP_STEPS = 1024
# Components of larger magnitude would let a squared distance leave the range of a long.
LARGEST = 2**27
# Up to this magnitude float64 holds every sum of 64 squared differences exactly.
FLOAT_EXACT = 2**22
# A gap no drift can use up.
_NEVER = 1 << 50

_BLOCK = "block long, ids array<long>, vectors binary"
_STATE = "block long, heap array<long>, sizes array<int>, changed array<struct<place: int, delta: long>>"
_PLACED = "vec_id long, cluster int, distance long"


def integer_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """(vec_id, v): vectors of exactly ``dimensions`` finite components, as integers; others are left out."""
    wide = F.col("embedding").cast("array<double>")
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.select("vec_id", wide.alias("embedding")).where((F.size("embedding") == dimensions) & finite)
    floors = F.transform("embedding", lambda x: F.floor(x * F.lit(float(SCALE))))
    return kept.select("vec_id", floors.alias("v"))


def first_centroids(vectors: DataFrame, clusters: int, dimensions: int, seed: int) -> np.ndarray:
    """The vectors of the ``clusters`` smallest SHA-256 of ``seed:vec_id``, in that order.

    Hashes are spread evenly, so a threshold on them leaves few rows to sort; it is raised
    until enough do. Ids that repeat go by their components.
    """
    label = F.concat(F.lit(f"{seed}:"), F.ifnull(F.col("vec_id").cast("string"), F.lit("")))
    hashed = vectors.select(F.sha2(label, 256).alias("h"), "v")
    rows = vectors.count()
    share = min(1.0, 8 * clusters / max(1, rows))
    while True:
        low = hashed if share >= 1 else hashed.where(F.col("h") < f"{int(share * 2**52):013x}")
        picked = low.orderBy("h", "v").limit(clusters).collect()
        if share >= 1 or len(picked) == clusters:
            return np.array([row["v"] for row in picked], dtype=np.int64).reshape(len(picked), dimensions)
        share = min(1.0, share * 8)


def cluster_vectors(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    seed: int = SEED,
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector.

    Lloyd's rounds in exact integers, ties to the smaller cluster, then a last assignment; an
    empty centroid stays where it is. The result equals that of scanning all centroids for
    all vectors in every round.

    Vectors lie in blocks, written once in buckets by block. The state of a block is one heap
    per cluster of its vectors, ordered by the distance between the second nearest and the
    nearest centroid when the vector was last scanned, plus the drift of its cluster up
    to then: how far the own centroid and the fastest other one have moved. While the
    drift is smaller than that, no centroid can have come nearer, so a round pops
    what has expired, scans just those against all centroids and pushes them again.
    Only the state, 8 bytes a vector, is rewritten in a round, in the same buckets,
    so no vector moves after the first write. Sums change by the vectors that moved; the
    driver adds clusters x dimensions numbers a round, and gets no more.

    Null vectors, other sizes and null or non-finite components have no row. Vectors without
    an id are clustered like others. Rows that repeat are vectors of their own. Fewer kept
    vectors than ``clusters`` make as many clusters as there are. An empty table gives no rows.
    A component beyond ``LARGEST`` is an error: its distances do not fit a long.
    """
    spark = vectors.sparkSession
    kept = stored(integer_vectors(vectors, dimensions), "kmeans-vectors")
    largest = kept.select(F.max(F.greatest(F.array_max("v"), -F.array_min("v")))).first()[0]
    if largest is not None and largest > LARGEST:
        raise ValueError(f"component {largest} after scaling: distances beyond {LARGEST} do not fit a long")
    exact = np.float64 if (largest or 0) <= FLOAT_EXACT else np.int64
    centroids = first_centroids(kept, clusters, dimensions, seed)
    k = len(centroids)
    buckets = shuffle_partitions(spark)
    blocks = _bucketed(kept.mapInArrow(_to_blocks(dimensions), _BLOCK), "kmeans-blocks", buckets)
    sums = np.zeros((k, dimensions + 1), dtype=object)  # the last column counts; Python integers do not overflow
    drift = np.zeros(k)
    tables = [blocks]
    for _ in range(rounds + 1 if k else 0):
        step = _assign(centroids, drift, exact)
        source = spark.table(blocks)
        if len(tables) > 1:
            source = source.join(spark.table(tables[-1]), "block")
        tables.append(_bucketed(source.mapInArrow(step, _STATE), "kmeans-state", buckets))
        final = centroids
        changed = spark.table(tables[-1]).select(F.inline("changed")).groupBy("place").agg(F.sum("delta").alias("delta")).collect()
        for place, delta in changed:
            sums[divmod(place, dimensions + 1)] += delta
        centroids = final.copy()
        for c in range(k):
            if sums[c, -1]:
                centroids[c] = [x // sums[c, -1] for x in sums[c, :-1]]
        drift = drift + _drifts(final, centroids)
    if len(tables) == 1:
        placed = spark.createDataFrame([], _PLACED)
        final = np.zeros((0, dimensions), dtype=np.int64)
    else:
        both = spark.table(blocks).join(spark.table(tables[-1]), "block")
        placed = stored(both.mapInArrow(_distances(final, exact), _PLACED), "kmeans-placed")
    for name in tables:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return _with_totals(spark, placed, final)


def _with_totals(spark: SparkSession, placed: DataFrame, final: np.ndarray) -> DataFrame:
    """One row per cluster is joined to the placed vectors: its inertia, all inertia, its centroid."""
    inertia = placed.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    texts = [(c, ",".join(map(str, row))) for c, row in enumerate(final.tolist())]
    named = spark.createDataFrame(texts, "cluster int, components string")
    per_cluster = inertia.join(F.broadcast(named), "cluster").select(
        "cluster",
        "cluster_inertia",
        F.expr("sum(cluster_inertia) OVER ()").alias("inertia"),
        F.sha2("components", 256).alias("centroid_sha256"),
    )
    # At most one row per cluster.
    return placed.join(F.broadcast(per_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _bucketed(df: DataFrame, label: str, buckets: int) -> str:
    """Name of a table of the rows in buckets by block, so that blocks and states meet without a shuffle."""
    spark = df.sparkSession
    name = f"{label.replace('-', '_')}_{uuid.uuid4().hex}"
    rows = df.repartition(buckets, "block") if label == "kmeans-blocks" else df
    writer = rows.write.bucketBy(buckets, "block").sortBy("block").option("compression", "zstd")
    writer.option("path", scratch_dir(spark, label)).saveAsTable(name)
    return name


def _to_blocks(dimensions: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    size = 1 << BLOCK_BITS

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        number = 0
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                part = batch.slice(start, size)
                values = part["v"].flatten().to_numpy(zero_copy_only=False).astype("<i4")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([task << 32 | number], pa.int64()),
                        pa.array([part["vec_id"].to_pylist()], pa.list_(pa.int64())),
                        pa.array([values.tobytes()], pa.binary()),
                    ],
                    ["block", "ids", "vectors"],
                )
                number += 1

    return blocks


def _matrix(raw: bytes, dimensions: int, exact: type) -> np.ndarray:
    return np.frombuffer(raw, dtype="<i4").reshape(-1, dimensions).astype(exact)


def _drifts(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """How far the gap of a vector in each cluster may have shrunk: its centroid's move plus the largest other."""
    if not len(old):
        return np.zeros(0)
    moved = [math.sqrt(sum(d * d for d in row)) * (1 + 1e-12) for row in (new - old).tolist()]
    order = sorted(range(len(moved)), key=moved.__getitem__)
    most, second = order[-1], order[-2] if len(order) > 1 else None
    others = [moved[second] if c == most and second is not None else (0.0 if c == most else moved[most]) for c in range(len(moved))]
    return np.array(moved) + np.array(others)


def _scan(rows: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of each row, the smaller number on ties, and a safe gap to the second nearest."""
    # |x|^2 is the same for all centroids, but exact squared distances are needed for the gap.
    squares = (rows * rows).sum(1)[:, None] - 2 * (rows @ centroids.T) + (centroids * centroids).sum(1)[None, :]
    nearest = squares.argmin(1)
    if squares.shape[1] == 1:
        return nearest, np.full(len(rows), float(_NEVER))
    two = np.partition(squares, 1, axis=1)[:, :2].astype(np.float64)
    near, next_ = np.sqrt(two[:, 0]), np.sqrt(two[:, 1])
    return nearest, (next_ - near) - 1e-9 * (1 + next_)


def _steps(distance: np.ndarray | float) -> np.ndarray:
    return np.minimum(np.floor(distance * GAP_STEPS), float(_NEVER)).astype(np.int64)


def _assign(centroids: np.ndarray, drift: np.ndarray, exact: type):
    """One assignment of all blocks; a block without a heap yet is scanned whole.

    A heap entry holds the gap at the last scan plus the drift up to then, above the number of the
    vector in its block; the heap it lies in is its cluster.
    """
    k, dimensions = centroids.shape
    # Rounded up and one more: an entry may expire too early, never too late.
    offsets = [int(x) + 1 for x in np.ceil(drift * (1 + 1e-9) * GAP_STEPS)]
    bits, low = BLOCK_BITS, (1 << BLOCK_BITS) - 1

    def assigned(matrix: np.ndarray, heaps: list[list[int]] | None) -> tuple[list[list[int]], np.ndarray]:
        around = centroids.astype(exact)
        delta = np.zeros((k, dimensions + 1), dtype=np.int64)
        if heaps is None:
            nearest, gaps = _scan(matrix, around)
            entries = (_steps(gaps) << bits) | np.arange(len(matrix))
            heaps = [entries[nearest == c].tolist() for c in range(k)]
            for c, heap in enumerate(heaps):
                heapq.heapify(heap)
                delta[c, :-1] = matrix[nearest == c].astype(np.int64).sum(0)
                delta[c, -1] = len(heap)
            return heaps, delta
        popped: list[int] = []
        came: list[int] = []
        for c, heap in enumerate(heaps):
            while heap and heap[0] >> bits <= offsets[c]:
                popped.append(heapq.heappop(heap) & low)
                came.append(c)
        if popped:
            rows = matrix[popped]
            nearest, gaps = _scan(rows, around)
            entries = ((_steps(gaps) + np.array(offsets)[nearest]) << bits) | np.array(popped)
            for c, entry in zip(nearest.tolist(), entries.tolist()):
                heapq.heappush(heaps[c], entry)
            old = np.array(came)
            moved = np.flatnonzero(old != nearest)
            values = np.concatenate([rows[moved].astype(np.int64), np.ones((len(moved), 1), dtype=np.int64)], axis=1)
            np.subtract.at(delta, old[moved], values)
            np.add.at(delta, nearest[moved], values)
        return heaps, delta

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = "heap" in batch.schema.names
            for i in range(batch.num_rows):
                matrix = _matrix(batch["vectors"][i].as_py(), dimensions, exact)
                heaps = None
                if held:
                    flat = batch["heap"][i].values.to_pylist()
                    ends = np.cumsum(batch["sizes"][i].values.to_numpy()).tolist()
                    heaps = [flat[a:b] for a, b in zip([0, *ends], ends)]
                heaps, delta = assigned(matrix, heaps)
                delta = delta.ravel()
                places = np.flatnonzero(delta)
                changed = [{"place": p, "delta": d} for p, d in zip(places.tolist(), delta[places].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["block"].slice(i, 1),
                        pa.array([[e for heap in heaps for e in heap]], pa.list_(pa.int64())),
                        pa.array([[len(heap) for heap in heaps]], pa.list_(pa.int32())),
                        pa.array([changed], pa.list_(pa.struct([("place", pa.int32()), ("delta", pa.int64())]))),
                    ],
                    ["block", "heap", "sizes", "changed"],
                )

    return step


def _distances(centroids: np.ndarray, exact: type):
    """Every vector with its cluster and the squared distance to that centroid alone."""
    dimensions = centroids.shape[1]
    low = (1 << BLOCK_BITS) - 1

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        around = centroids.astype(exact)
        for batch in batches:
            for i in range(batch.num_rows):
                matrix = _matrix(batch["vectors"][i].as_py(), dimensions, exact)
                heap, sizes = batch["heap"][i].values.to_numpy(), batch["sizes"][i].values.to_numpy()
                cluster = np.empty(len(matrix), dtype=np.int32)
                cluster[heap & low] = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
                apart = matrix - around[cluster]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["ids"][i].values,
                        pa.array(cluster),
                        pa.array((apart * apart).sum(1).astype(np.int64)),
                    ],
                    ["vec_id", "cluster", "distance"],
                )

    return rows
