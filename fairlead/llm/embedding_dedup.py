"""Near-duplicate embeddings: sharded small-world graphs, verified cosines, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairlead.llm.common import stored
from fairlead.llm.graph import components
from fairlead.llm.hnsw import Graph

COSINE = 0.95
# Vectors of one shard at most, and shards at least; each task holds the graph of one shard.
SHARD_VECTORS = 200_000
LEAST_SHARDS = 6
FIRST_BEAM = 48
# A query with more links than this beam holds is compared with all vectors of the shard.
WIDEST_BEAM = 192
AUDIT_QUERIES = 1024
AUDIT_RECALL = 0.999
# Queries and vectors that are compared at a time.
DENSE_QUERIES = 256
DENSE_NODES = 16384
# Single precision finds candidates this much below the bound; double precision decides.
SLACK = 1e-4
QUERY_ROWS = 2048


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; scaled first, so squares stay finite."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("nd,nd->n", scaled, scaled))[:, None]


class Shard:
    """A graph of some distinct vectors, the beam its recall audit settled on, and a forest of the links found."""

    def __init__(self, keys: np.ndarray, copies: np.ndarray, vectors: np.ndarray, cosine: float):
        order = np.random.Generator(np.random.PCG64(len(keys))).permutation(len(keys))
        self.keys, self.copies = keys[order], copies[order].astype(np.float64)
        self.exact = _unit(vectors[order])
        self.cosine = cosine
        self.graph = Graph(self.exact.astype(np.float32))
        self.sorted = np.argsort(self.keys)
        self.forest = _Forest(len(keys))
        self.beam: int | None = None
        self.recall: float | None = None

    def links(self, keys: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(linked rows of each query, edges a, edges b); a vector is no link of itself.

        The first queries settle the beam. Edges are keys of queries and nodes, enough of the links to
        join what they join.
        """
        queries = _unit(vectors)
        own = self._places(keys)
        if self.beam is None:
            self._audit(queries, own)
        x, y, dense = self._near(queries, own, self.beam)
        counts = np.bincount(x, weights=self.copies[y], minlength=len(keys)).astype(np.float64)
        edges = [self.forest.join(x, y, own)]
        for k in range(0, len(dense), DENSE_QUERIES):
            edges.append(self._compare(queries, own, dense[k : k + DENSE_QUERIES], counts))
        a, b = (np.concatenate(e) for e in zip(*edges))
        return counts.astype(np.int64), keys[a], self.keys[b]

    def _audit(self, queries: np.ndarray, own: np.ndarray) -> None:
        """The first beam, doubled until queries find what comparison with every vector finds.

        Recall is taken per query, without the pair of a vector with itself, and averaged over the
        queries that have links: a large group cannot hide what small ones miss. Queries come in
        random order from all shards.
        """
        some = slice(0, AUDIT_QUERIES)
        wanted: list[list[int]] = []
        for k in range(0, len(queries[some]), DENSE_QUERIES):
            rows = np.arange(k, min(k + DENSE_QUERIES, len(queries[some])))
            found: list[list[int]] = [[] for _ in rows]
            for start, hits in self._hits(queries, own, rows):
                for row, node in zip(*(z.tolist() for z in np.nonzero(hits))):
                    if len(found[row]) <= WIDEST_BEAM:  # more links than a beam holds are compared, not searched
                        found[row].append(start + node)
            wanted += found
        asked = [k for k, nodes in enumerate(wanted) if 0 < len(nodes) <= WIDEST_BEAM]
        self.beam, self.recall = FIRST_BEAM, 1.0
        while asked and self.beam < len(self.keys):
            x, y, dense = self._near(queries[asked], own[asked], self.beam)
            met = set(zip(x.tolist(), y.tolist()))
            left = set(dense.tolist())
            shares = [
                1.0 if i in left else sum((i, node) in met for node in wanted[k]) / len(wanted[k]) for i, k in enumerate(asked)
            ]
            self.recall = sum(shares) / len(shares)
            if self.recall >= AUDIT_RECALL:
                break
            self.beam *= 2

    def _places(self, keys: np.ndarray) -> np.ndarray:
        """Node of each key; -1 for keys of other shards."""
        at = np.minimum(np.searchsorted(self.keys, keys, sorter=self.sorted), len(self.keys) - 1)
        return np.where(self.keys[self.sorted[at]] == keys, self.sorted[at], -1)

    def _near(self, queries: np.ndarray, own: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Verified (query, node) links that the graph finds, and the queries left to comparison."""
        x, y, dense = self.graph.search(queries.astype(np.float32), self.cosine - SLACK, beam, max(beam, WIDEST_BEAM))
        other = own[x] != y
        x, y = x[other], y[other]
        sure = np.empty(len(x), dtype=bool)
        for k in range(0, len(x), 65536):
            part = slice(k, k + 65536)
            sure[part] = np.einsum("nd,nd->n", queries[x[part]], self.exact[y[part]]) >= self.cosine
        return x[sure], y[sure], dense

    def _hits(self, queries: np.ndarray, own: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(first node, links of ``rows`` with the nodes from there on), some thousand nodes at a time."""
        single = queries[rows].astype(np.float32)
        for start in range(0, len(self.keys), DENSE_NODES):
            near = single @ self.graph.vectors[start : start + DENSE_NODES].T
            hits = near >= self.cosine + SLACK
            x, y = np.nonzero((near >= self.cosine - SLACK) & ~hits)
            if len(x):  # single precision cannot tell
                hits[x, y] = np.einsum("nd,nd->n", queries[rows[x]], self.exact[start + y]) >= self.cosine
            mine = np.flatnonzero((own[rows] >= start) & (own[rows] < start + hits.shape[1]))
            hits[mine, own[rows[mine]] - start] = False
            yield start, hits

    def _compare(
        self, queries: np.ndarray, own: np.ndarray, rows: np.ndarray, counts: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Links of members of large groups: counted, and joined once per tree; pairs are never gathered."""
        x: list[int] = []
        y: list[int] = []
        for start, hits in self._hits(queries, own, rows):
            counts[rows] += hits @ self.copies[start : start + hits.shape[1]]
            roots = self.forest.roots(start, hits.shape[1])
            for k, row in enumerate(rows.tolist()):
                nodes = np.flatnonzero(hits[k])
                if len(nodes):
                    trees = roots[nodes]
                    first = [0] if trees.min() == trees.max() else np.unique(trees, return_index=True)[1].tolist()
                    x += [row] * len(first)
                    y += (start + nodes[first]).tolist()
        return self.forest.join(np.array(x, dtype=np.int64), np.array(y, dtype=np.int64), own)


class _Forest:
    """Which nodes of a shard are joined, by each other or by queries from elsewhere."""

    def __init__(self, n: int) -> None:
        self.parent = np.arange(n)

    def roots(self, start: int, n: int) -> np.ndarray:
        """Tree of each of some nodes."""
        while True:
            above = self.parent[self.parent]
            if (above == self.parent).all():
                return self.parent[start : start + n]
            self.parent = above

    def _root(self, a: int) -> int:
        while (p := int(self.parent[a])) != a:
            a = p
        return a

    def join(self, x: np.ndarray, y: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The links (query, node) that join trees: at most one per query and tree."""
        if not len(x):
            return x, y
        trees = self.roots(0, len(self.parent))[y]
        _, at = np.unique(x * np.int64(len(self.parent)) + trees, return_index=True)
        kept: list[int] = []
        last, tree = -1, -1
        for k, query, node in zip(at.tolist(), x[at].tolist(), y[at].tolist()):
            if query != last:
                # A query of this shard is a node itself; another one starts as a tree of its own.
                last, tree = query, int(own[query])
                tree = self._root(tree) if tree >= 0 else -1
            root = self._root(node)
            if root == tree:
                continue
            kept.append(k)
            if tree >= 0:
                self.parent[max(root, tree)] = min(root, tree)
                tree = min(root, tree)
            else:
                tree = root
        return x[kept], y[kept]


def _search(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    """Per shard its own vectors come first and are indexed; then every vector is a query."""
    shard: Shard | None = None
    own: list[tuple] = []
    current = None

    def answer(keys: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
        counts, a, b = shard.links(keys, vectors)
        some = np.flatnonzero(counts)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([keys[some], a])),
                pa.array(np.concatenate([np.full(len(some), -1), b])),
                pa.array(np.concatenate([counts[some], np.zeros(len(a), dtype=np.int64)])),
            ],
            ["key", "other", "n"],
        )

    for batch in batches:
        shards, queries = batch["shard"].to_numpy(), batch["query"].to_numpy(zero_copy_only=False)
        keys, copies = batch["key"].to_numpy(), batch["copies"].to_numpy()
        dim = batch["dim"].to_numpy()
        flat = batch["embedding"].flatten().to_numpy()
        ends = np.cumsum(dim)
        change = (np.diff(shards) != 0) | np.diff(queries.astype(np.int8)).astype(bool) | (np.diff(dim) != 0)
        edges = [0, *(np.flatnonzero(change) + 1).tolist(), len(keys)]
        for s, e in zip(edges, edges[1:]):
            if s == e:
                continue
            vectors = flat[ends[s] - dim[s] : ends[e - 1]].reshape(e - s, dim[s])
            group = (int(shards[s]), int(dim[s]))
            if not queries[s]:
                if group != current:
                    own, shard, current = [], None, group
                own.append((keys[s:e], copies[s:e], vectors))
                continue
            if group != current:
                continue  # no vector of this length in the shard
            if shard is None:
                shard = Shard(*(np.concatenate(x) for x in zip(*own)), cosine)
                own = []
            for k in range(0, e - s, QUERY_ROWS):
                yield answer(keys[s + k : min(e, s + k + QUERY_ROWS)], vectors[k : k + QUERY_ROWS])


def _lanes(spark: SparkSession, shards: int) -> DataFrame:
    """(shard, lane): numbers that hash to a partition of their own among ``shards``, so no task gets two shards."""
    spread = spark.range(0, 40 * shards + 400).select(F.col("id").cast("int").alias("lane"))
    each = spread.groupBy(F.expr(f"pmod(hash(lane), {shards})").alias("shard")).agg(F.min("lane").alias("lane"))
    # Where no number was found for a partition, the shard's own number will do.
    return spark.range(shards).selectExpr("int(id) AS shard").join(each, "shard", "left").selectExpr(
        "shard", "ifnull(lane, shard) AS lane"
    )


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row per row of ``embeddings``: vec_id, n_links, component_id, kept.

    Two vectors link if their cosine, in double precision, is at least ``cosine``. n_links
    counts the other rows linked directly, component_id is the smallest vec_id reachable,
    and kept tells the row whose vec_id that is.

    Equal vectors are one class, indexed and asked once. Classes are dealt to shards by a
    hash; each shard is indexed by a navigable small-world graph in one task, and every
    class is a query to every shard. A shard widens its beams until audits against
    comparison with all its vectors pass, per query and with queries of all shards. A query whose
    beam is full of links is asked again with a wider one, and beyond ``WIDEST_BEAM`` compared with all
    vectors of the shard, a block at a time, so large groups are found whole. Every link is verified.
    A shard reports counts and a spanning forest of its links; its memory grows with
    its vectors, not with their pairs.

    Vectors that are null, empty, zero or hold null or non-finite components link with
    nothing: n_links 0, component_id their own vec_id, kept. So do vectors of different
    lengths. Rows that repeat a vector link with each other, whatever their ids; null ids
    are never the smallest, and a component of null ids has a null component_id and is kept.
    Only ``vec_id`` and ``embedding`` are read; an empty table gives no rows.
    """
    given = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    usable = (
        "ifnull(size(embedding) > 0 AND forall(embedding, x -> ifnull(abs(x) < double('Infinity') AND NOT isnan(x), false)) "
        "AND exists(embedding, x -> x <> 0), false)"
    )
    rows = given.select("vec_id", F.when(F.expr(usable), F.col("embedding")).alias("embedding"))
    counted = rows.where("embedding IS NOT NULL").groupBy("embedding").agg(
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least")
    )
    classes = stored(counted.withColumn("key", F.monotonically_increasing_id()), "embedding-classes")
    shards = max(LEAST_SHARDS, -(-classes.count() // SHARD_VECTORS))
    sized = classes.select("key", "copies", "embedding", F.size("embedding").alias("dim"))
    own = sized.withColumns({"shard": F.expr(f"int(pmod(xxhash64(key), {shards}))"), "query": F.lit(False)})
    asked = sized.withColumns({"shard": F.explode(F.sequence(F.lit(0), F.lit(shards - 1))), "query": F.lit(True)})
    # One row per shard; queries come in random order, so that the first ones are a fair audit.
    dealt = (
        own.unionByName(asked)
        .join(F.broadcast(_lanes(classes.sparkSession, shards)), "shard")
        .repartition(shards, "lane")
        .sortWithinPartitions("shard", "dim", "query", F.xxhash64("key"))
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _search(batches, cosine)

    found = stored(dealt.mapInArrow(search, "key long, other long, n long"), "embedding-links")
    counts = found.where("other < 0").groupBy("key").agg(F.sum("n").alias("n"))
    joined = components(found.where("other >= 0").selectExpr("key AS a", "other AS b"), "embedding")
    rooted = classes.join(joined.withColumnRenamed("node", "key"), "key", "left").join(counts, "key", "left")
    rooted = rooted.selectExpr("key", "embedding", "copies", "least", "ifnull(root, key) AS root", "ifnull(n, 0) AS n")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    known = rooted.join(named, "root").select("embedding", "copies", "n", "component_id")
    linked = rows.where("embedding IS NOT NULL").join(known, "embedding").selectExpr(
        "vec_id", "n + copies - 1 AS n_links", "component_id"
    )
    alone = rows.where("embedding IS NULL").selectExpr("vec_id", "bigint(0) AS n_links", "vec_id AS component_id")
    return linked.unionByName(alone).selectExpr("*", "vec_id <=> component_id AS kept")
