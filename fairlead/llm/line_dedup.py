"""Line dedup against levelled sorted runs of line hashes. Spark functions only."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fairlead.config import scratch_dir
from fairlead.llm.common import shuffle_partitions, stored
from fairlead.sources.landing import list_files

# Keys of fewer code points are never compared.
MIN_CHARS = 10
# A level with this many runs is merged into one run of the next level.
FANOUT = 2
# Batches that a table known as a whole is taken in.
BATCHES = 4
# Most keys of a batch that are looked up by broadcast: 24 bytes each.
HOT_KEYS = 10_000

_STRIPPED = " \t\n\x0b\f\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_KEY = ["h1", "h2"]
_RUN = "h1 long, h2 long, first long, n long"


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z in lower case."""
    key = F.btrim(line, F.lit(_STRIPPED))
    # lower() touches more than A-Z outside ASCII, where translate() is the slower way.
    return F.when(F.octet_length(key) == F.char_length(key), F.lower(key)).otherwise(
        F.translate(key, _UPPER, _UPPER.lower())
    )


def line_hashes(docs: DataFrame, *more: Column) -> DataFrame:
    """(doc_id, text_hash, at, h1, h2) of every line that can be dropped, and ``more`` columns.

    Two 64-bit hashes of a key under different seeds stand for it: the odds that any two of
    10^12 different keys share both are below 10^-14. ``text_hash`` tells rows apart that
    share an id.
    """
    # Split first: a generator would carry the whole text along with each of its lines.
    split = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), *more, _lines().alias("_lines"))
    own = split.columns[:-1]
    lines = split.select(*own, F.posexplode("_lines").alias("at", "line"))
    kept = [*own, "at"]
    keyed = lines.select(*kept, line_key(F.col("line")).alias("key")).where(F.char_length("key") >= MIN_CHARS)
    return keyed.select(*kept, F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


class LineRuns:
    """The line hashes of all batches so far, as sorted runs in levels below one folder.

    A run holds each key once, with the smallest doc_id of its batch, in buckets by key and
    sorted inside them; keys of different runs differ. Each level has at most ``fanout``
    runs: when it is full, the next batch first merges them into one run of the level above,
    so that n batches leave about log n runs and a key is rewritten log n times.

    All runs share their buckets, so meeting or merging them needs no shuffle: only the keys
    of the new batch move. A manifest, replaced after each step, names the runs that count;
    an index opened on the same folder later goes on from it, and what a killed step
    left is ignored.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None, fanout: int = FANOUT):
        if fanout < 2:
            raise ValueError("fanout is 2 or more")
        self.spark, self.root, self.fanout = spark, root.rstrip("/"), fanout
        self.buckets = buckets or shuffle_partitions(spark)
        self.levels: list[list[str]] = []
        self._version = 0
        self._tables: dict[str, str] = {}
        self._resume()

    def add(self, lines: DataFrame, hot_keys: int = HOT_KEYS) -> DataFrame:
        """(doc_id, text_hash, gone): positions of the lines of a batch that go, stored.

        ``lines`` are ``line_hashes`` of documents whose ids are larger than those of all
        batches before, and are read four times: store them. The keys of the batch, each
        counted once with its smallest doc_id, are anti-joined with every run by merging
        buckets; what is left is the batch's own run. A line stays only in the document
        that the own run names for its key.

        Keys so frequent that at most ``hot_keys`` of them can exist are looked up by
        broadcast, so no task holds the lines of a common key; the others meet the run
        by merging.
        """
        self._compact()
        counted = lines.groupBy(*_KEY).agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
        batch = self._write(counted)
        held = self.runs()
        own = batch
        if held:
            fresh = reduce(lambda left, run: left.join(self._read(run), _KEY, "left_anti"), held, self._read(batch))
            own = self._write(fresh)
        keys = self._read(own).select(*_KEY, "first", F.lit(True).alias("fresh"))
        total = self._read(batch).agg(F.sum("n")).first()[0] or 0
        frequent = self._read(batch).where(F.col("n") > total // max(1, hot_keys)).select(*_KEY)
        hot = stored(frequent.join(keys, _KEY, "left"), "line-hot")
        found = lines.join(F.broadcast(hot), _KEY)
        others = lines.join(F.broadcast(hot.select(*_KEY)), _KEY, "left_anti").join(keys, _KEY, "left")
        gone = found.unionByName(others).where("fresh IS NULL OR NOT (doc_id <=> first)")
        dropped = stored(gone.groupBy("doc_id", "text_hash").agg(F.collect_set("at").alias("gone")), "line-gone")
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(own)
        self._save()
        return dropped

    def runs(self) -> list[str]:
        return [run for level in self.levels for run in level]

    def close(self) -> None:
        """Take the runs' names out of the catalog; the runs stay and can be opened again."""
        for name in self._tables.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self._tables.clear()

    def _compact(self) -> None:
        """Merge every full level into one run of the next, lowest first."""
        level = 0
        while level < len(self.levels):
            runs = self.levels[level]
            if len(runs) >= self.fanout:
                merged = self._write(reduce(self._merge, runs[1:], self._read(runs[0])))
                if level + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[level] = []
                self.levels[level + 1].append(merged)
                self._save()
            level += 1

    def _merge(self, left: DataFrame, run: str) -> DataFrame:
        """Both sorted runs as one; their keys differ. A full join merges buckets where a union would mix them."""
        right = self._read(run).selectExpr(*_KEY, "first AS first_r", "n AS n_r")
        return left.join(right, _KEY, "full").selectExpr(
            *_KEY, "if(n IS NULL, first_r, first) AS first", "ifnull(n, n_r) AS n"
        )

    def _write(self, run: DataFrame) -> str:
        path = f"{self.root}/run-{uuid.uuid4().hex}"
        name = self._name(path)
        run.select("h1", "h2", "first", "n").write.bucketBy(self.buckets, *_KEY).sortBy(*_KEY).option(
            "compression", "zstd"
        ).option("path", path).saveAsTable(name)
        return path

    def _read(self, path: str) -> DataFrame:
        return self.spark.table(self._name(path))

    def _name(self, path: str) -> str:
        return self._tables.setdefault(path, f"line_{path.rsplit('-', 1)[1]}")

    def _save(self) -> None:
        self._version += 1
        rows = [(level, run, self.buckets) for level, runs in enumerate(self.levels) for run in runs]
        manifest = self.spark.createDataFrame(rows, "level int, run string, buckets int").coalesce(1)
        manifest.write.parquet(f"{self.root}/manifest-{self._version:012d}")

    def _resume(self) -> None:
        files = list_files(self.spark, f"{self.root}", "part-*.parquet")
        if files is None:
            return
        newest = files.select(F.max(F.regexp_extract("path", r"/manifest-([0-9]{12})/", 1))).first()[0]
        if not newest:
            return
        self._version = int(newest)
        for row in self.spark.read.parquet(f"{self.root}/manifest-{newest}").orderBy("level").collect():
            while len(self.levels) <= row["level"]:
                self.levels.append([])
            self.levels[row["level"]].append(row["run"])
            self.buckets = row["buckets"]
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self._name(row['run'])} ({_RUN}) USING parquet CLUSTERED BY (h1, h2) "
                f"SORTED BY (h1, h2) INTO {self.buckets} BUCKETS LOCATION '{row['run']}'"
            )


def dedup_batch(runs: LineRuns, docs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The documents of a new batch without the lines that earlier batches or documents hold.

    See ``dedup_lines`` for the columns; ids must be larger than those of earlier batches.
    """
    return _without(docs, runs.add(stored(line_hashes(docs), "lines")), keep)


def dedup_lines(
    docs: DataFrame, batches: int = BATCHES, keep: Sequence[str] = (), hot_keys: int = HOT_KEYS
) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept: every text without the lines that a smaller doc_id holds.

    A text is split at newlines. Lines whose key (see ``line_key``) has ``MIN_CHARS`` code
    points or more stay only in the smallest doc_id that holds the key; all its lines with
    that key stay there. Columns named in ``keep`` pass through.

    The table is taken in ``batches`` by rising doc_id, each of about as many rows. Lines
    are hashed once and stored; texts are read twice and move once, to meet the positions of
    the lines that go.

    A null text is one empty line. Rows that share an id are one document. Rows without an
    id are one document that comes after all others. Rows that repeat are kept as often as
    they occur. An empty table gives no rows.
    """
    spark = docs.sparkSession
    shares = [k / batches for k in range(1, batches)]
    found = docs.select(F.percentile_approx("doc_id", shares, 10_000)).first()[0] if shares else None
    bounds = sorted(set(found or []))
    batch = sum([F.when(F.col("doc_id") <= bound, 0).otherwise(1) for bound in bounds], F.lit(0))
    lines = line_hashes(docs, batch.cast("int").alias("batch"))
    path = scratch_dir(spark, "lines")
    lines.write.option("compression", "zstd").partitionBy("batch").parquet(path)
    hashes = spark.read.schema(lines.schema).parquet(path)
    runs = LineRuns(spark, scratch_dir(spark, "line-runs"))
    gone = [runs.add(hashes.where(F.col("batch") == k).drop("batch"), hot_keys) for k in range(len(bounds) + 1)]
    runs.close()
    return _without(docs, reduce(DataFrame.unionByName, gone), keep)


def digest(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def _lines() -> Column:
    return F.split(F.ifnull(F.col("text"), F.lit("")), "\n")


def _without(docs: DataFrame, gone: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The texts of ``docs`` without the lines at the positions ``gone``."""
    clash = set(keep) & {"doc_id", "n_lines", "n_dropped", "kept"}
    if clash:
        raise ValueError(f"columns of the result cannot be kept: {sorted(clash)}")
    rows = docs.select("doc_id", "text", *keep, F.xxhash64("text").alias("_hash"))
    places = gone.selectExpr("doc_id AS _id", "text_hash AS _text_hash", "gone AS _gone")
    met = rows.join(places, F.expr("doc_id <=> _id AND _hash = _text_hash"), "left")
    split = met.select("doc_id", "text", *keep, "_gone", _lines().alias("_lines"))
    # The places that stay, in order: one pass with a set, whatever the number of lines.
    left = "array_except(sequence(0, size(_lines) - 1), _gone)"
    return split.selectExpr(
        "doc_id",
        *[f"`{c}`" for c in keep],
        "bigint(size(_lines)) AS n_lines",
        "bigint(if(_gone IS NULL, 0, size(_gone))) AS n_dropped",
        f"if(_gone IS NULL, ifnull(text, ''), array_join(transform({left}, k -> _lines[k]), '\\n')) AS kept",
    )
