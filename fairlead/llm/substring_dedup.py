"""Exact substring deduplication by super-k-mer partitioning."""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairlead.llm.common import byte_values, shuffle_partitions, slices, stored, text_bytes
from fairlead.llm.words import IS_SPACE, Spans, normalised, ragged, same_bytes

WINDOW = 20
# Consecutive words whose smallest hash inside a window is its minimiser.
MINIMISER = 4
# Windows of one packed string at most; a longer run is cut, so that repetition stays foldable.
RUN_WINDOWS = 128
# Bytes of text one numpy pass takes, one map task packs before it writes, and one bucket
# should hold at most (packed text is about three times the text).
CHUNK_BYTES = 2 << 20
FLUSH_BYTES = 24 << 20
BUCKET_BYTES = 6 << 20
# Bounds the list of frequent minimisers: each has more than this share of all words.
FREQUENT_SHARE = 1 / 100_000

_U = np.uint64


class Chunk:
    """Some texts, their windows and minimisers."""

    def __init__(self, texts: list[bytes], window: int):
        buffer, self.counts = normalised(texts)
        self.spans = Spans(buffer)
        m = min(MINIMISER, window)
        n = len(self.spans.ends)
        owner = np.repeat(np.arange(len(texts)), self.counts)
        self.grams = np.empty(0, dtype=np.uint64)
        self.starts = np.empty(0, dtype=np.int64)
        if n >= m:
            at = np.arange(n - m + 1)
            # One bit is kept free to rank frequent minimisers last.
            self.grams = self.spans.hashes(at, at + m - 1) >> _U(1)
            self.inside = owner[at] == owner[at + m - 1]
        if n >= window:
            at = np.arange(n - window + 1)
            self.starts = at[owner[at] == owner[at + window - 1]]
        self.owner = owner
        self.first_word = np.cumsum(self.counts) - self.counts
        self.window, self.width = window, window - m + 1

    def frequent_grams(self) -> np.ndarray:
        return self.grams[self.inside] if len(self.grams) else self.grams

    def runs(self, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(minimiser, first word, windows) of each super-k-mer."""
        if not len(self.starts):
            return np.empty(0, np.uint64), self.starts, self.starts
        grams = self.grams
        if len(frequent):
            at = np.minimum(np.searchsorted(frequent, grams), len(frequent) - 1)
            grams = grams | ((frequent[at] == grams).astype(np.uint64) << _U(63))
        low, span = grams, 1
        while span * 2 <= self.width:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < self.width:
            low = np.minimum(low[: len(grams) - self.width + 1], low[self.width - span :])
        least = low[self.starts]
        new = np.ones(len(least), dtype=bool)
        new[1:] = (
            (least[1:] != least[:-1])
            | (self.starts[1:] != self.starts[:-1] + 1)
            | (self.owner[self.starts[1:]] != self.owner[self.starts[:-1]])
        )
        head = np.flatnonzero(new)
        since = np.arange(len(least)) - np.repeat(head, np.diff(np.append(head, len(least))))
        head = np.flatnonzero(since % RUN_WINDOWS == 0)
        return least[head], self.starts[head], np.diff(np.append(head, len(least)))


_HEADER = struct.Struct("<q")


def _pack(ids, versions, starts, windows, text: list[bytes]) -> bytes:
    """One blob of super-k-mers; an empty text marks one that repeats an earlier one of its task."""
    parts = [_HEADER.pack(len(ids))]
    parts += [np.ascontiguousarray(x, dtype=np.int64).tobytes() for x in (ids, versions, starts, windows)]
    parts.append(np.array([len(x) for x in text], dtype=np.int64).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts + text))


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(ids, versions, starts, windows, lengths as rows; text)."""
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = _HEADER.unpack_from(raw)[0]
    table = np.frombuffer(raw, dtype=np.int64, count=5 * n, offset=8).reshape(5, n)
    return table, np.frombuffer(raw, dtype=np.uint8, offset=8 + 40 * n)


class _Packer:
    """Collects the super-k-mers of a map task and writes them bucket by bucket."""

    def __init__(self, window: int, buckets: int, frequent: np.ndarray):
        self.window, self.buckets, self.frequent = window, buckets, frequent
        self._clear()

    def _clear(self) -> None:
        self.columns: list[tuple] = []
        self.texts: list[bytes] = []
        self.held = 0

    def add(self, ids: np.ndarray, versions: np.ndarray, shifts: np.ndarray, texts: list[bytes]) -> None:
        """Texts start ``shifts`` words into their documents."""
        chunk = Chunk(texts, self.window)
        least, first, windows = chunk.runs(self.frequent)
        if not len(first):
            return
        last = first + windows + self.window - 2
        owner = chunk.owner[first]
        start = first - chunk.first_word[owner] + shifts[owner]
        self.columns.append((least, ids[owner], versions[owner], start, windows, chunk.spans.hashes(first, last)))
        data = chunk.spans.text.tobytes()
        self.texts += [data[a:b] for a, b in zip(chunk.spans.starts[first].tolist(), (chunk.spans.ends[last] + 1).tolist())]
        self.held += sum(map(len, texts))

    def flush(self) -> Iterator[tuple[int, bytes]]:
        if not self.columns:
            return
        least, ids, versions, starts, windows, hashes = (np.concatenate(x) for x in zip(*self.columns))
        texts = self.texts
        # Equal super-k-mers of this task: only the earliest carries its words. One at the same
        # place of the same document is that of a repeated row.
        order = np.lexsort((starts, versions, ids, hashes))
        head = np.ones(len(order), dtype=bool)
        head[1:] = hashes[order[1:]] != hashes[order[:-1]]
        origin = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
        k, o = order[~head], origin[~head]
        again = (ids[k] == ids[o]) & (versions[k] == versions[o]) & (starts[k] == starts[o])
        sent = np.ones(len(order), dtype=bool)
        for k, o, row in zip(k.tolist(), o.tolist(), again.tolist()):
            if texts[k] == texts[o]:
                sent[k] = not row
                texts[k] = b""
        bucket = ((least * _U(0x9E3779B97F4A7C15)) >> _U(20)) % _U(self.buckets)
        order = np.argsort(bucket, kind="stable")
        order = order[sent[order]]
        edges = np.flatnonzero(np.diff(bucket[order])) + 1
        for part in np.split(order, edges):
            yield int(bucket[part[0]]), _pack(
                ids[part], versions[part], starts[part], windows[part], [texts[k] for k in part.tolist()]
            )
        self._clear()


def _pieces(text: bytes, window: int) -> Iterator[tuple[bytes, int]]:
    """A text in pieces of about CHUNK_BYTES that share window - 1 words, with their first word."""
    if len(text) <= CHUNK_BYTES:
        yield text, 0
        return
    at, word, tail = 0, 0, b""
    while at < len(text):
        end = min(at + CHUNK_BYTES, len(text))
        while end < len(text) and not IS_SPACE[text[end]]:
            end += 1
        piece = tail + b" " + text[at:end]
        words = piece.split()
        yield piece, word
        kept = words[max(0, len(words) - window + 1) :]
        word += len(words) - len(kept)
        tail, at = b" ".join(kept), end


def _chunks(batches: Iterator[pa.RecordBatch], window: int):
    """(ids, versions, first words, texts) of bounded size; a null id is the smallest one."""
    for part in slices(batches, "text", CHUNK_BYTES):
        ids = np.array(part["doc_id"].to_pylist(), dtype=np.int64)
        versions = np.array(part["version"].to_pylist(), dtype=np.int64)
        texts = byte_values(part["text"])
        if max(map(len, texts)) <= CHUNK_BYTES:
            yield ids, versions, np.zeros(len(ids), dtype=np.int64), texts
            continue
        for k, text in enumerate(texts):
            for piece, word in _pieces(text, window):
                yield ids[k : k + 1], versions[k : k + 1], np.array([word]), [piece]


def _first_matches(text, offsets, lengths, ranks, window):
    """For the super-k-mers of one bucket, the first window equal to each window.

    Returns (first window, record of each window, place of it in its record), windows in the
    order of (document, start).
    """
    spans = Spans(text)
    first = np.searchsorted(spans.starts, offsets)
    words = np.searchsorted(spans.starts, offsets + lengths) - first
    windows = words - window + 1
    by_rank = np.argsort(ranks)
    record = np.repeat(by_rank, windows[by_rank])
    place = ragged(np.zeros(len(by_rank), dtype=np.int64), windows[by_rank])
    at = first[record] + place
    hashes = spans.hashes(at, at + window - 1)
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    head = np.ones(len(order), dtype=bool)
    head[1:] = ordered[1:] != ordered[:-1]
    origin = np.empty(len(order), dtype=np.int64)
    origin[order] = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
    repeats = origin != np.arange(len(order))

    # Equal hashes are proven on the words. Where the windows before both matched too, only
    # the last word is new.
    a, b = spans.starts[at], spans.ends[at + window - 1]
    k = np.flatnonzero(repeats)
    o = origin[k]
    follows = (place[k] > 0) & (place[o] > 0) & (origin[k - 1] == o - 1) & repeats[k - 1]
    last_a, last_o = spans.starts[at[k] + window - 1], spans.starts[at[o] + window - 1]
    from_a, from_o = np.where(follows, last_a, a[k]), np.where(follows, last_o, a[o])
    proven = (b[k] - from_a == b[o] - from_o) & (b[k] - a[k] == b[o] - a[o])
    proven[proven] = same_bytes(text, from_a[proven], from_o[proven], (b[k] - from_a)[proven])
    if not proven.all():
        # Two different windows with one hash: settle the bucket on the words themselves.
        seen: dict[bytes, int] = {}
        for w in range(len(at)):
            origin[w] = seen.setdefault(text[a[w] : b[w]].tobytes(), w)
    return origin, record, place


def _bucket_ranges(blobs: list[bytes], window: int) -> tuple[np.ndarray, ...]:
    """(doc_id, version, first word, word after the last) of what one bucket removes."""
    tables, texts = zip(*map(_unpack, blobs))
    ids, versions, starts, windows, lengths = np.concatenate(tables, axis=1)
    text = np.concatenate(texts)
    copies = lengths == 0
    out = [np.stack([x[copies] for x in (ids, versions, starts, starts + windows + window - 1)])]
    if len(text):
        ids, versions, starts, lengths = (x[~copies] for x in (ids, versions, starts, lengths))
        ranks = np.empty(len(ids), dtype=np.int64)
        ranks[np.lexsort((starts, versions, ids))] = np.arange(len(ids))
        origin, record, place = _first_matches(text, np.cumsum(lengths) - lengths, lengths, ranks, window)
        k = np.flatnonzero(origin != np.arange(len(origin)))
        # A window at the place of its first is that of a repeated row, and not later.
        a, b = record[k], record[origin[k]]
        k = k[(ids[a] != ids[b]) | (versions[a] != versions[b]) | (starts[a] + place[k] != starts[b] + place[origin[k]])]
        if len(k):
            new = np.ones(len(k), dtype=bool)
            new[1:] = (np.diff(k) != 1) | (record[k[1:]] != record[k[:-1]])
            begin = k[new]
            end = k[np.append(np.flatnonzero(new)[1:] - 1, len(k) - 1)]
            r = record[begin]
            out.append(np.stack([ids[r], versions[r], starts[r] + place[begin], starts[r] + place[end] + window]))
    return tuple(np.concatenate(out, axis=1))


def _frequent(keyed: DataFrame, window: int, total_bytes: int, buckets: int) -> np.ndarray:
    """Hashes of word sequences so frequent that one bucket would collect too much as theirs.

    They only rank last as minimisers, so this routes windows and never changes a result. A
    task reports a sequence if it has half its share of the bound, which no frequent one
    misses everywhere; the list is bounded by ``FREQUENT_SHARE``.
    """
    words = max(1.0, total_bytes / 6)
    bound = max(words / buckets / 16, words * FREQUENT_SHARE, 64.0)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def report() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= max(2.0, bound * size / words / 2)
            return pa.RecordBatch.from_arrays(
                [pa.array(values[often].astype(np.int64)), pa.array(counts[often].astype(np.int64))], ["gram", "n"]
            )

        for _, _, _, texts in _chunks(batches, window):
            chunk = Chunk(texts, window)
            held.append(chunk.frequent_grams())
            size += len(held[-1])
            if size >= FLUSH_BYTES // 6:
                yield report()
                held, size = [], 0
        if size:
            yield report()

    counted = keyed.mapInArrow(rows, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    found = counted.where(F.col("n") >= bound / 2).select("gram").toArrow()
    return np.sort(found["gram"].to_numpy().astype(np.uint64))


def _versions(docs: DataFrame, keep: Sequence[str]) -> DataFrame:
    """doc_id, version, text and the kept columns; version is 0 but for ids that several texts share."""
    plain = docs.select(
        F.struct(*[n for n in keep if n != "text"]).alias("kept_columns"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )
    hashed = plain.select("doc_id", F.xxhash64("text").alias("h"))
    shared = stored(
        hashed.groupBy("doc_id").agg(F.min("h").alias("low"), F.max("h").alias("high")).where("low <> high").select("doc_id"),
        "substring-shared-ids",
    )
    if shared.isEmpty():
        return plain.withColumn("version", F.lit(0).cast("long"))
    marked = plain.join(shared.withColumn("several", F.lit(True)), "doc_id", "left")
    return marked.withColumn("version", F.when(F.col("several"), F.xxhash64("text")).otherwise(0)).drop("several")


def repeated_ranges(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, version, first, after): word ranges of ``docs`` (doc_id, version, text) to remove.

    Map tasks cut every text into super-k-mers, runs of windows with one minimiser, and send
    each as one packed string to the bucket of that minimiser; equal windows have equal
    minimisers and meet. Sorting a bucket by window finds every window that starts earlier.
    A super-k-mer that a map task has met before travels without its words.
    """
    spark = docs.sparkSession
    size = text_bytes(docs)
    buckets = max(4 * shuffle_partitions(spark), -(-3 * size // BUCKET_BYTES))
    keyed = docs.select("doc_id", "version", "text")
    frequent = _frequent(keyed, window, size, buckets)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(window, buckets, frequent)

        def flush() -> Iterator[pa.RecordBatch]:
            rows = list(packer.flush())
            for k in range(0, len(rows), 512):
                bucket, blob = zip(*rows[k : k + 512])
                yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(blob, pa.binary())], ["bucket", "blob"])

        for chunk in _chunks(batches, window):
            packer.add(*chunk)
            if packer.held >= FLUSH_BYTES:
                yield from flush()
        yield from flush()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current = [], None
        names = ["doc_id", "version", "first", "after"]

        def ranges() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in _bucket_ranges(held, window)], names)

        for batch in batches:
            for bucket, blob in zip(batch["bucket"].to_pylist(), batch["blob"].to_pylist()):
                if bucket != current and held:
                    yield ranges()
                    held = []
                current = bucket
                held.append(blob)
        if held:
            yield ranges()

    packed = keyed.mapInArrow(pack, "bucket int, blob binary")
    dealt = packed.repartition(max(shuffle_partitions(spark), buckets // 4), "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(search, "doc_id long, version long, first long, after long")


def _cleaned(batches: Iterator[pa.RecordBatch], untouched: bool) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text", 4 * CHUNK_BYTES):
        kept_texts, total, removed = [], [], []
        for text, ranges in zip(byte_values(part["text"]), part["ranges"].to_pylist()):
            words = text.split()
            if ranges:
                gone = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(gone, [r["first"] for r in ranges], 1)
                np.add.at(gone, [r["after"] for r in ranges], -1)
                keep = np.cumsum(gone[:-1]) == 0
                kept = [w for w, k in zip(words, keep.tolist()) if k]
            else:
                kept = words
            total.append(len(words))
            removed.append(len(words) - len(kept))
            joined = text if untouched and not ranges else b" ".join(kept)
            kept_texts.append(joined.decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays(
            [
                part["kept_columns"],
                pa.array(total, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(kept_texts, pa.string()),
            ],
            ["kept_columns", "n_words", "n_removed", "kept"],
        )


def dedup_substrings(
    docs: DataFrame, window: int = WINDOW, keep: Sequence[str] = ("doc_id",), untouched: bool = False
) -> DataFrame:
    """One row per row of ``docs``: the ``keep`` columns, n_words, n_removed, kept.

    Words are split at ASCII white space and compared as they are. Removed is each word that
    lies in a window of ``window`` words whose sequence also starts earlier: in a smaller
    doc_id or before in the same document. Windows are judged on the input. ``kept`` is the
    kept words joined by one space; with ``untouched``, a text that loses nothing stays as
    it is.

    Only ``doc_id``, ``text`` and the ``keep`` columns are read, so others may have any name.
    A null text has no words; a text with fewer words than the window loses none; a null
    doc_id counts as smaller than all others. Rows that repeat doc_id and text are one
    document and get equal results; different texts under one doc_id are ordered by a hash
    of the text. An empty table gives no rows.
    """
    keyed = _versions(docs, keep)
    ranges = repeated_ranges(keyed.select("doc_id", "version", "text"), window)
    gathered = ranges.groupBy("doc_id", "version").agg(F.collect_set(F.struct("first", "after")).alias("ranges"))
    joined = keyed.join(gathered, ["doc_id", "version"], "left").select("kept_columns", "text", "ranges")
    kind = joined.schema["kept_columns"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _cleaned(batches, untouched)

    cleaned = joined.mapInArrow(rows, f"kept_columns {kind}, n_words long, n_removed long, kept string")
    return cleaned.select("kept_columns.*", "n_words", "n_removed", "kept")


def digest(result: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of ``dedup_substrings``."""
    return result.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


