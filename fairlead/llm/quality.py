"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fairlead.llm.common import byte_values, kept_fields, lowest, slices, stored
from fairlead.llm.words import Spans, normalised

# Bounds of the training sample: labelled documents, and the lines of all of them together.
SAMPLE_DOCS = 4000
SAMPLE_LINES = 200_000
THRESHOLD = 0.3
CHUNK_BYTES = 2 << 20

# Byte classes counted per line.
_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "stop": b".,;:'\"()-",
    "mark": b"!?",
    "symbol": b"#$%&*+/<=>@[\\]^_`{|}~",
    "beyond": bytes(range(128, 256)),
    "control": bytes([*range(9), *range(14, 32), 127]),
}
_CLASS = np.zeros(256, dtype=np.uint8)
for _k, _bytes in enumerate(_CLASSES.values(), start=1):
    _CLASS[list(_bytes)] = _k
OWN = len(_CLASSES) + 9
WIDTH = 3 * OWN + 2


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of each line, bytes of each line, lines of each text).

    A line's features are its own measures and those of the lines before and after it, zero
    with a flag at either end. A text without any byte has one empty line.
    """
    joined = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    ends = np.flatnonzero(joined == 0x0A)
    starts = np.concatenate([[0], ends[:-1] + 1])
    text_ends = np.cumsum([len(x) + 1 for x in texts]) - 1
    lines = np.diff(np.concatenate([[0], np.searchsorted(ends, text_ends, side="right")]))
    size = ends - starts
    kinds = _CLASS[joined]
    own = np.zeros((len(ends), OWN))
    whole = np.maximum(size, 1)
    for k in range(len(_CLASSES)):
        own[:, k] = np.add.reduceat(kinds == k + 1, starts) / whole
    at = len(_CLASSES)

    # Words line by line: the line end is a gap between words like any other.
    buffer, words = normalised(_lines(joined, starts, ends))
    spans = Spans(buffer)
    n = len(spans.ends)
    owner = np.repeat(np.arange(len(ends)), words)
    each = np.maximum(words, 1)
    own[:, at] = np.log1p(words)
    own[:, at + 1] = np.log1p(size)
    own[:, at + 2] = size / each / 8
    if n:
        k = np.arange(n)
        hashes = spans.hashes(k, k)
        again = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
        own[:, at + 3] = np.bincount(owner[1:][again], minlength=len(ends)) / each
        order = np.lexsort((hashes, owner))
        first = np.ones(n, dtype=bool)
        first[1:] = (hashes[order[1:]] != hashes[order[:-1]]) | (owner[order[1:]] != owner[order[:-1]])
        own[:, at + 4] = 1 - np.bincount(owner[order[first]], minlength=len(ends)) / each
        length = spans.ends - spans.starts
        own[:, at + 5] = np.bincount(owner[length == 1], minlength=len(ends)) / each
        own[:, at + 6] = np.bincount(owner[length > 12], minlength=len(ends)) / each
        line_first = np.cumsum(words) - words
        filled = np.flatnonzero(words)
        whole_line = np.zeros(len(ends), dtype=np.uint64)
        whole_line[filled] = spans.hashes(line_first[filled], line_first[filled] + words[filled] - 1)
        doc = np.repeat(np.arange(len(texts)), lines)
        order = np.lexsort((whole_line, doc))
        same = (whole_line[order[1:]] == whole_line[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
        repeated = np.zeros(len(ends), dtype=bool)
        repeated[order[1:][same]] = True
        repeated[order[:-1][same]] = True
        own[:, at + 7] = repeated & (words > 0)
    own[:, at + 8] = words == 0

    first_line = np.cumsum(lines) - lines
    features = np.zeros((len(ends), WIDTH), dtype=np.float32)
    features[:, :OWN] = own
    features[1:, OWN : 2 * OWN] = own[:-1]
    features[:-1, 2 * OWN : 3 * OWN] = own[1:]
    last_line = first_line + lines - 1
    features[first_line, OWN : 2 * OWN] = 0
    features[last_line, 2 * OWN : 3 * OWN] = 0
    features[first_line, 3 * OWN] = 1
    features[last_line, 3 * OWN + 1] = 1
    return features, size, lines


def _lines(joined: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    raw = joined.tobytes()
    return [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]


@dataclass(frozen=True)
class Model:
    """Weights of the field: standardised features to the odds of good, and transition scores.

    ``transition[a, b]`` scores a line of label b after one of label a (0 bad, 1 good).
    """

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    transition: np.ndarray

    def odds(self, features: np.ndarray) -> np.ndarray:
        return ((features - self.mean) / self.scale) @ self.weights + self.bias

    def scores(self, features: np.ndarray, size: np.ndarray, lines: np.ndarray) -> np.ndarray:
        """Mean probability of good over the lines of each text, weighted by their bytes."""
        forward, backward = _messages(self.odds(features), lines, self.transition)
        good = _sigmoid(forward + backward)
        first = np.cumsum(lines) - lines
        weight = size + 1.0
        return np.clip(np.add.reduceat(good * weight, first) / np.add.reduceat(weight, first), 0.0, 1.0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _step(odds: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """Log odds that reach the next line from ``odds`` at this one."""
    return np.logaddexp(transition[0, 1], odds + transition[1, 1]) - np.logaddexp(transition[0, 0], odds + transition[1, 0])


def _messages(odds: np.ndarray, lines: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward log odds of each line, its own included, and backward ones, its own left out.

    All texts advance together, a line at a time.
    """
    forward, backward = odds.astype(np.float64), np.zeros(len(odds))
    first = np.cumsum(lines) - lines
    by_length = np.argsort(-lines, kind="stable")
    first, length = first[by_length], lines[by_length]
    active = np.searchsorted(-length, -np.arange(1, length[0]), side="left") if len(length) and length[0] > 1 else []
    for t, k in enumerate(active, start=1):
        at = first[:k] + t
        forward[at] += _step(forward[at - 1], transition)
    last = first + length - 1
    for t, k in enumerate(active, start=1):
        at = last[:k] - t
        backward[at] = _step(odds[at + 1] + backward[at + 1], transition.T)
    return forward, backward


def fit(features: np.ndarray, lines: np.ndarray, labels: np.ndarray, steps: int = 300, decay: float = 1e-3) -> Model:
    """Maximum likelihood of lines that all carry their document's label, by Adam; no randomness.

    Without any document all weights are zero and every score is 0.5.
    """
    width = features.shape[1]
    if not len(lines):
        return Model(np.zeros(width), np.ones(width), np.zeros(width), 0.0, np.zeros((2, 2)))
    mean, scale = features.mean(axis=0, dtype=np.float64), features.std(axis=0, dtype=np.float64)
    scale = np.where(scale > 1e-6, scale, 1.0)
    x = (features - mean) / scale
    y = np.repeat(labels, lines).astype(np.float64)
    # Documents count alike, however many lines they have.
    share = np.repeat(1 / lines, lines) / len(lines)
    inner = np.ones(len(y), dtype=bool)
    inner[np.cumsum(lines) - 1] = False
    here = np.flatnonzero(inner)
    values = np.zeros(width + 5)
    mean_g, square_g = np.zeros_like(values), np.zeros_like(values)
    for step in range(1, steps + 1):
        transition = values[width + 1 :].reshape(2, 2)
        odds = x @ values[:width] + values[width]
        forward, backward = _messages(odds, lines, transition)
        error = (y - _sigmoid(forward + backward)) * share
        gradient = np.empty_like(values)
        gradient[:width] = x.T @ error - decay * values[:width]
        gradient[width] = error.sum()
        pair = np.zeros((2, 2))
        if len(here):
            after = odds[here + 1] + backward[here + 1]
            score = np.stack([a * forward[here] + transition[a, b] + b * after for a in (0, 1) for b in (0, 1)])
            score = np.exp(score - score.max(axis=0))
            expected = score / score.sum(axis=0)
            seen = np.stack([(y[here] == a) & (y[here + 1] == b) for a in (0, 1) for b in (0, 1)])
            pair = ((seen - expected) * share[here]).sum(axis=1).reshape(2, 2)
        gradient[width + 1 :] = (pair - decay * transition).ravel()
        mean_g = 0.9 * mean_g + 0.1 * gradient
        square_g = 0.999 * square_g + 0.001 * gradient**2
        values += 0.1 * (mean_g / (1 - 0.9**step)) / (np.sqrt(square_g / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, values[:width], float(values[width]), values[width + 1 :].reshape(2, 2))


def held_out(doc_id) -> F.Column:
    """Whether crc32 of the id as text is divisible by five; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_lines: int = SAMPLE_LINES) -> Model:
    """Fits the field on at most ``sample_docs`` labelled documents that are not held out.

    The sample takes the smallest hashes of the id, and whole documents, until they have
    ``sample_lines`` lines together; a document of more lines than that is no part of it. An id labelled
    several times counts with its largest label. Null labels are ignored. The driver
    receives line features of the sample only.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_docs)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", CHUNK_BYTES):
            found = []
            for text in byte_values(part["text"]):
                fits = text.count(b"\n") < sample_lines
                found.append(line_features([text])[0].astype(np.float32).tobytes() if fits else None)
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], part["quality"], part["h"], pa.array(found, pa.binary())], ["doc_id", "quality", "h", "features"]
            )

    # At most ``sample_docs`` rows of two numbers: bounded, whatever the input.
    sample = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", F.xxhash64("doc_id", "text").alias("h"), "text")
    fitting = stored(
        sample.mapInArrow(rows, "doc_id long, quality int, h long, features binary").where("features IS NOT NULL"),
        "quality-sample",
    )
    by_hash = Window.orderBy("h", "doc_id", "features").rowsBetween(Window.unboundedPreceding, 0)
    few = lowest(fitting, "h", sample_docs).orderBy("h", "doc_id", "features").limit(sample_docs)
    lines = few.withColumn("lines", F.sum(F.length("features")).over(by_hash) / (4 * WIDTH))
    taken = lines.where(F.col("lines") <= sample_lines).orderBy("h", "doc_id", "features").select("quality", "features").collect()
    each = [np.frombuffer(r.features, dtype=np.float32).reshape(-1, WIDTH) for r in taken]
    stacked = np.concatenate(each) if each else np.empty((0, WIDTH), dtype=np.float32)
    return fit(stacked, np.array([len(x) for x in each], dtype=np.int64), np.array([r.quality for r in taken], dtype=np.int64))


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns of every row of ``docs``, and its ``score``.

    Every whole text is scored: all its lines form one chain. Neither the id nor any other
    column than the text enters a score. A null or empty text has one empty line.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_scored_text", CHUNK_BYTES):
            values = model.scores(*line_features(byte_values(part["_scored_text"])))
            kept = [part["_scored_text" if name == "text" else name] for name in keep]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(values, pa.float64())], [*keep, "score"])

    given = docs.select(*[n for n in keep if n != "text"], F.col("text").cast("string").alias("_scored_text"))
    return given.mapInArrow(rows, f"{kept_fields(docs, keep)}, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Only ``doc_id`` and ``text`` of ``docs`` and ``doc_id`` and ``quality`` of ``labels`` are
    read, so other columns may have any name. Repeated rows get equal results, a null id is
    scored like any other, and without usable labels every score is 0.5. An empty table
    gives no rows.
    """
    model = train(docs, labels)
    scored = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
