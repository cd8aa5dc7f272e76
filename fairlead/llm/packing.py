"""Best-fit packing of tokenised documents into sequences, improved by local search."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairlead.llm.common import byte_values, shuffle_partitions, slices, stored
from fairlead.llm.words import distinct_words, normalised, ragged

CAPACITY = 4096
END_ID = 1
CHUNK_BYTES = 4 << 20
# Pieces one task packs together, and words whose ids one Python worker remembers.
GROUP_PIECES = 2000
CACHE_WORDS = 1_000_000
# Groups that a task packs one after the other, in large jobs.
GROUPS_A_TASK = 64
# Bins filled less are dissolved and packed again with those of other groups.
FULL_SHARE = 0.995

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_LETTERS = re.compile("[a-zA-ZÀ-ÖØ-öø-ÿ]+")
# Byte-level alphabets write printable bytes as themselves, the others as the signs from 256 on.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_SIGNS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PRINTED)}
_MARKS = b".,;:!?*$#%&|"
_PLAIN = b"abcdefghijklmnopqrstuvwxyz0123456789"


class WordIds:
    """Token ids of words, remembered, for tokenizers that never join across ASCII white space.

    The tokenizer's normaliser lower-cases and turns white space into a space, and its
    splitter drops spaces and separates letters and digits from other characters. So the ids
    of a text are those of its words in turn, and the ids of a word are those of its stem
    and of the marks that follow a letter or digit. New stems are encoded together, one line
    each, and the tokens are told apart by their places.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        probes = ("pro", "letters", "façade", "Übermäßig", "ñandú", "œuvre"[1:])
        self.direct = all(self._direct(x) == self.tokenizer.encode(x, add_special_tokens=False).ids for x in probes)
        self._clear()

    def _direct(self, letters: str) -> list[int]:
        """Ids of a word of Latin letters, which the normaliser and splitter only lower-case."""
        return [t.id for t in self.model.tokenize(letters.lower().encode().decode("latin-1").translate(_BYTE_SIGNS))]

    def _clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.starts = np.empty(0, dtype=np.int64)
        self.lengths = np.empty(0, dtype=np.int64)
        self.ids = np.empty(0, dtype=np.uint32)

    def _learn(self, words: list[bytes]) -> None:
        halves = []
        for word in words:
            stem = word.rstrip(_MARKS)
            halves.append((stem, word[len(stem) :]) if len(stem) < len(word) and stem and stem[-1] in _PLAIN else (word,))
        # Parts that are not words of the list themselves are remembered too.
        parts = list(dict.fromkeys(x for half in halves for x in half if x not in self.known))
        names, ids, counts, others = [], [], [], []
        tokenize = self.model.tokenize
        for part in parts:
            if self.direct and part.isalpha() and part.islower():
                # ASCII letters are their own signs.
                found = [t.id for t in tokenize(part.decode())]
                names.append(part)
                ids += found
                counts.append(len(found))
                continue
            text = part.decode("utf-8", "replace")
            if self.direct and _LETTERS.fullmatch(text):
                found = self._direct(text)
                names.append(part)
                ids += found
                counts.append(len(found))
            else:
                others.append((part, text))
        for k in range(0, len(others), 20_000):
            batch, texts = zip(*others[k : k + 20_000])
            encoded = self.tokenizer.encode("\n".join(texts), add_special_tokens=False)
            begin = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
            places = np.array([o[0] for o in encoded.offsets], dtype=np.int64)
            counts += np.bincount(np.searchsorted(begin, places, side="right") - 1, minlength=len(texts)).tolist()
            names += batch
            ids += encoded.ids
        lengths = np.array(counts, dtype=np.int64)
        every = np.concatenate([self.ids, np.array(ids, dtype=np.uint32)])
        self._add(names, every, len(self.ids) + np.cumsum(lengths) - lengths, lengths)
        joined = [(w, self.known[h[0]], self.known[h[1]]) for w, h in zip(words, halves) if len(h) == 2]
        if joined:
            names, first, second = zip(*joined)
            two = np.stack([first, second], axis=1).ravel()
            more = self.ids[ragged(self.starts[two], self.lengths[two])]
            lengths = self.lengths[two].reshape(-1, 2).sum(axis=1)
            self._add(names, np.concatenate([self.ids, more]), len(self.ids) + np.cumsum(lengths) - lengths, lengths)

    def _add(self, words, ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
        self.known.update(zip(words, range(len(self.starts), len(self.starts) + len(words))))
        self.ids = ids
        self.starts = np.concatenate([self.starts, starts])
        self.lengths = np.concatenate([self.lengths, lengths])

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text, ``END_ID`` last."""
        buffer, counts = normalised(texts)
        raw = buffer.tobytes()
        # Special tokens are told by their case, so texts that may hold one keep it.
        if b"<|" not in raw:
            raw = raw.translate(_LOWER)
            buffer = np.frombuffer(raw, dtype=np.uint8)
        first, which = distinct_words(buffer)
        ends = np.flatnonzero(buffer == 0x20)
        begin = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
        words = [raw[a:b] for a, b in zip(begin[first].tolist(), ends[first].tolist())]
        places = list(map(self.known.get, words))
        if None in places:
            new = [w for w, place in zip(words, places) if place is None]
            if len(self.known) + len(new) > CACHE_WORDS:
                self._clear()
                new, places = words, [None] * len(words)
            self._learn(new)
            places = [self.known[w] if place is None else place for w, place in zip(words, places)]
        at = np.array(places, dtype=np.int64)[which]
        lengths = self.lengths[at]
        ids = self.ids[ragged(self.starts[at], lengths)]
        ends_of = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(counts)]
        starts_of = np.concatenate([[0], ends_of[:-1]])
        end = np.uint32(END_ID)
        return [np.append(ids[a:b], end) for a, b in zip(starts_of.tolist(), ends_of.tolist())]


_workers: dict[str, WordIds] = {}


def tokenised(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """A written table of pieces: key, doc_id, piece, start, length, ids.

    ``ids`` holds little-endian unsigned 32-bit token ids. Only documents of more than
    ``capacity`` ids are cut. ``key`` numbers the pieces uniquely, also where doc_id repeats.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _workers.get(tokenizer) or _workers.setdefault(tokenizer, WordIds(tokenizer))
        key = TaskContext.get().partitionId() << 36
        for part in slices(batches, "text", CHUNK_BYTES):
            columns: dict[str, list] = {n: [] for n in ("key", "doc_id", "piece", "start", "length", "ids")}
            for doc_id, ids in zip(part["doc_id"].to_pylist(), words.encode(byte_values(part["text"]))):
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    cut = ids[start : start + capacity]
                    values = (key, doc_id, piece, start, len(cut), cut.astype("<u4").tobytes())
                    for column, value in zip(columns.values(), values):
                        column.append(value)
                    key += 1
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns.values(), types)], list(columns)
            )

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(
        given.mapInArrow(rows, "key long, doc_id long, piece int, start long, length long, ids binary"), "packing-pieces"
    )


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: bins as lists of item numbers. Longest first, into the tightest bin."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if a bin has exactly r left
    bins: list[list[int]] = []
    for item in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        size = lengths[item]
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, len(bins)
            bins.append([])
        bins[b].append(item)
        by_room[room - size].append(b)
        rooms |= 1 << (room - size)
    return bins


def improve(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """Swap-based local search over underfull bins, until no step is left.

    A bin gives to another whatever raises the sum of squared fills most: a document moves, one
    is exchanged for a shorter one, or two for one. Every step raises that sum, so the search
    ends; free space gathers in few bins, and one that runs empty is gone. Bins give in
    turn, the emptiest first, in passes until a pass changes nothing. A bin that had nothing to give
    looks only at bins that changed since.
    """
    items = np.array([k for b in bins for k in b], dtype=np.int64)
    sizes = np.array(lengths, dtype=np.int64)[items]
    where = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
    fill = np.bincount(where, weights=sizes, minlength=len(bins)).astype(np.int64)
    changed = np.zeros(len(bins), dtype=np.int64)  # the step at which a bin last changed
    looked = np.full(len(bins), -1, dtype=np.int64)  # the step until which a bin has found nothing to give
    step, before = 0, -1
    while before < step:
        before = step
        giving = np.flatnonzero((fill > 0) & (fill < capacity))
        for source in giving[np.argsort(fill[giving], kind="stable")].tolist():
            while 0 < fill[source] < capacity:
                since = looked[source] if changed[source] <= looked[source] else -1
                best = _best_step(source, sizes, where, fill, changed, since, capacity)
                if best is None:
                    looked[source] = step
                    break
                target, given, taken = best
                where[given] = target
                gain = int(sizes[given].sum())
                if taken >= 0:
                    where[taken] = source
                    gain -= int(sizes[taken])
                fill[source] -= gain
                fill[target] += gain
                step += 1
                changed[source] = changed[target] = step
    order = np.argsort(where, kind="stable")
    cuts = np.flatnonzero(np.diff(where[order])) + 1
    return [part.tolist() for part in np.split(items[order], cuts)] if len(items) else []


def _best_step(
    source: int, sizes: np.ndarray, where: np.ndarray, fill: np.ndarray, changed: np.ndarray, since: int, capacity: int
) -> tuple[int, list[int], int] | None:
    """(target bin, items given, item taken or -1) that raises the sum of squared fills most; None for none.

    Moving g tokens from a bin filled f to one filled h changes the sum by 2g(h - f + g): the more the
    better, as far as it is above zero. So for each item of a target, and for its bare room, only the largest
    offer that fits counts, and that is looked up among the sorted ones.
    """
    open_bins = (fill > 0) & (fill < capacity) & (changed > since)
    open_bins[source] = False
    theirs = np.flatnonzero(open_bins[where])
    targets = np.flatnonzero(open_bins)
    own = np.flatnonzero(where == source)
    own = own[np.argsort(sizes[own], kind="stable")]
    own = own[np.append([True, True], sizes[own[2:]] != sizes[own[:-2]])[: len(own)]]  # more of a size offer nothing new
    a, c = np.triu_indices(len(own), 1)
    singles = np.stack([sizes[own], own, np.full(len(own), -1)], axis=1)
    pairs = np.stack([sizes[own[a]] + sizes[own[c]], own[a], own[c]], axis=1)
    both = np.concatenate([singles, pairs])
    both = both[np.argsort(both[:, 0], kind="stable")]
    best, found = 0, None
    # A document, or two, for one; then a document for nothing.
    for offers, bins, back, taken in (
        (both, where[theirs], sizes[theirs], theirs),
        (singles, targets, np.zeros(len(targets), dtype=np.int64), np.full(len(targets), -1)),
    ):
        at = np.searchsorted(offers[:, 0], back + capacity - fill[bins], side="right") - 1
        gain = np.where(at >= 0, offers[at, 0] - back, 0)
        value = np.where(gain > 0, 2 * gain * (fill[bins] - fill[source] + gain), 0)
        k = int(value.argmax()) if len(value) else 0
        if len(value) and value[k] > best:
            given = [int(x) for x in offers[at[k], 1:] if x >= 0]
            best, found = int(value[k]), (int(bins[k]), given, int(taken[k]))
    return found


def _group_packer(round_: int, last: bool, capacity: int):
    """Packs one group: places of its pieces, and whether their bins are settled."""

    def pack_group(key, frame):
        frame = frame.sort_values(["length", "key"], ascending=False, kind="stable")
        lengths = frame["length"].tolist()
        bins = improve(best_fit(lengths, capacity), lengths, capacity)
        item = np.array([x for b in bins for x in b], dtype=np.int64)
        sizes = frame["length"].to_numpy()[item]
        ends = np.cumsum(sizes)
        counts = np.array([len(b) for b in bins])
        first = np.repeat((ends - sizes)[np.cumsum(counts) - counts], counts)
        number = np.repeat(np.arange(len(bins), dtype=np.int64), counts)
        total = np.repeat(np.add.reduceat(sizes, np.cumsum(counts) - counts), counts)
        return pd.DataFrame(
            {
                "key": frame["key"].to_numpy()[item],
                "length": sizes,
                "sequence_id": -(1 + ((np.int64(round_) << 56) | (np.int64(key[0]) << 16) | number)),
                "offset": ends - sizes - first,
                "settled": last | (total >= FULL_SHARE * capacity),
            }
        )

    return pack_group


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(key, sequence_id, offset) for pieces (key, length) of at most ``capacity`` tokens.

    Full pieces are sequences by themselves. The others are dealt to groups of bounded size,
    packed best fit and improved by local search; bins that stay underfull are dissolved and
    meet those of other groups in the next round, until one group holds them all. Where a round
    does not halve the loose pieces, the next one is the last.
    """
    label = "packing-round"
    # A full piece's sequence is numbered by its key, a bin by a negative number.
    placed = [pieces.where(F.col("length") >= capacity).select("key", F.col("key").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    loose = pieces.where(F.col("length") < capacity).select("key", "length")
    left = loose.count()
    k, closing = 0, False
    while left:
        groups = -(-left // GROUP_PIECES)
        last = closing or groups == 1

        dealt = loose.withColumn("g", F.expr(f"pmod(xxhash64({k}, key), {groups})"))
        # Groups are small but take a while each: by their bytes they would share a task.
        parts = shuffle_partitions(loose.sparkSession)
        dealt = dealt.repartition(min(groups, max(parts, groups // GROUPS_A_TASK)), "g")
        done = stored(
            dealt.groupBy("g").applyInPandas(_group_packer(k, last, capacity), "key long, length long, sequence_id long, offset long, settled boolean"),
            f"{label}-{k}",
        )
        again = done.where("NOT settled").count()
        # Bins that hardly ever fill up: they meet those of other groups once more, and that is all.
        closing = again > left // 2
        if not again:
            placed.append(done.select("key", "sequence_id", "offset"))
            break
        placed.append(done.where("settled").select("key", "sequence_id", "offset"))
        loose, left, k = done.where("NOT settled").select("key", "length"), again, k + 1
    result = placed[0]
    for part in placed[1:]:
        result = result.unionByName(part)
    return result


@dataclass(frozen=True)
class Packed:
    """Written pieces with their ids, and the place of each."""

    pieces: DataFrame
    places: DataFrame

    def rows(self) -> DataFrame:
        """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
        own = self.pieces.select("key", "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
        return own.join(self.places, "key").drop("key")

    def sequences(self) -> DataFrame:
        """One row per sequence: sequence_id, length, ids (binary, pieces by offset), doc_ids.

        A sequence has at most ``CAPACITY`` ids, so gathering its pieces is bounded.
        """
        own = self.pieces.select("key", "doc_id", "length", "ids").join(self.places, "key")
        return own.groupBy("sequence_id").agg(
            F.sum("length").alias("length"),
            F.expr("listagg(ids) WITHIN GROUP (ORDER BY offset) AS ids"),
            F.expr("transform(array_sort(collect_list(struct(offset, doc_id))), x -> x.doc_id) AS doc_ids"),
        )


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> Packed:
    """Packs every row of ``docs`` into sequences of at most ``capacity`` tokens.

    Only ``doc_id`` and ``text`` are read, so other columns may have any name. A null or empty
    text is the end id alone; each repeated row, and each row without a doc_id, is a document
    of its own; documents of more ids than ``capacity`` are cut into pieces of that length,
    the last one shorter. An empty table gives no pieces.
    """
    pieces = tokenised(docs, tokenizer, capacity)
    return Packed(pieces, place(pieces.select("key", "length"), capacity))
