"""SentencePiece merges with seeded dropout, and their decoding."""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairlead.llm.common import byte_values, kept_fields, slices
from fairlead.llm.words import ragged

DROPOUT = 0.1
CHUNK_BYTES = 2 << 20
# Remembered words and segmentations of a worker, and words that draw at once.
CACHE_WORDS = 1_000_000
BLOCK_WORDS = 1 << 16
# A remembered segmentation goes by word number and one bit for each merge that may be skipped.
MASK_BITS = 42
# A word is merged anew until it has occurred so often; rare ones are not worth their candidates.
LEARN_AT = 12

SPACE = "▁"
# A space sign that stands in the text itself: it never merges and is written as bytes.
_LITERAL = "\0" + SPACE
# No piece holds a line feed, so words end there too.
_WORD = re.compile(rb" +[^ \n]*|\n|[^ \n]+")
_M64 = (1 << 64) - 1
_PLACE, _LENGTH, _MIX = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9
# Longer words are merged one by one; others in tables of so many rows.
FEW_SYMBOLS = 48
GROUP_WORDS = 4096


class PairTable:
    """Rows of 64-bit keys, found with two lookups each.

    Keys fall into small groups, and each group has a shift that sends its keys to slots of their own.
    """

    _A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(len(keys)).bit_length() + 1)
        self._group_bits, self._slots = np.uint64(64 - max(2, bits - 3)), (1 << bits) - 1
        self._shifts = np.zeros(1 << max(2, bits - 3), dtype=np.int64)
        self._keys = np.full(1 << bits, ~np.uint64(0))
        self._rows = np.zeros(1 << bits, dtype=np.int32)
        self._missing = np.int32(len(keys))
        group, spot = self._hashes(keys)
        order = np.argsort(group, kind="stable")
        members = np.split(order, np.flatnonzero(np.diff(group[order])) + 1) if len(keys) else []
        free = bytearray(b"\1") * (1 << bits)
        for rows in sorted(members, key=len, reverse=True):
            spots = spot[rows].tolist()
            shift = 0
            while True:
                slots = {(x + shift * (1 + 2 * (x >> 20))) & self._slots for x in spots}
                if len(slots) == len(spots) and all(free[x] for x in slots):
                    break
                shift += 1
            self._shifts[group[rows[0]]] = shift
            for row, x in zip(rows.tolist(), spots):
                slot = (x + shift * (1 + 2 * (x >> 20))) & self._slots
                free[slot] = 0
                self._keys[slot], self._rows[slot] = keys[row], row

    def _hashes(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        group = ((keys * self._A) >> self._group_bits).astype(np.int64)
        return group, ((keys * self._B) >> np.uint64(24)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The row of each pair; the number of rows for a pair that has none, or a negative part."""
        wanted = (left.astype(np.int64) << 32 | (right.astype(np.int64) & 0xFFFFFFFF)).astype(np.uint64)
        group, spot = self._hashes(wanted)
        slot = (spot + self._shifts[group] * (1 + 2 * (spot >> 20))) & self._slots
        return np.where(self._keys[slot] == wanted, self._rows[slot], self._missing)


class Pieces:
    """The pieces of a merge-type model with byte fallback, without its own encoder."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.costs: dict[str, float] = {}
        self.bytes = [0] * 256
        self.decoded: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.decoded.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                self.decoded.append(b"")
            else:
                self.ids[piece] = i
                self.costs[piece] = -model.get_score(i)
                self.decoded.append(piece.replace(SPACE, " ").encode())
        # Ids of single characters by code point: a space stands for the space sign, and the
        # sign itself and characters without a piece have none.
        self.char_ids = np.full(0x110000, -1, dtype=np.int32)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.char_ids[ord(" " if piece == SPACE else piece)] = i
        self.char_ids[ord(SPACE)] = -1
        self.chars_of = np.zeros(model.get_piece_size(), dtype=np.uint64)
        pairs = []
        for piece, i in self.ids.items():
            self.chars_of[i] = len(piece)
            for k in range(1, len(piece)):
                left, right = self.ids.get(piece[:k]), self.ids.get(piece[k:])
                if left is not None and right is not None:
                    pairs.append((left << 32 | right, i, self.costs[piece]))
        self.beginnings = {piece[:k] for piece in self.ids for k in range(2, len(piece) + 1)}
        pairs.sort()
        keys, pieces, costs = zip(*pairs)
        self.pairs = PairTable(np.array(keys, dtype=np.uint64))
        # One row more for pairs that form no piece.
        self.pair_pieces = np.array([*pieces, 0], dtype=np.int32)
        self.pair_costs = np.array([*costs, np.inf], dtype=np.float64)
        self.pair_chars = self.chars_of[self.pair_pieces]

    def segment(self, words: list[bytes], dropout: float, keys: np.ndarray) -> list[bytes]:
        """Little-endian 32-bit ids of each word with its leading spaces; ``keys`` are 64-bit.

        The agenda of a word holds every adjacent pair that is a piece, the best score first,
        then the leftmost. A pair is skipped if the hash of its key, place and length falls
        below the dropout; other pairs at its place may form when a neighbour changes. Words
        of usual length advance together, one merge each at a time.
        """
        bound = int(dropout * 65536)
        chars, lengths = self._chars(words)
        first = np.cumsum(lengths) - lengths
        few = self._few(chars, first, lengths)
        out: list[bytes] = [b""] * len(words)
        # Words of similar length share a table, so that little of it is padding.
        for group in _alike(few, lengths):
            self._merge_together(group, chars, first, lengths, bound, keys, out)
        others = np.ones(len(words), dtype=bool)
        others[few] = False
        for k in np.flatnonzero(others).tolist():
            out[k] = np.array(self._merge_one(words[k].decode("utf-8", "replace"), bound, int(keys[k])), dtype="<u4").tobytes()
        return out

    def _chars(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all characters, one word after the other, and the number of each word's."""
        joined = b"".join(words)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        points = np.frombuffer(joined, dtype=np.uint8)
        if not joined.isascii():
            try:
                text = joined.decode()
                starts = np.cumsum(lengths) - lengths
                lengths = np.add.reduceat((points & 0xC0) != 0x80, starts, dtype=np.int64)
            except UnicodeDecodeError:
                texts = [w.decode("utf-8", "replace") for w in words]
                text, lengths = "".join(texts), np.array([len(t) for t in texts])
            points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4")
        return self.char_ids[points], lengths

    def _few(self, chars: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Words of usual length whose characters all have ids."""
        return np.flatnonzero((np.minimum.reduceat(chars, first) >= 0) & (lengths <= FEW_SYMBOLS))

    def candidates(self, word: bytes) -> list[tuple[int, int]]:
        """(place, length) of all merges that any segmentation of a word may make."""
        text = word.decode("utf-8", "replace").replace(SPACE, "\0").replace(" ", SPACE)
        n, ids, beginnings, found = len(text), self.ids, self.beginnings, []
        for a in range(n - 1):
            for b in range(a + 2, n + 1):
                part = text[a:b]
                if part not in beginnings:
                    break
                if part in ids:
                    found.append((a, b - a))
        return found

    def _merge_together(self, group, chars, first, lengths, bound, keys, out) -> None:
        """Words side by side in a table: a symbol stays in the column where it begins.

        ``after`` and ``before`` link the symbols that are left; merged ones are -1. A last column
        of -1 ends every word.
        """
        n, width = len(group), int(lengths[group].max())
        column = np.arange(width + 1)
        inside = column < lengths[group][:, None]
        ids = np.where(inside, chars[np.minimum(first[group][:, None] + column, len(chars) - 1)], -1)
        key = keys[group]

        def agenda(left, right, place, key_of):
            found = self.pairs.find(left, right)
            cost = self.pair_costs[found]
            if bound:
                cost[_draws(key_of, place, self.pair_chars[found]) < bound] = np.inf
            return cost, found

        def finish(rows: np.ndarray) -> None:
            table = ids[rows]
            there = table >= 0
            blob = table[there].astype("<u4").tobytes()
            ends = (4 * np.cumsum(there.sum(axis=1))).tolist()
            for k, a, b in zip(group[rows].tolist(), [0, *ends], ends):
                out[k] = blob[a:b]

        cost, found = np.full((n, width + 1), np.inf), np.zeros((n, width + 1), dtype=np.int32)
        cost[:, :-1], found[:, :-1] = agenda(ids[:, :-1], ids[:, 1:], column[:-1], key[:, None])
        after = np.broadcast_to(column + 1, ids.shape).copy()
        before = np.broadcast_to(column - 1, ids.shape).copy()
        while True:
            at = cost.argmin(axis=1)
            going = np.isfinite(cost[np.arange(len(at)), at])
            left = int(going.sum())
            if left <= 0.75 * len(at):
                finish(np.flatnonzero(~going))
                if not left:
                    return
                group, key, ids, cost, found, after, before, at = (
                    x[going] for x in (group, key, ids, cost, found, after, before, at)
                )
                rows = np.arange(left)
            else:
                rows = np.flatnonzero(going)
                at = at[rows]
            gone = after[rows, at]
            onward = after[rows, gone]
            ids[rows, at] = self.pair_pieces[found[rows, at]]
            ids[rows, gone] = -1
            cost[rows, gone] = np.inf
            after[rows, at] = onward
            before[rows, onward] = at
            back = before[rows, at]
            kept = np.flatnonzero(back >= 0)
            r = np.concatenate([rows, rows[kept]])
            a = np.concatenate([at, back[kept]])
            b = np.concatenate([onward, at[kept]])
            cost[r, a], found[r, a] = agenda(ids[r, a], ids[r, b], a, key[r])

    def _merge_one(self, text: str, bound: int, key: int) -> list[int]:
        """The same for one word with a heap and linked symbols, so any length is affordable."""
        spaces = len(text) - len(text.lstrip(" "))
        symbols = [SPACE] * spaces + [_LITERAL if c == SPACE else c for c in text[spaces:]]
        costs, n = self.costs, len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda: list[tuple[float, int, int, str]] = []

        def offer(left: int, right: int) -> None:
            merged = symbols[left] + symbols[right]
            value = costs.get(merged)
            if value is not None and not (bound and _draw(key, left, len(merged)) < bound):
                heapq.heappush(agenda, (value, left, right, merged))

        for k in range(n - 1):
            offer(k, k + 1)
        while agenda:
            _, left, right, merged = heapq.heappop(agenda)
            # Stale if either side has been merged away or has grown since.
            if not symbols[left] or not symbols[right] or after[left] != right or symbols[left] + symbols[right] != merged:
                continue
            symbols[left], symbols[right] = merged, ""
            onward = after[left] = after[right]
            if onward < n:
                before[onward] = left
                offer(left, onward)
            if before[left] >= 0:
                offer(before[left], left)
        out = []
        for symbol in filter(None, symbols):
            known = self.ids.get(symbol)
            if known is None:
                out += [self.bytes[b] for b in (SPACE if symbol == _LITERAL else symbol).encode("utf-8", "replace")]
            else:
                out.append(known)
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """The text that ``ids`` segment, whatever was dropped; the leading space is not part of it."""
        decoded = self.decoded
        return b"".join([decoded[i] for i in ids.tolist()])[1:]


def _alike(few: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    """Groups of words of similar length."""
    groups = np.split(few[np.argsort(lengths[few], kind="stable")], np.arange(GROUP_WORDS, len(few), GROUP_WORDS))
    return [g for g in groups if len(g)]


def _draw(key: int, place: int, length: int) -> int:
    return (((key ^ (place * _PLACE + length * _LENGTH)) * _MIX) & _M64) >> 48


def _draws(key: np.ndarray, place: np.ndarray, length: np.ndarray) -> np.ndarray:
    u = np.uint64
    return ((key ^ (place.astype(u) * u(_PLACE) + length * u(_LENGTH))) * u(_MIX)) >> u(48)


@lru_cache(maxsize=4)
def _pieces(path: str) -> Pieces:
    return Pieces(path)


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes of 64-bit numbers."""
    u = np.uint64
    x = (x ^ (x >> u(30))) * u(_MIX)
    x = (x ^ (x >> u(27))) * u(0x94D049BB133111EB)
    return x ^ (x >> u(31))


class _Numbers(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class Encoder:
    """Draws for every word of every text; remembers the ids by word and skipped merges."""

    def __init__(self, pieces: Pieces, dropout: float, seed: int):
        self.pieces, self.dropout, self.seed = pieces, dropout, seed
        self._clear()

    def _clear(self) -> None:
        self.numbers = _Numbers()
        # Per word: its occurrences, where its candidate merges begin, how many they are (-1: not
        # known yet, -2: too many to remember).
        self.seen, self.salts, self.first, self.merges = array("q"), array("Q"), array("q"), array("q")
        self.known: dict[int, bytes] = {}

    def encode(self, texts: list[bytes], documents: list[int]) -> list[bytes]:
        """Little-endian 32-bit ids of whole texts, drawn by 64-bit ``documents``; an empty one has none."""
        out: list[list[bytes]] = [[] for _ in texts]
        words: list[bytes] = []
        runs: list[tuple[int, int, int, int]] = []

        def flush() -> None:
            owners, drawn_by, positions, counts = zip(*runs)
            found, at = self._block(words, self._keys(drawn_by, positions, counts)), 0
            for owner, n in zip(owners, counts):
                out[owner].append(b"".join(found[at : at + n]))
                at += n
            words.clear()
            runs.clear()

        for k, (text, document) in enumerate(zip(texts, documents)):
            position = 0
            for segment in _segments(text):
                for at in range(0, len(segment), BLOCK_WORDS):
                    some = segment[at : at + BLOCK_WORDS]
                    runs.append((k, document & _M64, position, len(some)))
                    words += some
                    position += len(some)
                    if len(words) >= BLOCK_WORDS:
                        flush()
        if words:
            flush()
        return [b"".join(x) for x in out]

    def _keys(self, documents, positions, counts) -> np.ndarray:
        """One key for each word, by seed, document and position."""
        u, counts = np.uint64, np.array(counts)
        base = _mixed(np.array(documents, dtype=u) ^ u(self.seed * _LENGTH & _M64))
        return _mixed(np.repeat(base, counts) + ragged(np.array(positions), counts).astype(u) * u(_PLACE))

    def _block(self, words: list[bytes], keys: np.ndarray) -> list[bytes]:
        if len(self.numbers) + len(self.known) > CACHE_WORDS:
            self._clear()
        number = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        fresh = len(self.numbers) - len(self.seen)
        for column, value in ((self.seen, 0), (self.first, 0), (self.merges, -1)):
            column.extend([value] * fresh)
        seen = np.frombuffer(self.seen, dtype=np.int64)
        seen += np.bincount(number, minlength=len(seen))
        merges = np.frombuffer(self.merges, dtype=np.int64)
        due, at = np.unique(number, return_index=True)
        for k in at[(merges[due] == -1) & (seen[due] >= LEARN_AT)].tolist():
            self._learn(words[k])
        first = np.frombuffer(self.first, dtype=np.int64)
        many = merges[number] < 0
        wanted = number << MASK_BITS
        bound = int(self.dropout * 65536)
        if bound and len(self.salts):
            counts = np.maximum(merges[number], 0)
            drawn = np.repeat(keys, counts)
            drawn ^= np.frombuffer(self.salts, dtype=np.uint64)[ragged(first[number], counts)]
            drawn *= np.uint64(_MIX)
            skipped = np.flatnonzero(drawn >> np.uint64(48) < bound)
            ends = np.cumsum(counts)
            owner = np.searchsorted(ends, skipped, side="right")
            bit = skipped - (ends - counts)[owner]
            # Sums of different powers of two below 2 ** 53 are exact.
            wanted += np.bincount(owner, np.ldexp(1.0, bit), len(words)).astype(np.int64)
        known = self.known
        listed, at, which = np.unique(wanted[~many], return_index=True, return_inverse=True)
        at = np.flatnonzero(~many)[at]
        ids = list(map(known.get, listed.tolist()))
        new = [k for k, x in enumerate(ids) if x is None]
        some = np.concatenate([at[new], np.flatnonzero(many)])
        merged = self.pieces.segment([words[k] for k in some], self.dropout, keys[some]) if len(some) else []
        known.update(zip(listed[new].tolist(), merged))
        for k, x in zip(new, merged):
            ids[k] = x
        found = np.empty(len(words), dtype=object)
        found[~many] = np.array([*ids, None], dtype=object)[which]
        found[many] = np.array([*merged[len(new) :], None], dtype=object)[:-1]
        return found.tolist()

    def _learn(self, word: bytes) -> None:
        number = self.numbers[word]
        found = self.pieces.candidates(word) if len(word) <= 4 * FEW_SYMBOLS else None
        if found is None or len(found) > MASK_BITS:
            self.merges[number] = -2
            return
        self.first[number], self.merges[number] = len(self.salts), len(found)
        self.salts.extend([(place * _PLACE + length * _LENGTH) & _M64 for place, length in found])


def _segments(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text with their leading spaces; a space is put before the first."""
    if not text:
        return
    spaced, at = b" " + text, 0
    while at < len(spaced):
        # Segments begin at the first of a run of spaces.
        cut = spaced.find(b" ", at + CHUNK_BYTES)
        while 0 < cut and spaced[cut - 1] == 0x20:
            cut = spaced.find(b" ", cut + 1)
        end = cut if cut > 0 else len(spaced)
        yield _WORD.findall(spaced[at:end])
        at = end


def encode(
    docs: DataFrame, model: str, dropout: float = DROPOUT, seed: int = 1, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The ``keep`` columns of every row of ``docs`` and ``ids``: little-endian 32-bit piece ids.

    Each candidate merge is skipped with probability ``dropout`` by a hash of the seed, the
    doc_id and text, the position of the word and the candidate, so a seed gives the same ids
    anywhere and another seed others. Without dropout the ids are those
    of the library's own encoder.

    Whole texts are encoded; a null or empty text has no ids; characters without a piece, and
    space signs of the text itself, are written as bytes. Repeated rows get equal ids.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(_pieces(model), dropout, seed)
        for part in slices(batches, "_piece_text", CHUNK_BYTES):
            found = encoder.encode(byte_values(part["_piece_text"]), part["_piece_document"].to_pylist())
            kept = [part["_piece_text" if n == "text" else n] for n in keep]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.binary())], [*keep, "ids"])

    return _drawn(docs, keep).mapInArrow(rows, f"{kept_fields(docs, keep)}, ids binary")


def _drawn(docs: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """What the encoder needs: the text, and the number that the draws of a document start from."""
    return docs.select(
        *[n for n in keep if n != "text"],
        F.col("text").cast("string").alias("_piece_text"),
        F.xxhash64("doc_id", F.col("text").cast("string")).alias("_piece_document"),
    )


def decode(encoded: DataFrame, model: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and ``decoded``: the text of ``ids``, exactly as it was encoded."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(model)
        for part in slices(batches, "_piece_ids", CHUNK_BYTES):
            texts = [
                pieces.decode(np.frombuffer(x or b"", dtype="<u4")).decode("utf-8", "replace")
                for x in part["_piece_ids"].to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*[part[n] for n in keep], pa.array(texts, pa.string())], [*keep, "decoded"])

    given = encoded.select(*keep, F.col("ids").alias("_piece_ids"))
    return given.mapInArrow(rows, f"{kept_fields(encoded, keep)}, decoded string")


def round_trip(
    docs: DataFrame, model: str, dropout: float = DROPOUT, seed: int = 1, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The ``keep`` columns, ``ids`` as ``encode`` gives them, and ``decoded``: their text, read back from the ids."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(model)
        encoder = Encoder(pieces, dropout, seed)
        for part in slices(batches, "_piece_text", CHUNK_BYTES):
            found = encoder.encode(byte_values(part["_piece_text"]), part["_piece_document"].to_pylist())
            texts = [pieces.decode(np.frombuffer(x, dtype="<u4")).decode("utf-8", "replace") for x in found]
            kept = [part["_piece_text" if n == "text" else n] for n in keep]
            columns = [*kept, pa.array(found, pa.binary()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "ids", "decoded"])

    return _drawn(docs, keep).mapInArrow(rows, f"{kept_fields(docs, keep)}, ids binary, decoded string")


def digest(docs: DataFrame, model: str, dropout: float = DROPOUT, seed: int = 1) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_ids, ids_crc32, decoded_sha256, lossless."""
    both = round_trip(docs.select("doc_id", "text"), model, dropout, seed, keep=("doc_id", "text"))
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_ids"),
        F.crc32("ids").alias("ids_crc32"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"),
    )
