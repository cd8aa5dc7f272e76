"""Secret scans: fixed patterns, and formats learned from the credentials they find."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fairlead.llm.automata import infer, likelihood
from fairlead.llm.common import byte_values, kept_fields, lowest, slices, stored

# Bounds of the samples the automata are inferred from: distinct values a kind, and of other
# words, and the bytes of each sample.
SAMPLE_VALUES = 1000
SAMPLE_WORDS = 4000
SAMPLE_BYTES = 16 << 20
# Held-out values below which their worst hundredth is reckoned from their spread.
FEW_VALUES = 100
# One value to infer a format from, one to set its bounds.
LEAST_VALUES = 2
# About 3.4 standard deviations above the median, were the ratios of words normal.
WORD_SPREADS = 5.0
CHUNK_BYTES = 4 << 20
REPLACEMENT = "[SECRET]"

# Kinds in their order, patterns and least lengths.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}

_KEYWORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key")
# Runs that can hold a match; equal to the pattern with its least length, as runs are maximal.
_LONG_HEX = re.compile(rb"[0-9a-f]{16,}")
_CANDIDATE = re.compile(rb"[A-Za-z0-9+/_.=-]{12,}")

Span = tuple[int, int, int, int]  # start, kind, end, start of the credential itself


def base_spans(text: bytes) -> list[Span]:
    """Byte spans of the fixed patterns, by start, then kind; group 2 is the span of an assignment."""
    found: list[Span] = []
    low = text.lower()
    if any(word in low for word in _KEYWORDS):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= LEAST["assign"]:
                found.append((m.start(), 0, m.end(), m.start(2)))
    if b"AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= LEAST["access"]:
                found.append((m.start(), 1, m.end(), m.start()))
    found += [(m.start(), 2, m.end(), m.start()) for m in _LONG_HEX.finditer(text)]
    return sorted(found)


def _outside(text: bytes, spans: list[Span]) -> Iterator[re.Match]:
    """Candidates that touch no base span."""
    k, reach = 0, 0
    for m in _CANDIDATE.finditer(text):
        while k < len(spans) and spans[k][0] < m.end():
            reach = max(reach, spans[k][2])
            k += 1
        if reach <= m.start():
            yield m


def _beyond(text: bytes, spans: list[Span]) -> Iterator[re.Match]:
    """Candidates that base spans do not cover whole."""
    joined: list[list[int]] = []
    for start, _, end, _ in spans:
        if joined and start <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], end)
        else:
            joined.append([start, end])
    k = 0
    for m in _CANDIDATE.finditer(text):
        while k < len(joined) and joined[k][1] < m.end():
            k += 1
        if k == len(joined) or joined[k][0] > m.start():
            yield m


@dataclass
class Formats:
    """Automata of the kinds and of ordinary words, and what a credential of a kind must reach."""

    kinds: dict[int, list[dict]] = field(default_factory=dict)
    words: list[dict] = field(default_factory=list)
    least: dict[int, float] = field(default_factory=dict)
    unseen: dict[int, float] = field(default_factory=dict)

    def fit(self, kind: int, value: bytes) -> tuple[float, float]:
        """(log likelihood ratio to ordinary words per character, share of unseen characters)."""
        own, unseen = likelihood(self.kinds[kind], value)
        return own - likelihood(self.words, value)[0], unseen

    def kind_of(self, value: bytes) -> int:
        """The kind whose format fits best and well enough; -1 for none."""
        best, chosen = 0.0, -1
        for kind in self.kinds:
            ratio, unseen = self.fit(kind, value)
            if unseen <= self.unseen[kind] and ratio - self.least[kind] > best:
                best, chosen = ratio - self.least[kind], kind
        return chosen


def learn(credentials: dict[int, list[bytes]], words: list[bytes]) -> Formats:
    """Automata from labelled credentials, and bounds that ordinary words hardly reach.

    Every second value is kept from the inference and sets the bounds: a candidate must
    have no larger share of unseen characters than all but a hundredth of the credentials,
    and a likelihood ratio above that of the worst hundredth of the credentials and above
    ``WORD_SPREADS`` times the median's distance to the lower quartile over the median of the
    words; with fewer than ``FEW_VALUES`` values kept, the first two are reckoned from the spread of those. The words are unlabelled, so credentials may be among them: neither quartile nor
    median lets a few of those set the bound. Words found to be credentials are left out of a
    second inference. A kind with fewer than ``LEAST_VALUES`` values gets no automaton.
    """
    formats = _fitted(credentials, words)
    plain = formats.kinds and [x for x in words if formats.kind_of(x) < 0]
    return _fitted(credentials, plain) if plain and len(plain) < len(words) else formats


def _fitted(credentials: dict[int, list[bytes]], words: list[bytes]) -> Formats:
    formats = Formats()
    if not words:
        return formats
    formats.words = infer(words[::2]).tables()
    for kind, values in credentials.items():
        if len(values) < LEAST_VALUES:
            continue
        formats.kinds[kind] = infer(values[::2]).tables()
        own, unseen = np.array([formats.fit(kind, x) for x in values[1::2]]).T
        low, middle = np.quantile([formats.fit(kind, x)[0] for x in words], [0.25, 0.5])
        other = float(middle + WORD_SPREADS * (middle - low))
        # Just below the quantile: with few values it is the least one, which must pass itself.
        worst, most = float(np.quantile(own, 0.01)) - 1e-9, float(np.quantile(unseen, 0.99))
        if len(own) < FEW_VALUES:
            # The worst of a few is not the worst hundredth: reckon with the spread, and one character more.
            worst = min(worst, float(np.median(own) - WORD_SPREADS * (np.median(own) - np.quantile(own, 0.25))))
            most += 1.5 / min(map(len, values))
        formats.least[kind] = max(worst, other, 0.0)
        formats.unseen[kind] = most
    return formats


def train(
    docs: DataFrame,
    sample_values: int = SAMPLE_VALUES,
    sample_words: int = SAMPLE_WORDS,
    sample_bytes: int = SAMPLE_BYTES,
) -> Formats:
    """Learns the formats of ``docs``: its base matches are the labelled credentials.

    Each kind takes its ``sample_values`` distinct values of smallest hash, ordinary words
    likewise, so the sample does not depend on the order of rows. Whole texts are read and whole
    values taken: in that order, until ``sample_bytes`` are reached. A value longer than that is no
    part of the sample; it is scored like any other.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task sends no more than the smallest hashes it has met: they hold the smallest of all.
        held: dict[tuple[int, bytes], int] = {}
        for part in slices(batches, "text", CHUNK_BYTES):
            for text in byte_values(part["text"]):
                spans = base_spans(text)
                for _, kind, end, start in spans:
                    held.setdefault((kind, text[start:end]), 0)
                for m in _outside(text, spans):
                    held.setdefault((len(KINDS), m.group()), 0)
            held = _smallest(held, sample_values, sample_words, sample_bytes)
        kinds, values = [k for k, _ in held], [v for _, v in held]
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(values, pa.binary())], ["kind", "value"])

    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(rows, "kind int, value binary")
    distinct = stored(found.select("kind", "value", F.xxhash64("value").alias("h")).distinct(), "secret-values")
    # Over a sample, which is small: one task may sort it.
    by_hash = Window.orderBy("h", "value").rowsBetween(Window.unboundedPreceding, 0)
    taken = []
    for kind in range(len(KINDS) + 1):
        limit = sample_words if kind == len(KINDS) else sample_values
        few = lowest(distinct.where(F.col("kind") == kind), "h", limit).orderBy("h", "value").limit(limit)
        sizes = few.select("h", "value", F.sum(F.length("value")).over(by_hash).alias("bytes"))
        chosen = sizes.where(F.col("bytes") <= sample_bytes).orderBy("h", "value").select("value").collect()
        taken.append([bytes(r.value) for r in chosen])
    return learn({k: taken[k] for k in range(len(KINDS))}, taken[len(KINDS)])


def _smallest(
    held: dict[tuple[int, bytes], int], sample_values: int, sample_words: int, sample_bytes: int
) -> dict[tuple[int, bytes], int]:
    """Of each kind what the sample may take, by hash; hashes are kept once worked out."""
    out: dict[tuple[int, bytes], int] = {}
    for kind in range(len(KINDS) + 1):
        limit = sample_words if kind == len(KINDS) else sample_values
        mine = sorted((h or xxhash_of(v), v) for (k, v), h in held.items() if k == kind and len(v) <= sample_bytes)
        room = sample_bytes
        for h, value in mine[:limit]:
            room -= len(value)
            if room < 0:
                break
            out[kind, value] = h
    return out


def xxhash_of(value: bytes) -> int:
    """Spark's xxhash64 of a binary value, signed."""
    h = xxhash.xxh64_intdigest(value, 42)
    return h - (1 << 64) if h >> 63 else h


class Scanner:
    """Finds base spans and candidates of a learned format in whole texts."""

    def __init__(self, formats: Formats):
        self.formats = formats
        self.known: dict[bytes, int] = {}

    def spans(self, text: bytes) -> tuple[list[Span], list[Span]]:
        """(base spans, added spans), in bytes."""
        base = base_spans(text)
        if not self.formats.kinds:
            return base, []
        added = []
        for m in _beyond(text, base):
            value = m.group()
            kind = self.known.get(value)
            if kind is None:
                if len(self.known) > 200_000:
                    self.known.clear()
                kind = self.formats.kind_of(value)
                if len(value) <= 256:
                    self.known[value] = kind
            if kind >= 0:
                added.append((m.start(), kind, m.end(), m.start()))
        return base, added


def _points(text: bytes, offsets: list[int]) -> list[int]:
    """Byte offsets as code point offsets."""
    starts = (np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80
    before = np.concatenate([[0], np.cumsum(starts)])
    return before[offsets].tolist()


def _redacted(text: bytes, spans: list[Span]) -> bytes:
    out, at = [], 0
    for start, _, end, credential in sorted(spans, key=lambda s: s[3]):
        if credential >= at:
            out += [text[at:credential], REPLACEMENT.encode()]
        at = max(at, end)
    return b"".join([*out, text[at:]])


SPANS = "array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"


def scan(docs: DataFrame, formats: Formats, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns of every row of ``docs``, its ``spans`` and its ``redacted`` text.

    Spans are (kind, start, end, base), code points, end exclusive, by start, then kind in
    the order assign, access, hex; ``base`` tells the fixed patterns from learned formats.
    An assignment spans from its keyword, but only its value is redacted.

    A null or empty text has no spans; repeated rows give equal rows.
    """
    span_type = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(formats)
        for part in slices(batches, "_scanned_text", CHUNK_BYTES):
            all_spans, texts = [], []
            for text in byte_values(part["_scanned_text"]):
                base, added = scanner.spans(text)
                if not base and not added:
                    all_spans.append([])
                    texts.append(text.decode("utf-8", "replace"))
                    continue
                flagged = sorted([(*s, True) for s in base] + [(*s, False) for s in added])
                starts = _points(text, [s[0] for s in flagged])
                ends = _points(text, [s[2] for s in flagged])
                all_spans.append(
                    [{"kind": KINDS[s[1]], "start": a, "end": b, "base": s[4]} for s, a, b in zip(flagged, starts, ends)]
                )
                texts.append(_redacted(text, base + added).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [*[part["_scanned_text" if n == "text" else n] for n in keep], pa.array(all_spans, span_type), pa.array(texts, pa.string())],
                [*keep, "spans", "redacted"],
            )

    given = docs.select(*[n for n in keep if n != "text"], F.col("text").cast("string").alias("_scanned_text"))
    return given.mapInArrow(rows, f"{kept_fields(docs, keep)}, spans {SPANS}, redacted string")


def digest(scanned: DataFrame) -> DataFrame:
    """doc_id, counts of base matches by kind, base_sha256 and spans, of ``scan``."""

    def joined(which: str) -> str:
        return f"array_join(transform({which}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"

    base = "filter(spans, s -> s.base)"
    return scanned.selectExpr(
        "doc_id",
        *[f"bigint(size(filter(spans, s -> s.base AND s.kind = '{kind}'))) AS n_{kind}" for kind in KINDS],
        f"sha2({joined(base)}, 256) AS base_sha256",
        f"{joined('spans')} AS spans",
    )
