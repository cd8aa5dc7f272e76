"""Scratch tables, whole-text columns and vectorised words for the operators of this package."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairlead.sinks import stored

# Bytes that separate words: space, and the controls from tab to carriage return.
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_LIBC = ctypes.CDLL(None)
WORD_GAP = r"[\x20\x09-\x0D]+"


def lowest(df: DataFrame, hashed: str, limit: int) -> DataFrame:
    """Rows of ``df``, stored, whose ``hashed`` number may be among the ``limit`` lowest.

    All of those and not many more, so that sorting and collecting what is left costs no
    more than the limit asks for, however many partitions there are: a limit by itself takes that
    many rows of each.
    """
    rows = df.count()
    share = 4 * limit / rows if rows else 1.0
    while share < 1:
        bound = df.select(F.percentile_approx(hashed, share, 1_000_000)).first()[0]
        few = df.where(F.col(hashed) <= bound)
        if few.count() >= limit:
            return few
        share *= 4
    return df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of all texts; one number."""
    return docs.agg(F.sum(F.octet_length(column))).first()[0] or 0


def byte_values(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Record batches cut into consecutive slices of about ``limit`` bytes of ``column``.

    A single longer text makes a slice of its own. Workers go on to other tasks: what a batch has
    used is given back to the system when it is done, so that peaks of different stages do not add up.
    """
    for batch in batches:
        sizes = np.array([0 if x is None else x for x in pc.binary_length(batch[column]).to_pylist()])
        start, held = 0, 0
        for row, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)
        del batch
        give_back()


def give_back() -> None:
    """Return memory that is no longer used to the system, where its allocators would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(_LIBC, "malloc_trim", None)
    if trim:
        trim(0)


def word_segments(text: bytes, size: int, overlap: int) -> Iterator[tuple[list[bytes], int]]:
    """Words of a text in segments of about ``size`` bytes, so that memory stays bounded.

    Each segment starts with the last ``overlap`` words seen before it; the second value is
    how many words at its front were repeated so.
    """
    if len(text) <= size:
        yield text.split(), 0
        return
    carried: list[bytes] = []
    at = 0
    while at < len(text):
        end = min(at + size, len(text))
        while end < len(text) and text[end] not in SPACE_BYTES:
            nearest = [x for b in SPACE_BYTES if (x := text.find(b, end, end + 65536)) >= 0]
            end = min(nearest) if nearest else min(end + 65536, len(text))
        words = carried + text[at:end].split()
        yield words, len(carried)
        carried = words[-overlap:] if overlap else []
        at = end


def kept_fields(df: DataFrame, columns: Sequence[str]) -> str:
    """Schema text of columns that a Python stage passes through; a text column is a string."""
    types = {f.name: f.dataType.simpleString() for f in df.select(*columns).schema.fields}
    return ", ".join(f"`{n}` {'string' if n == 'text' else t}" for n, t in types.items())
