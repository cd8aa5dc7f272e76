"""SimHash near-duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairlead.llm.common import byte_values, slices, stored, word_segments
from fairlead.llm.graph import components

BITS = 64
SHINGLE_SEED = 42
# Bytes of text whose words are held as objects at a time.
SEGMENT_BYTES = 2 << 20

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: bytes, shingle: int) -> int:
    """64-bit majority of the XXH64 values of all word shingles; 0 for a text without words."""
    ones, total = np.zeros(BITS, dtype=np.int64), 0
    words: list[bytes] = []

    def vote(grams: list[bytes]) -> None:
        nonlocal total
        hashes = np.fromiter((xxhash.xxh64_intdigest(x, SHINGLE_SEED) for x in grams), np.uint64, len(grams))
        each = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        np.add(ones, each.sum(axis=0, dtype=np.int64), out=ones)
        total += len(grams)

    for words, _ in word_segments(text.translate(_LOWER), SEGMENT_BYTES, shingle - 1):
        if len(words) >= shingle:
            vote([b" ".join(x) for x in zip(*(words[k:] for k in range(shingle)))])
    if not total and words:
        vote([b" ".join(words)])
    bits = np.packbits(2 * ones > total, bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, text_hash, fingerprint long) for every row of ``docs``; a null text has no words."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 4 * SEGMENT_BYTES):
            found = [fingerprint(x, shingle) for x in byte_values(part["text"])]
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], part["text_hash"], pa.array(found, pa.int64())], ["doc_id", "text_hash", "fingerprint"]
            )

    kept = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
        F.col("text").cast("string").alias("text"),
    )
    return kept.mapInArrow(rows, "doc_id long, text_hash long, fingerprint long")


def covering_masks(radius: int) -> list[int]:
    """2^(radius+1) - 1 masks such that any two words within the radius agree on all bits of one.

    Bit i gets the nonzero vector m(i) of radius+1 bits, dealt evenly; mask v holds the bits
    with odd <m(i), v>. At most ``radius`` differing bits span a proper subspace, so some
    nonzero v is orthogonal to all of them, and its mask avoids every differing bit.
    """
    vectors = [1 + i % (2 ** (radius + 1) - 1) for i in range(BITS)]
    return [
        sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2) for v in range(1, 2 ** (radius + 1))
    ]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def links(distinct: DataFrame, radius: int) -> DataFrame:
    """Edges (a, b) that connect exactly the fingerprints within ``radius`` (at most 2) bits.

    ``distinct`` has one row per ``fingerprint``. Each goes into one bucket per covering
    mask; buckets of one fingerprint are dropped. Members of a bucket agree on the masked
    bits, so two of them within the radius differ in the free bits only and share a midpoint
    that flips at most one free bit of either. Every member therefore writes its midpoints,
    at most 1 + 32, and members of one midpoint are linked to the smallest: any two of them
    are within two bits. A midpoint has no more members than free bits plus one, so a bucket
    of any size is neither gathered nor paired.

    The edges are a star for each midpoint: fewer than all links, with the same components.
    """
    if radius not in (1, 2):
        raise ValueError("radius must be 1 or 2")
    masks = covering_masks(radius)
    tables = F.array(
        *[F.struct(F.lit(t).alias("t"), F.col("fingerprint").bitwiseAND(F.lit(_signed(m))).alias("k")) for t, m in enumerate(masks)]
    )
    dealt = distinct.select("fingerprint", F.explode(tables).alias("at")).select("at.t", "at.k", "fingerprint")
    shared = dealt.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("t", "k")
    met = stored(dealt.join(shared, ["t", "k"]), "simhash-buckets")
    free = [[_signed(1 << i) for i in range(BITS) if not m >> i & 1] for m in masks]
    # Radius 1: a pair differs in one free bit, and each is the other's midpoint.
    flips = F.array(*[F.array(F.lit(0), *[F.lit(x) for x in bits]) for bits in free])
    middles = met.select(
        "t", "fingerprint", F.explode(F.get(flips, F.col("t"))).alias("flip")
    ).select("t", F.col("fingerprint").bitwiseXOR(F.col("flip").cast("long")).alias("middle"), "fingerprint")
    if radius == 1:
        # Only midpoints that are fingerprints themselves join a pair within one bit.
        middles = middles.join(distinct.select(F.col("fingerprint").alias("middle")), "middle", "left_semi")
    stars = middles.groupBy("t", "middle").agg(F.collect_set("fingerprint").alias("members")).where("size(members) > 1")
    return stars.select(F.array_min("members").alias("a"), F.explode("members").alias("b")).where("a <> b").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id, component, text_hash.

    Texts are lower-cased in A-Z and split at ASCII white space; ``shingle`` consecutive
    words, repeats included, vote with their XXH64 value (seed 42). A bit is set if more
    than half of the votes have it. Fingerprints within ``radius`` bits link, and
    component_id is the smallest doc_id reachable by links; ``component`` names the
    component also where no id does.

    Only ``doc_id`` and ``text`` are read, so other columns may have any name. A null or
    blank text has fingerprint zero and links like any other; fewer words than a shingle are
    one shingle; repeated rows give repeated result rows; a null doc_id is never the smallest,
    and a component of null ids only has a null component_id; an empty table gives no rows.
    """
    found = stored(fingerprints(docs, shingle), "simhash-fingerprints")
    distinct = stored(found.groupBy("fingerprint").agg(F.min("doc_id").alias("lead")), "simhash-distinct")
    joined = components(links(distinct.select("fingerprint"), radius), "simhash")
    rooted = distinct.join(joined.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").selectExpr(
        "fingerprint", "lead", "ifnull(root, fingerprint) AS root"
    )
    least = rooted.groupBy("root").agg(F.min("lead").alias("component_id"))
    named = rooted.join(least, "root").selectExpr("fingerprint", "component_id", "root AS component")
    return found.join(named, "fingerprint").select(
        "doc_id", _digits("fingerprint"), "component_id", _digits("component"), "text_hash"
    )


def _digits(column: str) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0")).alias(column)


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, that of the smallest doc_id.

    Rows that repeat doc_id and text count as one; a component without any id keeps the row
    whose text has the smallest hash.
    """
    key, text_hash = "_simhash_id", "_simhash_text"
    least = F.lit(-(2**63)).cast("long")
    result = near_duplicates(docs, shingle, radius)
    winners = (
        result.where("doc_id <=> component_id")
        .groupBy("component")
        .agg(F.min(F.struct(F.coalesce("doc_id", least).alias(key), F.col("text_hash").alias(text_hash))).alias("w"))
        .select("w.*")
    )
    marked = docs.withColumns(
        {key: F.coalesce(F.col("doc_id").cast("long"), least), text_hash: F.xxhash64(F.col("text").cast("string"))}
    )
    return marked.join(winners, [key, text_hash], "left_semi").dropDuplicates([key, text_hash]).drop(key, text_hash)
