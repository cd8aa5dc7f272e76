"""SimHash fingerprints of documents, and all fingerprints within a Hamming radius. Spark functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairlead.llm.common import WORD_GAP, shuffle_partitions, stored

# Two 64-bit hashes of each term vote on one bit each.
BITS = 128
TERM_WORDS = 3
RADIUS = 3
# Terms of a text that one packed counter takes; 16-bit lanes hold twice as many.
CHUNK_TERMS = 30_000
# Rows of one range partition when documents are put in order.
ORDER_ROWS = 1_000_000

_LANES_16 = 0x0001000100010001
_PAIR_32 = 0x0000FFFF0000FFFF
_LOW_32 = 0xFFFFFFFF
_KEY = ("doc_key", "text_hash")


def votes(texts: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """(key, high, low): the 128-bit fingerprint of each row's ``text``; ``key`` is unique.

    Terms are ``TERM_WORDS`` consecutive words; each occurrence votes, so a term weighs its
    frequency. A bit is set if more than half of the votes have it. Texts without words have
    no row.

    Four counters share one long: the k-th sum adds bits k, k+16, k+32 and k+48 of a hash in
    lanes of 16 bits. A text's terms are counted in chunks that cannot overflow a lane, and
    chunks are added in lanes of 32 bits. Votes are combined before the shuffle, so a row of
    counters per text is all that moves, however long the text.
    """
    words = F.array_remove(F.split(F.col("text"), WORD_GAP), "")
    shifted = [F.slice("words", 1 + k, F.size("words")) for k in range(TERM_WORDS)]
    names = [f"w{k}" for k in range(TERM_WORDS)]
    zipped = F.arrays_zip(*[c.alias(n) for c, n in zip(shifted, names)])
    terms = F.slice(zipped, 1, F.greatest(F.lit(1), F.size("words") - (TERM_WORDS - 1)))
    exploded = (
        texts.select(*key, words.alias("words"))
        .select(*key, F.posexplode(terms).alias("at", "term"))
        .select(
            *key,
            F.expr(f"at div {CHUNK_TERMS}").alias("chunk"),
            F.xxhash64(*[F.col("term")[f"w{k}"] for k in range(TERM_WORDS)]).alias("h0"),
        )
        .withColumn("h1", F.xxhash64("h0", F.lit(1)))
    )

    def lane_sum(h: str, k: int) -> Column:
        return F.sum(F.shiftrightunsigned(h, k).bitwiseAND(F.lit(_LANES_16)))

    counted = exploded.groupBy(*key, "chunk").agg(
        F.count(F.lit(1)).alias("n"),
        *[lane_sum(f"h{h}", k).alias(f"s{h}_{k}") for h in (0, 1) for k in range(16)],
    )
    # Lanes 0 and 2 of a sum, then lanes 1 and 3, each with room for 32 bits.
    wide = counted.groupBy(*key).agg(
        F.sum("n").alias("n"),
        *[
            F.sum(F.shiftrightunsigned(f"s{h}_{k}", 16 * odd).bitwiseAND(F.lit(_PAIR_32))).alias(f"t{h}_{k}_{odd}")
            for h in (0, 1)
            for k in range(16)
            for odd in (0, 1)
        ],
    )

    def word(h: int) -> Column:
        value = F.lit(0).cast("long")
        for k in range(16):
            for odd in (0, 1):
                for upper in (0, 1):
                    ones = F.shiftrightunsigned(f"t{h}_{k}_{odd}", 32 * upper).bitwiseAND(F.lit(_LOW_32))
                    bit = k + 16 * odd + 32 * upper
                    value = value.bitwiseOR(F.shiftleft((2 * ones > F.col("n")).cast("long"), bit))
        return value

    return wide.select(*key, word(0).alias("high"), word(1).alias("low"))


def in_order(rows: DataFrame, key: tuple[str, ...], carry: tuple[str, ...]) -> DataFrame:
    """Distinct ``rows`` with ``next``: the key and carried columns of the following row.

    The row after the last is the first. Rows are range-partitioned by key; a partition
    looks up its own successors, and only the first row of each partition is compared
    across partitions.
    """
    listed = stored(rows.select(*key, *carry).distinct(), "order-rows")
    parts = max(shuffle_partitions(rows.sparkSession), listed.count() // ORDER_ROWS)
    ranged = stored(
        listed.repartitionByRange(parts, *key).withColumn("part", F.spark_partition_id()), "order-ranges"
    )
    row = F.struct(*key, *carry)
    firsts = ranged.groupBy("part").agg(F.min(row).alias("first"))
    # One row per partition: bounded by the number of partitions, not of rows.
    following = firsts.select(
        "part", F.lead("first").over(Window.orderBy("part")).alias("then"), F.min("first").over(Window.partitionBy()).alias("again")
    ).select("part", F.coalesce("then", "again").alias("then"))
    inside = ranged.withColumn("inside", F.lead(row).over(Window.partitionBy("part").orderBy(*key)))
    return inside.join(following, "part").select(*key, *carry, F.coalesce("inside", "then").alias("next"))


def likeness(high: str, low: str, other_high: str, other_low: str) -> Column:
    """Share of equal bits."""
    return 1 - _distance(high, low, other_high, other_low) / F.lit(float(BITS))


def _distance(high: str, low: str, other_high: str, other_low: str) -> Column:
    return F.bit_count(F.col(high).bitwiseXOR(F.col(other_high))) + F.bit_count(F.col(low).bitwiseXOR(F.col(other_low)))


def _blocks(radius: int) -> list[Column]:
    """The leading block of each permuted table; one more block than bits may differ."""
    if not 1 <= radius <= 7:
        raise ValueError("radius must be 1 to 7")
    half = -(-(radius + 1) // 2)
    width = 64 // half
    cuts = [(width * k, 64 if k == half - 1 else width * (k + 1)) for k in range(half)]
    out = []
    for column in ("high", "low"):
        for a, b in cuts:
            mask = (1 << (b - a)) - 1
            shifted = F.shiftrightunsigned(column, a)
            out.append(shifted if b - a == 64 else shifted.bitwiseAND(F.lit(mask)))
    return out


def within(queries: DataFrame, all_rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(high, low, other_high, other_low, distance): every pair of fingerprints within ``radius`` bits.

    Both inputs have distinct (high, low). Each fingerprint stands in one table per block,
    permuted so that the block leads; two within the radius agree in some block, as there
    are more blocks than bits to differ. A pair that meets in several tables is kept in the
    first one only.
    """
    blocks = _blocks(radius)
    table = F.posexplode(F.array(*blocks)).alias("t", "lead")
    left = queries.select("high", "low", table)
    right = all_rows.select(F.col("high"), F.col("low"), table).withColumnsRenamed({"high": "other_high", "low": "other_low"})
    met = left.join(right, ["t", "lead"]).withColumn("distance", _distance("high", "low", "other_high", "other_low"))
    own = F.array(*blocks)
    renamed = met.withColumn("own", own).withColumnsRenamed(
        {"high": "h", "low": "l", "other_high": "high", "other_low": "low"}
    ).withColumn("others", own)
    earlier = F.expr("exists(sequence(0, t), k -> k < t AND own[k] = others[k])")
    return renamed.where((F.col("distance") <= radius) & ~earlier).select(
        F.col("h").alias("high"), F.col("l").alias("low"), F.col("high").alias("other_high"), F.col("low").alias("other_low"), "distance"
    )


def fingerprint_documents(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs``: its fingerprint, that of its edited text, and how alike they are.

    Columns: doc_id, n_chars (code points), edited_sha256, fingerprint, edited_fingerprint
    (32 hex digits), near_edited, near_next (share of equal bits), n_near: for doc_ids
    divisible by 100, the number of other rows whose fingerprint is within ``radius`` bits;
    null for others.

    The edited text replaces the last floor(n_chars / 2) code points by the first as many,
    or all, of the next document in ascending doc_id; the first follows the last.

    Only ``doc_id`` and ``text`` are read, so other columns may have any name. A null text is
    empty; a text without words has fingerprint zero. Null ids come first; different texts
    under one id are ordered by a hash of the text; rows that repeat both are one document
    with equal result rows. A table of one document follows itself. An empty table gives no
    rows.
    """
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("doc_key"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("text_hash", F.xxhash64("text"))
    listed = keyed.select(*_KEY, F.char_length("text").cast("long").alias("n_chars"))
    order = stored(in_order(listed, _KEY, ("n_chars",)), "fingerprint-order")

    # Each text is shuffled by its key once, and half of one at most travels on to the document
    # before; everything below shares these two exchanges.
    unique = keyed.select(*_KEY, "text")
    if order.count() < keyed.count():
        unique = unique.dropDuplicates(list(_KEY))
    sent = order.select(
        F.col("next.doc_key").alias("doc_key"),
        F.col("next.text_hash").alias("text_hash"),
        F.col("doc_key").alias("to_key"),
        F.col("text_hash").alias("to_hash"),
        F.expr("int(n_chars div 2)").alias("need"),
    )
    heads = unique.join(sent, list(_KEY)).select(
        F.col("to_key").alias("doc_key"), F.col("to_hash").alias("text_hash"), "need", F.expr("left(text, need)").alias("head")
    )
    edited = F.concat(F.expr("left(text, char_length(text) - need)"), F.col("head"))
    both = unique.join(heads, list(_KEY)).select(*_KEY, edited.alias("text"))
    shas = both.select(*_KEY, F.sha2("text", 256).alias("edited_sha256"))
    edited_votes = votes(both, _KEY).withColumnsRenamed({"high": "edited_high", "low": "edited_low"})
    prints = (
        order.join(shas, list(_KEY))
        .join(votes(unique, _KEY), list(_KEY), "left")
        .join(edited_votes, list(_KEY), "left")
        .fillna(0, ["high", "low", "edited_high", "edited_low"])
    )
    return _assembled(keyed, stored(prints, "fingerprint-pairs"), radius)


def _assembled(keyed: DataFrame, prints: DataFrame, radius: int) -> DataFrame:
    zero = F.lit(0).cast("long")
    after = prints.select(
        F.col("doc_key").alias("next_key"), F.col("text_hash").alias("next_hash"), F.col("high").alias("next_high"), F.col("low").alias("next_low")
    )
    whole = prints.withColumns({"next_key": F.col("next.doc_key"), "next_hash": F.col("next.text_hash")}).join(
        after, ["next_key", "next_hash"]
    )
    rows = keyed.select("doc_id", *_KEY)
    counted = rows.join(prints.select(*_KEY, "high", "low"), list(_KEY)).groupBy("high", "low").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(F.expr("doc_id % 100 = 0")).alias("asked")
    )
    counted = stored(counted, "fingerprint-classes")
    pairs = within(counted.where("asked"), counted, radius)
    sizes = counted.select(F.col("high").alias("other_high"), F.col("low").alias("other_low"), "n_rows")
    near = pairs.join(sizes, ["other_high", "other_low"]).groupBy("high", "low").agg(F.sum("n_rows").alias("n_near"))

    def digits(high: str, low: str) -> Column:
        return F.lower(F.concat(F.lpad(F.hex(high), 16, "0"), F.lpad(F.hex(low), 16, "0")))

    return (
        rows.join(whole, list(_KEY))
        .join(near, ["high", "low"], "left")
        .select(
            "doc_id",
            "n_chars",
            "edited_sha256",
            digits("high", "low").alias("fingerprint"),
            digits("edited_high", "edited_low").alias("edited_fingerprint"),
            likeness("high", "low", "edited_high", "edited_low").alias("near_edited"),
            likeness("high", "low", "next_high", "next_low").alias("near_next"),
            F.when(F.expr("doc_id % 100 = 0"), F.coalesce(F.col("n_near") - 1, zero)).alias("n_near"),
        )
    )
