"""How far the sources of a language differ in their words: exact divergences over a cube of cells."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairlead.llm.common import stored

# A term counts in a language if this many of its documents hold it.
MIN_DOCS = 10
# Probabilities are integers: parts of this whole.
WHOLE = 1_000_000_000
TOP_TERMS = 10
# Groups and terms of one block, on average: a cell holds two slices of at most this many cells.
GROUP_BLOCK = 48
TERM_BLOCK = 4096
# Entries of the counters that a task holds before it hands them on.
HELD_TERMS = 500_000
# Bytes of a text that are cut into words at a time.
SEGMENT_BYTES = 4 << 20

# Terms are runs of ASCII letters and of code points beyond ASCII: every other byte separates.
_FOLDED = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
_COUNTS = "lang string, source string, term string, n long, docs long"
_PART = "lang string, a string, b string, partial long, met long, rest long, terms long"
_PART_SCHEMA = pa.schema([(n, pa.string() if t == "string" else pa.int64()) for n, t in map(str.split, _PART.split(", "))])


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term in each group, and documents with it.

    Tasks count what they read and hand on their counters when those are full, so a source with a
    third of all documents is added up before anything moves. Every row of ``docs`` is a document.
    """
    named = docs.select(*[F.ifnull(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    partial = named.mapInArrow(_counter(HELD_TERMS, SEGMENT_BYTES), _COUNTS)
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def probability(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(WHOLE * (count + 2) / (total + 2 * terms)), exact: products are decimals."""
    share = F.lit(WHOLE).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)")
    return F.call_function("div", share, (total + 2 * terms).cast("decimal(20,0)")).cast("long") + 1


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: how far sources lie apart, and by which terms.

    ``pair`` rows give, for every two sources of a language, the sum over all kept terms of
    (p - q)^2 / (p + q), floored per term; both directions, every rank. ``term`` rows give for
    each source the ``top_terms`` kept terms that it uses more than its language, by the same
    measure. Ranks go by value descending, then item.

    Group and term axes are cut into blocks by hash. A slice, the probabilities of one group
    block on one term block, is copied to every cell (group block, group block, term block) that needs it;
    a cell works out its part for all its pairs on its own, and the parts are added along the
    term axis. A cell holds two slices of bounded size, whatever the number of sources, terms
    or documents. Terms that neither block of a cell uses are alike for a pair
    and enter as a number of terms, so slices hold used terms only.

    Null text, lang and source are empty strings. Groups without any term take part with no
    counts; a language without kept terms has pairs of value 0. A language with one source has
    no pairs. Rows that repeat count each time. An empty table gives no rows.
    """
    counts = stored(term_counts(docs), "divergence-counts")
    vocabulary = stored(
        counts.groupBy("lang", "term")
        .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= min_docs)
        .select("lang", "term", "lang_n", F.monotonically_increasing_id().alias("term_id")),
        "divergence-terms",
    )
    langs = vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    names = docs.select(*[F.ifnull(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    kept = counts.drop("docs").join(vocabulary, ["lang", "term"])
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = names.groupBy("lang").agg(F.count(F.lit(1)).alias("groups"))
    groups = stored(
        names.join(sizes, "lang")
        .join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .select(
            "lang",
            "source",
            F.ifnull("total", F.lit(0)).alias("total"),
            F.ifnull("terms", F.lit(0)).alias("terms"),
            F.ifnull("lang_total", F.lit(0)).alias("lang_total"),
            F.expr(f"(groups + {GROUP_BLOCK - 1}) div {GROUP_BLOCK}").alias("group_blocks"),
            F.expr(f"greatest(1, (ifnull(terms, 0) + {TERM_BLOCK - 1}) div {TERM_BLOCK})").alias("term_blocks"),
        )
        .withColumn("group_block", F.expr("pmod(xxhash64(source), group_blocks)")),
        "divergence-groups",
    )
    per_term = stored(
        kept.join(groups.drop("group_blocks"), ["lang", "source"]).select(
            "lang",
            "source",
            "term",
            "term_id",
            "group_block",
            F.expr("pmod(xxhash64(term), term_blocks)").alias("term_block"),
            probability(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
            probability(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"),
        ),
        "divergence-probabilities",
    )
    pairs = _pairs(groups, per_term)
    terms = per_term.where("p > q").selectExpr(
        "lang", "source", "'term' AS part", "term AS item", "(p - q) * (p - q) div (p + q) AS value"
    )
    rank = "int(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)) AS rank"
    # Tasks keep their best terms of a group before they meet.
    best = terms.selectExpr("*", rank).where(F.col("rank") <= top_terms)
    return pairs.selectExpr("*", rank).unionByName(best)


def _pairs(groups: DataFrame, per_term: DataFrame) -> DataFrame:
    """Both directions of every pair of groups with the sum over all kept terms."""
    empty = probability(F.lit(0), F.col("total"), F.when(F.col("terms") > 0, F.col("terms")))
    blocks = groups.groupBy("lang", "group_block", "group_blocks", "term_blocks", "terms").agg(
        # GROUP_BLOCK on average, by hash.
        F.collect_list(F.struct("source", F.ifnull(empty, F.lit(1)).alias("p"))).alias("members")
    )
    used = per_term.groupBy("lang", "group_block", "term_block").agg(
        F.collect_list(F.struct("source", "term_id", "p")).alias("entries")
    )
    slices = blocks.select("*", F.explode(F.expr("sequence(0, term_blocks - 1)")).alias("term_block")).join(
        used, ["lang", "group_block", "term_block"], "left"
    )
    replicas = slices.select(
        "lang",
        "terms",
        "term_block",
        "group_block",
        "members",
        "entries",
        F.explode(F.expr("sequence(0, group_blocks - 1)")).alias("other"),
    ).selectExpr("*", "least(group_block, other) AS row", "greatest(group_block, other) AS column")
    cells = replicas.groupBy("lang", "row", "column", "term_block").applyInArrow(_cell, _PART)
    # ``rest`` is what a term that neither group uses adds: as many as no cell has met.
    added = cells.groupBy("lang", "a", "b").agg(
        F.expr("sum(partial) + (max(terms) - sum(met)) * max(rest) AS value")
    )
    both = added.select(
        "lang",
        "value",
        F.explode(F.expr("array(struct(a AS source, b AS item), struct(b AS source, a AS item))")).alias("pair"),
    )
    return both.selectExpr("lang", "pair.source AS source", "'pair' AS part", "pair.item AS item", "value")


def _counter(held: int, segment: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts terms per group; hands its counters on whenever they hold ``held`` entries."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        entries = 0
        for batch in batches:
            texts = batch["text"].cast(pa.large_binary())
            langs, sources = batch["lang"].to_pylist(), batch["source"].to_pylist()
            for i in range(batch.num_rows):
                found, docs = groups.setdefault((langs[i], sources[i]), (Counter(), Counter()))
                before = len(found)
                distinct: set[bytes] = set()
                for words in _segments(texts[i].as_py(), segment):
                    found.update(words)
                    distinct.update(words)
                docs.update(distinct)
                entries += len(found) - before
                if entries >= held:
                    yield from _handed_on(groups)
                    groups, entries = {}, 0
        yield from _handed_on(groups)

    return count


def _segments(text: bytes, size: int) -> Iterator[list[bytes]]:
    """The terms of a text, in lower case, a segment of about ``size`` bytes at a time."""
    if len(text) <= size:
        yield text.translate(_FOLDED).split()
        return
    rest = b""
    for at in range(0, len(text), size):
        piece = rest + text[at : at + size].translate(_FOLDED)
        cut = piece.rfind(b" ") + 1 if at + size < len(text) else len(piece)
        rest = piece[cut:]
        yield piece[:cut].split()


def _handed_on(groups: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), (found, docs) in groups.items():
        if not found:
            continue
        terms = list(found)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(terms), pa.string()),
                pa.array([source] * len(terms), pa.string()),
                pa.array(terms, pa.binary()).cast(pa.string()),
                pa.array(list(found.values()), pa.int64()),
                pa.array([docs[t] for t in terms], pa.int64()),
            ],
            ["lang", "source", "term", "n", "docs"],
        )


def _cell(key: tuple, table: pa.Table) -> pa.Table:
    """Part of the divergence of every pair of a cell: one slice on the diagonal, two off it."""
    lang, row, column = key[0].as_py(), key[1].as_py(), key[2].as_py()
    sides = {b: i for i, b in enumerate(table["group_block"].to_pylist())}
    wanted = list(dict.fromkeys((row, column)))
    if len(sides) < len(wanted):  # hashing left a block without groups
        return pa.Table.from_pylist([], _PART_SCHEMA)
    used = [_entries(table, sides[b]) for b in wanted]
    columns = np.unique(np.concatenate([u[1] for u in used]))
    slices = [_slice(table, sides[b], u, columns) for b, u in zip(wanted, used)]
    (names, left, base) = slices[0]
    (others, right, other_base) = slices[-1]
    a, b, partial, rest = [], [], [], []
    for i, name in enumerate(names):
        first = i + 1 if len(slices) == 1 else 0
        if first == len(others):
            continue
        p, q = left[i][None, :], right[first:]
        partial.append(((p - q) ** 2 // (p + q)).sum(1))
        rest.append((base[i] - other_base[first:]) ** 2 // (base[i] + other_base[first:]))
        a += [name] * (len(others) - first)
        b += others[first:]
    n = len(a)
    return pa.table(
        {
            "lang": pa.array([lang] * n, pa.string()),
            "a": pa.array(a, pa.string()),
            "b": pa.array(b, pa.string()),
            "partial": pa.array(np.concatenate(partial) if n else [], pa.int64()),
            "met": pa.array([len(columns)] * n, pa.int64()),
            "rest": pa.array(np.concatenate(rest) if n else [], pa.int64()),
            "terms": pa.array([table["terms"][0].as_py()] * n, pa.int64()),
        }
    )


def _entries(table: pa.Table, side: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Sources, terms and probabilities of the used terms of a slice."""
    entries = table["entries"][side].values
    if entries is None:
        return pa.array([], pa.string()), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return entries.field("source"), entries.field("term_id").to_numpy(), entries.field("p").to_numpy()


def _slice(table: pa.Table, side: int, used: tuple, columns: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Groups of a slice, their probabilities on the terms ``columns``, and that of a term they never use."""
    members = table["members"][side].values
    base = members.field("p").to_numpy()
    dense = np.repeat(base[:, None], len(columns), axis=1)
    sources, terms, p = used
    if len(terms):
        rows = pc.index_in(sources, members.field("source")).to_numpy()
        dense[rows, np.searchsorted(columns, terms)] = p
    return members.field("source").to_pylist(), dense, base
