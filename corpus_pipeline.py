"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairlead.llm import packing, quality, secrets, simhash_dedup, substring_dedup
from fairlead.llm.common import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model, trained on the labelled ones, does not reject.

    A null or empty text has one empty line and is judged by it. Repeated rows are judged alike.
    Without labels nothing is rejected, as every score is 0.5. An empty table stays empty.
    """
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.score(docs.select(*COLUMNS), model, keep=COLUMNS)
    return scored.where(F.col("score") >= quality.THRESHOLD).drop("score")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the row of the smallest doc_id.

    Texts without words, null ones among them, are one group. Of rows that share the smallest
    doc_id, or where no row of a group has an id, one stays. An empty table stays empty.
    """
    return simhash_dedup.keep_one(docs.select(*COLUMNS), shingle=3, radius=2)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that start earlier; texts that lose nothing stay as they are.

    A text that loses words keeps the others joined by single spaces, and may become empty. Null texts stay
    null. Rows that repeat id and text are one document and keep the same. An empty table stays empty.
    """
    rows = docs.select(*COLUMNS, F.col("text").isNull().alias("_no_text"))
    cut = substring_dedup.dedup_substrings(rows, keep=(*COLUMNS, "_no_text"), untouched=True)
    return _with_text(cut, "kept", "_no_text")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with each secret replaced; the formats are learned from these texts.

    Null texts stay null, texts without secrets as they are, repeated rows alike. An empty table stays empty.
    """
    formats = secrets.train(docs)
    return _with_text(secrets.scan(docs.select(*COLUMNS), formats, keep=COLUMNS), "redacted", "text IS NULL")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training sequences: sequence_id, length, ids (little-endian 32-bit), doc_ids by place.

    A null or empty text is its end id alone; every row, repeated or without an id, is packed. Documents longer
    than a sequence appear once per piece. An empty table gives no sequences.
    """
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).sequences()


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", drop_near_duplicates),
    ("substring dedup", cut_repeated_passages),
    ("secret scans", redact_secrets),
    ("best-fit packing", pack_sequences),
]

# Training, fingerprints and packing have no SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.split()[0].lower()}")
    return STAGES[-1][1](spark, docs, sf_dir)


def _with_text(df: DataFrame, changed: str, no_text: str) -> DataFrame:
    """The columns of documents with a new text and its length; a null text stays null."""
    text = F.expr(f"if({no_text}, CAST(NULL AS STRING), {changed})")
    length = F.char_length(F.ifnull(text, F.lit("")))
    return df.select("doc_id", text.alias("text"), "lang", "source", length.cast("long").alias("n_chars"))
