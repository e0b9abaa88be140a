"""A corpus pipeline: each stage applies one operator to what the stage before it kept.

Stages treat missing values, empty and repeated rows as their operators state. All but the
last return the columns of ``documents``, other columns of the input included.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from metricloom.llm import line_dedup, mixing, near_dedup, pieces, quality
from metricloom.llm.common import documents, fresh, stored, table

MODEL = "piece_bpe_32k.model"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the model fitted on the labelled rows."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def unique_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that repeat an earlier one; documents left without a word go.

    ``n_chars`` follows the new text.
    """
    counts = fresh(docs.columns, "lines"), fresh(docs.columns, "lines_dropped")
    out = line_dedup.dedup_lines(docs, drop_emptied=True, counts=counts)
    length = F.when(F.col(counts[1]) > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    kind = docs.schema["n_chars"].dataType
    return out.withColumn("n_chars", length.cast(kind)).select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )


def unique_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: 80 % or more of the shingles in common."""
    return near_dedup.keep_one_of_each(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    return mixing.mixed_rows(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each text, and whether decoding them gives the text again."""
    coded = pieces.encode(docs, ["doc_id", "source"], public_tokenizers.path(MODEL))
    return coded.select(
        "doc_id", "source", F.size("ids").cast("long").alias("n_pieces"), "ids", "same"
    )


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", unique_lines),
    ("near dedup", unique_documents),
    ("mixing", mixed_sources),
    ("pieces", encoded),
]

#: The fitted model of the first stage, the flights of the fourth and the encoder have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored and read by the next stage."""
    rows = documents(spark, sf_dir)
    for at, (name, stage) in enumerate(STAGES):
        rows = stage(spark, rows, sf_dir)
        if at < len(STAGES) - 1:
            rows = stored(rows, name.replace(" ", "-"))
    return rows
