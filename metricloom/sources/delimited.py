"""Delimited text in and out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from metricloom.functions.scalars import to_instant, to_number
from metricloom.operators.cleaning import coerce_all_but

_BROKEN = "_broken_record"


def read_metric_csv(spark: SparkSession, path: str, text_cols: Sequence[str]) -> DataFrame:
    """Header CSV: the named columns stay text, all others become double.

    Everything is read as text, which spares the extra pass of schema inference.
    """
    raw = spark.read.option("header", True).option("multiLine", False).csv(path)
    return coerce_all_but(raw, text_cols)


def read_lenient_csv(
    spark: SparkSession, path: str, columns: Sequence[str], header: bool = True,
    quoted_breaks: bool = False,
) -> DataFrame:
    """CSV with ragged rows: too long ones are dropped, short ones padded.

    Large files are split over tasks. With ``quoted_breaks`` a field may contain line breaks,
    and a file is then read by one task. Whether a row is too long does not depend on the
    columns a query reads: records are always parsed whole.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, _BROKEN]])
    raw = (
        spark.read.schema(schema)
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _BROKEN)
        .option("multiLine", quoted_breaks)
        .option("escape", '"')
        .option("columnPruning", False)
        .csv(path)
    )
    keep = F.col(_BROKEN).isNull() | (_field_count(F.col(_BROKEN)) <= len(columns))
    # A query of the broken records alone is refused, so a count has to read a field too.
    some = F.length(F.coalesce(F.col(columns[0]), F.lit(""))) >= 0
    return raw.where(keep & some).select(*columns)


def _field_count(record):
    """Fields of a raw record: delimiters outside quotes, plus one."""
    bare = F.regexp_replace(record, r'"([^"]|"")*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def write_result(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write a result table, replacing what was there."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def read_result(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv") -> DataFrame:
    reader = spark.read.schema(schema)
    return reader.option("header", True).csv(path) if fmt == "csv" else reader.format(fmt).load(path)


def read_features(
    spark: SparkSession, path: str, wanted: Sequence[str], date: str = "committer_date",
    keep: Sequence[str] = (),
) -> tuple[DataFrame, list[str]]:
    """Feature table from Parquet: valid dates only, and the wanted features that exist."""
    raw = spark.read.parquet(path)
    present = [c for c in wanted if c in raw.columns]
    typed = raw.select(
        *keep,
        to_instant(F.col(date)).alias(date),
        *[to_number(F.col(c)).alias(c) if _is_text(raw, c) else F.col(c).cast("double").alias(c) for c in present],
    )
    return typed.where(F.col(date).isNotNull()), present


def _is_text(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, T.StringType)
