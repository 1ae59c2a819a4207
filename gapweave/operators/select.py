"""Which sequences and columns go on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gapweave.functions import time_text
from gapweave.operators.segment import Series, join_null_safe
from gapweave.schema import CARB, EVENT, FILE_COLUMNS, GLUCOSE, INSULIN, SEQUENCE, TS, TS_TEXT


def lengths(df: DataFrame, series: Series) -> DataFrame:
    """(keys, sequence_id, length)."""
    return df.groupBy(*series.keys, SEQUENCE).agg(F.count("*").alias("length"))


def of_length(df: DataFrame, series: Series, least: int = 200, fallback: bool = True) -> DataFrame:
    """Rows of sequences with at least so many rows; rows without an id go.

    fallback: if no sequence of the whole table is that long, all rows stay. Whether one is, is a subquery of the
    plan, which runs with it and on the same exchange. Where series are windows already, the count is one more window; else
    counts are aggregated before they meet the rows, so a long sequence is not gathered in one task."""
    if series.keys and not series.span:
        sized = _sized(df, series)
        long = (F.col("_length") >= least) & F.col(SEQUENCE).isNotNull()
        return sized.filter(long | ~_any(sized.filter(long)) if fallback else long).drop("_length")
    if not fallback:
        return of_length_by_join(df, series, least)
    every = lengths(df, series)
    long = (F.col("length") >= least) & F.col(SEQUENCE).isNotNull()
    return join_null_safe(df, every.filter(long | ~_any(every.filter(long))).drop("length"), [*series.keys, SEQUENCE], "left_semi")


def _any(df: DataFrame) -> Column:
    """Whether df has a row, as a column: a subquery of one value. It takes all columns of its row, so that nothing is
    pruned below it and its exchange is that of the query it stands in."""
    return df.limit(1).agg(F.max(F.xxhash64(*(F.col(f"`{c}`") for c in df.columns))).isNotNull()).scalar()


def _sized(df: DataFrame, series: Series) -> DataFrame:
    return df.withColumn("_length", F.count("*").over(W.partitionBy(*series.keys, SEQUENCE)))


def of_length_by_join(df: DataFrame, series: Series, least: int = 200) -> DataFrame:
    """Rows of long sequences by a semi-join with the counts."""
    long = lengths(df, series).filter((F.col("length") >= least) & F.col(SEQUENCE).isNotNull()).drop("length")
    return join_null_safe(df, long, [*series.keys, SEQUENCE], "left_semi")


def of_length_by_window(df: DataFrame, series: Series, least: int = 200) -> DataFrame:
    """Rows of long sequences by a windowed count."""
    return _sized(df, series).filter((F.col("_length") >= least) & F.col(SEQUENCE).isNotNull()).drop("_length")


def value_only(df: DataFrame) -> DataFrame:
    """Rows with glucose (NaN counts), without event, insulin and carb."""
    return df.filter(F.col(GLUCOSE).isNotNull()).drop(EVENT, INSULIN, CARB)


def ml_columns(df: DataFrame, series: Series = Series()) -> DataFrame:
    """Keys, sequence_id, the time as text, then event and values that there are, under the names of files."""
    text = time_text(TS).alias(FILE_COLUMNS[TS_TEXT])
    rest = [F.col(c).alias(FILE_COLUMNS[c]) for c in (EVENT, GLUCOSE, INSULIN, CARB) if c in df.columns]
    return df.select(*series.keys, SEQUENCE, text, *rest)
