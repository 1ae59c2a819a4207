"""Tables written as single CSV files, or as folders of them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.schema import FILE_COLUMNS, TS
from gapweave.sources.files import move_single_part

_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def named_for_files(df: DataFrame) -> DataFrame:
    """Inner column names to those of files; helper columns stay as they are."""
    return df.select(*(F.col(f"`{c}`").alias(FILE_COLUMNS.get(c, "timestamp" if c == TS else c)) for c in df.columns))


def write_csv(df: DataFrame, path: str, order: list[str] | None = None, **options) -> None:
    """df as one CSV file with a header, null as nothing, sorted if order is given; options as Spark's writer has. One task
    writes it: the single file is what is asked for; write_csv_folder() has no such task."""
    work = f"{path}.{uuid.uuid4().hex}"
    rows = df.orderBy(*order) if order else df
    rows.coalesce(1).write.option("header", True).option("timestampNTZFormat", _TIME).options(**options).csv(work)
    move_single_part(df.sparkSession, work, path)


def write_csv_folder(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("timestampNTZFormat", _TIME).csv(path)
