"""Tables that cut lineage, kept where driver and executors both see them."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapweave.sources.files import scratch

#: Rows and bytes of the batches that go to Python, where the session has no values of its own: whole texts are wide rows.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def tune(docs: DataFrame) -> DataFrame:
    """docs, with batches for Python kept small, so that a worker's memory does not grow with long texts. The settings
    stay in the session, where it has no values of its own: plans take them when they run, after this returns."""
    conf = docs.sparkSession.conf
    for key, value in BATCHES.items():
        if conf.get(key, None) is None:
            conf.set(key, value)
    return docs


_made: list[str] = []


def materialise(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet to the shared folder and read again: later plans start from files, so a lost executor costs
    no recomputation."""
    spark = df.sparkSession
    path = scratch(spark, name)
    _made.append(path)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    if path in _made:
        _made.remove(path)


def discard(df: DataFrame) -> None:
    """Delete a table made by materialise() that no later plan reads."""
    _delete(df.sparkSession, df.scratch_path)


def made() -> int:
    """How many tables there are; for discard_since(). A table that a result reads must stay as long as the result is used: an
    operator deletes only those that its result does not read."""
    return len(_made)


def discard_since(spark: SparkSession, mark: int, keep: DataFrame) -> None:
    """Delete the tables made since made() gave mark, but for keep; nothing may read them any more."""
    for path in _made[mark:]:
        if path != keep.scratch_path:
            _delete(spark, path)


#: Columns that name a row: a hash of its file's name, and its place in the file. No operator's input has such columns.
ROW = ("__row_file", "__row_place")


def numbered(docs: DataFrame) -> DataFrame:
    """docs with ROW. Rows read from Parquet files have a place already; others are written first."""
    columns = F.xxhash64("_metadata.file_path").alias(ROW[0]), F.col("_metadata.row_index").alias(ROW[1])
    try:
        return docs.select("*", *columns)
    except AnalysisException:
        return materialise(docs, "rows").select("*", *columns)


#: Rows that a broadcast may name (16 MB); more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def without(rows: DataFrame, dropped: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """rows but for those that dropped names, both with ROW; without ROW."""
    names = [f"{c}_dropped" for c in ROW]
    dropped = materialise(dropped.select(*(F.col(c).alias(n) for c, n in zip(ROW, names))), "dropped-rows")
    side = F.broadcast(dropped) if dropped.count() <= most else dropped.hint("shuffle_hash")
    on = (F.col(ROW[0]) == F.col(names[0])) & (F.col(ROW[1]) == F.col(names[1]))
    return rows.join(side, on, "left_anti").drop(*ROW)


#: Values with more rows than this, and than the rows by HOT_VALUES, are joined by a broadcast: there are HOT_VALUES at most.
HOT_ROWS, HOT_VALUES = 10_000, 100_000


def join_counted(rows: DataFrame, found: DataFrame, key: str, count: str, n_rows: int) -> DataFrame:
    """rows joined by key with found, which has each value of key once, and how many of rows have it as count (dropped):
    those of values that many rows have by a broadcast, so that no task gets them all."""
    most = max(HOT_ROWS, n_rows // HOT_VALUES)
    hot, rest = found.filter(F.col(count) > most).drop(count), found.filter(F.col(count) <= most).drop(count)
    if hot.isEmpty():
        return rows.join(rest, key)
    return rows.join(F.broadcast(hot), key).unionByName(rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(rest, key))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark.read.parquet(f"{sf_dir}/{name}.parquet"))
