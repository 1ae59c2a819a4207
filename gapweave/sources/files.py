"""File access through Hadoop, so that any store that Spark reads will do."""

from __future__ import annotations

import csv
import io
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def csv_files(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """Paths and sizes of the folder's *.csv files, sorted; not those in folders below, nor names that Spark takes for hidden."""
    at, fs = _at(spark, folder)
    if not fs.exists(at):
        raise FileNotFoundError(f"no such folder: {folder}")
    if not fs.getFileStatus(at).isDirectory():
        raise ValueError(f"not a folder: {folder}")
    files = [(s.getPath().getName(), s.getPath().toString(), s.getLen()) for s in fs.listStatus(at) if s.isFile()]
    found = sorted((p, size) for n, p, size in files if n.endswith(".csv") and n[0] not in "._")
    if not found:
        raise ValueError(f"no CSV files in {folder}")
    return found


def first_record(spark: SparkSession, path: str, chunk: int = 1 << 14) -> list[str]:
    """The fields of a CSV file's first record, which may have line breaks in quotes; none for an empty file or line. Raises if
    the file cannot be read or is not UTF-8."""
    at, fs = _at(spark, path)
    stream = fs.open(at)
    try:
        raw = b""
        while True:
            more = bytes(stream.readNBytes(chunk))
            raw += more
            end = _record_end(raw)
            if end >= 0 or len(more) < chunk:
                text = (raw[:end] if end >= 0 else raw).decode("utf-8").removeprefix("\ufeff")
                return next(csv.reader(io.StringIO(text, newline="")), [])
            chunk *= 2
    finally:
        stream.close()


def _record_end(raw: bytes) -> int:
    """Place after the first line break outside quotes, or -1."""
    quotes, at = 0, 0
    for line in raw.splitlines(keepends=True):
        quotes += line.count(b'"')
        at += len(line)
        if quotes % 2 == 0 and line[-1:] in b"\r\n":
            return at
    return -1


def first_records(spark: SparkSession, paths: list[str], at_once: int = 16) -> list[list[str] | Exception]:
    """first_record() of many files, several at a time; the error where there is one."""

    def one(path: str) -> list[str] | Exception:
        try:
            return first_record(spark, path)
        except Exception as error:  # noqa: BLE001 - whatever the store says about one file, the others are read
            return error

    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(one, paths))


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder named by spark.checkpoint.dir, which the driver and all executors share. Where that is unset and
    the master is local, in an own folder."""
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="gapweave-")
        spark.conf.set("spark.checkpoint.dir", at)
    return f"{at.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    at, fs = _at(spark, path)
    stream = fs.create(at, True)
    try:
        stream.write(bytearray(content))
    finally:
        stream.close()


def move_single_part(spark: SparkSession, folder: str, target: str) -> None:
    """The one part file of a written folder becomes target; the folder goes."""
    at, fs = _at(spark, folder)
    part = next(s.getPath() for s in fs.listStatus(at) if s.getPath().getName().startswith("part-"))
    goal, _ = _at(spark, target)
    if goal.getParent() is not None:
        fs.mkdirs(goal.getParent())
    fs.delete(goal, False)
    if not fs.rename(part, goal):
        raise OSError(f"cannot write {target}")
    fs.delete(at, True)
