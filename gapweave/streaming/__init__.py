"""Sequences of an endless stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from gapweave.schema import TS

#: Microseconds that times are moved by while rows are grouped: watermarks begin at 1970, what lies before is late to them.
_MOVED = 10_000 * 365 * 86_400 * 1_000_000


def _moved(c: Column | str, by: int) -> Column:
    return F.timestamp_micros(F.unix_micros(c) + by)


def sequence_sessions(stream: DataFrame, keys: tuple[str, ...] = (), gap_max_minutes: int = 15, late: str = "1 hour") -> DataFrame:
    """(keys, start, end, rows) of each sequence of a stream with a timestamp column ts.

    A gap of more than gap_max whole seconds ends a sequence, so the session gap is one second more; end is
    the last row's time. Rows later than `late` are dropped by the watermark, and rows without a time. Watermarks that the
    stream's progress shows are 3,650,000 days ahead."""
    seconds = int(gap_max_minutes * 60) + 1
    rows = stream.withColumn(TS, _moved(F.col(TS).cast(TimestampType()), _MOVED)).withWatermark(TS, late)  # watermarks need zoned times
    found = rows.groupBy(*keys, F.session_window(TS, f"{seconds} seconds").alias("w")).agg(F.count("*").alias("rows"), F.max(TS).alias("end"))
    return found.select(*keys, _moved("w.start", -_MOVED).alias("start"), _moved("end", -_MOVED).alias("end"), "rows")
