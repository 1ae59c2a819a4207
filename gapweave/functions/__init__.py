"""Column expressions: trimming, lenient numbers and timestamps, durations, sentinels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Settings under which try_to_timestamp gives null, and zone-less times stay zone-less.
SETTINGS = {"spark.sql.timestampType": "TIMESTAMP_NTZ", "spark.sql.legacy.timeParserPolicy": "CORRECTED", "spark.sql.session.timeZone": "UTC"}
_FORMATS = ("yyyy-M-d'T'H:m:s", "yyyy-M-d H:m:s", "yyyy-M-d H:m:s.[SSSSSS][SSSSS][SSSS][SSS][SS][S]")
_NUMBER = r"^[+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def configure(spark) -> None:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)


def strip(c: Column | str) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def to_time(c: Column | str) -> Column:
    """Zone-less timestamp from one of three forms; null otherwise. 'T' takes no fraction; one-digit parts are taken."""
    text = F.regexp_replace(strip(c), r"(\d)\s+(\d)", "$1 $2")
    return F.coalesce(*(F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in _FORMATS))


def to_number(c: Column | str) -> Column:
    """double, or null for what is no plain number (Spark alone would also take 1.0d or 0x1p3)."""
    text = strip(c)
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def plain(value: float) -> str:
    """A parameter as text, whole numbers without a point."""
    return str(int(value)) if float(value).is_integer() else repr(float(value))


def replace_first(c: Column | str, word: str, value: float) -> Column:
    """The first occurrence of word becomes the number."""
    parts = F.split(_col(c), word, 2)
    return F.concat_ws(plain(value), parts)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds, truncated once on the difference."""
    return F.timestamp_diff("SECOND", _col(start), _col(end))


def plus_minutes(c: Column | str, minutes: Column) -> Column:
    return F.timestamp_add("MICROSECOND", (minutes.cast("double") * F.lit(6e7)).cast("long"), _col(c)).cast("timestamp_ntz")


def time_text(c: Column | str) -> Column:
    """ISO text to the second; a fraction is cut off."""
    return F.date_format(_col(c), "yyyy-MM-dd'T'HH:mm:ss")
