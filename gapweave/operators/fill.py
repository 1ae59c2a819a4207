"""Short gaps filled on the grid, linear in the place of a row between its neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapweave.functions import plus_minutes, seconds_between, time_text
from gapweave.operators.segment import Series, previous
from gapweave.schema import EVENT, GLUCOSE, INTERPOLATED, SEQUENCE, TS, TS_TEXT, VALUES


def gap_census(df: DataFrame, series: Series, interval_minutes: float = 5, gap_max_minutes: float = 15) -> DataFrame:
    """Segmented df with the values before each row (prev_*), small_gap and points: how many rows fill it.

    A gap longer than gap_max breaks the sequence, so a short one never crosses two. What segment() has carried
    over is used, else it is looked up."""
    values = [c for c in VALUES if c in df.columns]
    if not {f"prev_{c}" for c in (TS, SEQUENCE, *values)} <= set(df.columns):
        df = previous(df, series, [TS, SEQUENCE, *values])
    minutes = seconds_between("prev_ts", TS) / F.lit(60.0)
    small = (minutes > F.lit(float(interval_minutes))) & (minutes <= F.lit(float(gap_max_minutes))) & (F.col("prev_sequence_id") == F.col(SEQUENCE))
    df = df.withColumn("small_gap", F.coalesce(small, F.lit(False)))
    points = F.floor(minutes / F.lit(float(interval_minutes))).cast("int") - 1
    return df.withColumn("points", F.when(F.col("small_gap") & (points > 0), points).otherwise(F.lit(0)))


def _between(c: str) -> Column:
    return F.col(f"prev_{c}") + (F.col("place") / (F.col("points") + 1)) * (F.col(c) - F.col(f"prev_{c}"))


def fill_gaps(df: DataFrame, series: Series, interval_minutes: float = 5, gap_max_minutes: float = 15, nan_glucose: bool = True, drop_first: bool = True) -> DataFrame:
    """Segmented df with a row for each grid point inside a short gap, event 'Interpolated'.

    One pass: each row emits the points before it and itself. A value is interpolated if both neighbours have
    it, else it is null; glucose is NaN then if nan_glucose. drop_first leaves out rows without a sequence_id.
    generated tells the new rows."""
    names = [c for c in df.columns if c not in ("diff_s", "is_gap") and not c.startswith("prev_")]
    values = [c for c in VALUES if c in names]
    df = gap_census(df, series, interval_minutes, gap_max_minutes)
    if drop_first:
        df = df.filter(F.col(SEQUENCE).isNotNull())
    df = df.withColumn("place", F.explode(F.when(F.col("points") > 0, F.sequence(F.lit(0), "points")).otherwise(F.array(F.lit(0)))))
    made = F.col("place") > 0
    at = plus_minutes("prev_ts", F.col("place") * F.lit(interval_minutes))
    out: dict[str, Column] = {c: F.col(c) for c in names}
    out[TS] = F.when(made, at).otherwise(F.col(TS))
    for c in values:
        value = _between(c)
        if c == GLUCOSE and nan_glucose:
            value = F.coalesce(value, F.lit(float("nan")))
        out[c] = F.when(made, value).otherwise(F.col(c))
    if EVENT in names:
        out[EVENT] = F.when(made, F.lit(INTERPOLATED)).otherwise(F.col(EVENT))
    if TS_TEXT in names:
        out[TS_TEXT] = F.when(made, time_text(at)).otherwise(F.col(TS_TEXT))
    return df.select(*(c.alias(n) for n, c in out.items()), made.alias("generated"))
