"""Sequences between large gaps, and the purge after long outages.

Two ways to run the same windows. By series: one window for each series key, one exchange and
one sort for all of it. By span: a series is cut at calendar bounds into spans that are
windows of their own; what a span needs of those before it (the last row, the number of gaps,
the last outage) travels through a table with one row a span, so neither one endless series nor
a hot key ends up in one task.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gapweave.functions import seconds_between
from gapweave.schema import SEQUENCE, TIES, TS

_SPAN = "_span"
#: Rows of one series that one task may sort; larger series are cut.
WINDOW_ROWS = 5_000_000


@dataclass(frozen=True)
class Series:
    """keys: columns that name a series, none for a single one. ties: columns that order rows of equal time.
    span: calendar unit ('hour', 'day', 'week', 'month', ...) at which series are cut for windows, or None."""

    keys: tuple[str, ...] = ()
    ties: tuple[str, ...] = TIES
    span: str | None = None

    @property
    def order(self) -> list[str]:
        return [TS, *self.ties]

    @property
    def parts(self) -> list[str]:
        return [*self.keys, *([_SPAN] if self.span else [])]

    def window(self) -> W:
        return W.partitionBy(*self.parts).orderBy(*self.order) if self.parts else W.orderBy(*self.order)

    def spans(self) -> W:
        return W.partitionBy(*self.keys).orderBy(_SPAN) if self.keys else W.orderBy(_SPAN)

    def cut(self, df: DataFrame) -> DataFrame:
        return df.withColumn(_SPAN, F.date_trunc(self.span, TS)) if self.span else df


#: Calendar units by which series are cut, the longest first.
SPANS = ("day", "hour", "minute", "second")


def balanced(df: DataFrame, series: Series, most: int = WINDOW_ROWS) -> Series:
    """series as it is, or cut into spans if the largest one has more than `most` rows, which would be one task's
    window: the longest unit of which no span has more, be it that of a hot key or of one busy day; seconds if none will do.
    One small aggregation runs, and one more for each unit tried; the rows that come out are the same either way."""
    if series.span:
        return series

    def largest(*by) -> int:
        sizes = df.groupBy(*by).count() if by else df.agg(F.count("*").alias("count"))
        return sizes.agg(F.max("count")).first()[0] or 0

    if largest(*series.keys) <= most:
        return series
    for unit in SPANS:
        if unit == SPANS[-1] or largest(*series.keys, F.date_trunc(unit, TS)) <= most:
            return replace(series, span=unit)


def join_null_safe(left: DataFrame, right: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Join on equal names; a null equals a null, as it does in windows and groups."""
    right = right.select(*(F.col(c).alias(f"_right_{c}") if c in names else F.col(c) for c in right.columns))
    on = F.lit(True)
    for c in names:  # spans are never null, and plain equality keeps the partitioning that windows have made
        on = on & (F.col(c) == F.col(f"_right_{c}") if c == _SPAN else F.col(c).eqNullSafe(F.col(f"_right_{c}")))
    return left.join(right, on, how).drop(*(f"_right_{c}" for c in names))


def previous(df: DataFrame, series: Series, columns: list[str], prefix: str = "prev_") -> DataFrame:
    """df with each column's value in the row before it in its series, null in the first."""
    w = series.window()
    if not series.span:
        return df.withColumns({prefix + c: F.lag(c).over(w) for c in columns})
    df = series.cut(df)
    last = df.groupBy(*series.parts).agg(F.max_by(F.struct(*columns), F.struct(*series.order)).alias("_last"))
    carry = last.select(*series.parts, F.lag("_last").over(series.spans()).alias("_carry"))
    df = join_null_safe(df, carry, series.parts)
    first = F.row_number().over(w) == 1
    return df.withColumns({prefix + c: F.when(first, F.col(f"_carry.{c}")).otherwise(F.lag(c).over(w)) for c in columns}).drop("_carry", _SPAN)


def running(df: DataFrame, series: Series, value: Column, name: str, how) -> DataFrame:
    """df with how(value) (F.sum or F.max) over all rows of the series up to each; nulls do not count."""
    w = series.window().rowsBetween(W.unboundedPreceding, W.currentRow)
    if not series.span:
        return df.withColumn(name, how(value).over(w))
    df = series.cut(df).withColumn("_value", value)
    total = df.groupBy(*series.parts).agg(how("_value").alias("_total"))
    before = how("_total").over(series.spans().rowsBetween(W.unboundedPreceding, -1))
    df = join_null_safe(df, total.select(*series.parts, before.alias("_before")), series.parts)
    own = how("_value").over(w)
    if how is F.sum:
        whole = F.when(own.isNull() & F.col("_before").isNull(), None).otherwise(F.coalesce(own, F.lit(0)) + F.coalesce("_before", F.lit(0)))
    else:
        whole = F.greatest(own, "_before")
    return df.withColumn(name, whole).drop("_value", "_before", _SPAN)


def gaps(df: DataFrame, series: Series, gap_max_minutes: float) -> DataFrame:
    """df with diff_s (whole seconds since the row before) and is_gap; both null in a series' first row."""
    df = previous(df, series, [TS])
    return df.withColumn("diff_s", seconds_between("prev_ts", TS)).withColumn("is_gap", F.col("diff_s") > F.lit(gap_max_minutes * 60)).drop("prev_ts")


def _windowed(df: DataFrame, series: Series, gap_max_minutes: float, period_minutes: float | None, carry: tuple[str, ...]) -> DataFrame:
    """df with what one window (a series, or a span of it) knows: _prev, the row before; diff_s, is_gap; _gaps and
    _end, the gaps and the last outage's end so far; _head, its first row's place."""
    w = series.window()
    so_far = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    place = F.struct(*series.order)
    df = df.withColumns({"_prev": F.lag(F.struct(*series.order, *carry)).over(w), "_head": F.first(place).over(so_far)})
    df = df.withColumn("diff_s", seconds_between("_prev.ts", TS)).withColumn("is_gap", F.col("diff_s") > F.lit(gap_max_minutes * 60))
    df = df.withColumn("_gaps", F.sum(F.col("is_gap").cast("long")).over(so_far))
    end = F.lit(None).cast("timestamp_ntz") if period_minutes is None else F.max(outage_ends(df, period_minutes)).over(so_far)
    return df.withColumn("_end", end)


def _joined_spans(df: DataFrame, series: Series, gap_max_minutes: float, period_minutes: float | None, carry: tuple[str, ...]) -> DataFrame:
    """_windowed() over whole series from spans of them: one table with a row a span carries over all that a span
    needs of those before it, so df is read twice."""
    rows = _windowed(series.cut(df), series, gap_max_minutes, period_minutes, carry)
    last = F.max_by(F.struct(*series.order, *carry), F.struct(*series.order))
    table = rows.groupBy(*series.parts).agg(F.min(TS).alias("_first_ts"), last.alias("_last"), F.min(F.struct(*series.order)).alias("_own_head"), F.count_if("is_gap").alias("_n"), F.max("_end").alias("_own_end"))
    spans = series.spans()
    before, up_to = spans.rowsBetween(W.unboundedPreceding, -1), spans.rowsBetween(W.unboundedPreceding, W.currentRow)
    table = table.withColumns({"_edge_prev": F.lag("_last").over(spans), "_series_head": F.first("_own_head").over(up_to)})
    table = table.withColumn("_edge_s", seconds_between("_edge_prev.ts", "_first_ts")).withColumn("_edge_gap", F.col("_edge_s") > F.lit(gap_max_minutes * 60))
    edge_end = F.lit(None).cast("timestamp_ntz") if period_minutes is None else F.when(F.col("_edge_gap") & (F.col("_edge_s") >= F.lit(period_minutes * 60)), F.col("_first_ts"))
    table = table.withColumn("_edge_end", edge_end)
    count = F.coalesce(F.sum("_n").over(before), F.lit(0)) + F.coalesce(F.sum(F.col("_edge_gap").cast("long")).over(up_to), F.lit(0))
    end = F.greatest(F.max(F.greatest("_own_end", "_edge_end")).over(before), F.col("_edge_end"))
    table = table.select(*series.parts, "_edge_prev", "_edge_s", "_edge_gap", "_series_head", count.alias("_count"), end.alias("_before_end"))
    rows = join_null_safe(rows, table, series.parts)
    first = F.col("_prev").isNull()
    whole = F.when(first & F.col("_edge_prev").isNull(), None).otherwise(F.col("_count") + F.coalesce("_gaps", F.lit(0)))
    out = {
        "diff_s": F.when(first, F.col("_edge_s")).otherwise(F.col("diff_s")),
        "is_gap": F.when(first, F.col("_edge_gap")).otherwise(F.col("is_gap")),
        "_gaps": whole,
        "_end": F.greatest("_end", "_before_end"),
        "_head": F.col("_series_head"),
        "_prev": F.when(first, F.col("_edge_prev")).otherwise(F.col("_prev")),
    }
    return rows.withColumns(out).drop("_edge_prev", "_edge_s", "_edge_gap", "_series_head", "_count", "_before_end", _SPAN)


def segment(df: DataFrame, series: Series, gap_max_minutes: float = 15, first_id: int | None = None, outages: tuple[float, float] | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """df with diff_s, is_gap and sequence_id: the number of gaps so far. A series' first row has no gap and so
    first_id, null by default; rows after it count from 0.

    outages (period_minutes, hours) adds purged, as after_outage() would. carry adds the columns' values in the
    row before as prev_*, with prev_ts and prev_sequence_id, for fill_gaps(). Either costs no pass of its own."""
    df = df.drop("diff_s", "is_gap", SEQUENCE)
    run = _joined_spans if series.span else _windowed
    df = run(df, series, gap_max_minutes, outages[0] if outages else None, carry)
    known = F.lit(first_id).cast("long")
    out = {SEQUENCE: F.coalesce("_gaps", known)}
    if outages:
        out["purged"] = _within(F.col("_end"), outages[1])
    if carry:
        behind = F.col("_gaps") - F.col("is_gap").cast("long")
        at_head = F.struct(*(F.col(f"_prev.{c}") for c in series.order)) == F.col("_head")
        out["prev_" + SEQUENCE] = F.when(F.col("_prev").isNotNull(), F.when(at_head, known).otherwise(behind))
        out |= {f"prev_{c}": F.col(f"_prev.{c}") for c in (TS, *carry)}
    return df.withColumns(out).drop("_prev", "_head", "_gaps", "_end")


def _within(end: Column, hours: float) -> Column:
    """Whether ts lies at most so long after an outage's end."""
    reach = F.timestamp_add("MICROSECOND", F.lit(int(hours * 3_600_000_000)), end).cast("timestamp_ntz")
    return F.coalesce(reach >= F.col(TS), F.lit(False))


def outage_ends(df: DataFrame, period_minutes: float) -> Column:
    """Time of a row that ends a gap as long as a calibration period, else null."""
    return F.when(F.col("is_gap") & (F.col("diff_s") >= F.lit(period_minutes * 60)), F.col(TS))


def after_outage(df: DataFrame, series: Series, period_minutes: float, hours: float) -> DataFrame:
    """Segmented df with purged: whether a row lies within [t, t + hours] of some outage's end t.

    All intervals have one length, so the latest start decides; its row is the first of its time, so a
    running maximum over rows serves rows of equal time alike."""
    df = running(df, series, outage_ends(df, period_minutes), "_end", F.max)
    return df.withColumn("purged", _within(F.col("_end"), hours)).drop("_end")


def purge_after_outages(df: DataFrame, series: Series, period_minutes: float = 165, hours: float = 24) -> DataFrame:
    """Segmented df without the rows after outages. Sequence ids are those from before; segment() again for new ones."""
    return after_outage(df, series, period_minutes, hours).filter(~F.col("purged")).drop("purged")
