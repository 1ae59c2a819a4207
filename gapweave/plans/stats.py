"""The statistics tree: each stage gives all its counts in one aggregation, run when asked for."""

from __future__ import annotations

from typing import TYPE_CHECKING, Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapweave.functions import time_text
from gapweave.operators.fill import gap_census
from gapweave.operators.segment import Series, outage_ends
from gapweave.operators.select import lengths
from gapweave.schema import CALIBRATION, CARB, EVENT, GLUCOSE, HIGH, INSULIN, INTERPOLATED, LOW, SEQUENCE, TS

if TYPE_CHECKING:
    from gapweave.plans.pipeline import Prepared


def _one(df: DataFrame, **columns: Column) -> dict[str, Any]:
    return df.agg(*(c.alias(n) for n, c in columns.items())).first().asDict(recursive=True)


def distinct_with_null(*columns: str) -> Column:
    """Number of different values; a null counts as one."""
    return F.count_distinct(F.struct(*columns))


def completeness(name: str, there: bool = True) -> Column:
    """Percentage of rows that have a value; NaN is one."""
    if not there:
        return F.lit(0.0)
    return F.when(F.count("*") > 0, (1 - F.count_if(F.col(name).isNull()) / F.count("*")) * 100).otherwise(0.0)


def length_summary(sizes: DataFrame) -> DataFrame:
    """One row: count, mean, std (of the population), min, quartiles, max of length."""
    q = F.percentile("length", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    found = sizes.agg(F.count("*").alias("count"), F.avg("length").alias("mean"), F.stddev_pop("length").alias("std"), F.min("length").alias("min"), q.alias("q"), F.max("length").alias("max"))
    return found.select("count", "mean", "std", "min", F.col("q")[0].alias("p25"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p75"), "max")


def gap_counts(segmented: DataFrame, series: Series) -> DataFrame:
    """One row: total_gaps, and total_sequences as the sum of each series' largest id + 1."""
    own = segmented.groupBy(*series.keys).agg(F.count_if("is_gap").alias("g"), (F.max(SEQUENCE) + 1).alias("s"))
    return own.agg(F.coalesce(F.sum("g"), F.lit(0)).alias("total_gaps"), F.coalesce(F.sum("s"), F.lit(0)).cast("long").alias("total_sequences"))


def fill_counts(segmented: DataFrame, series: Series, interval: float, gap_max: float, nan_glucose: bool) -> DataFrame:
    """One row: gaps filled, points created, points in which any field was filled, and points by field."""
    census = gap_census(segmented, series, interval, gap_max)

    def both(c: str) -> Column:
        return F.col(c).isNotNull() & F.col(f"prev_{c}").isNotNull() if c in segmented.columns else F.lit(False)

    glucose = F.lit(True) if nan_glucose else both(GLUCOSE)

    def points(when: Column) -> Column:
        return F.coalesce(F.sum(F.when(when, F.col("points")).otherwise(0)), F.lit(0)).cast("long")

    return census.agg(
        F.count_if("small_gap").alias("small_gaps_filled"),
        points(F.lit(True)).alias("total_interpolated_data_points"),
        points(glucose | both(INSULIN) | both(CARB)).alias("total_interpolations"),
        points(glucose).alias("glucose"),
        points(both(INSULIN)).alias("insulin"),
        points(both(CARB)).alias("carb"),
    )


def sequence_lengths(df: DataFrame, series: Series) -> dict:
    """Rows by sequence_id, with keys a tuple; the table has one row a sequence and comes to the driver as asked for."""
    rows = lengths(df, series).orderBy(*series.keys, F.asc_nulls_first(SEQUENCE)).toLocalIterator()
    return {(tuple(r[k] for k in series.keys) + (r[SEQUENCE],) if series.keys else r[SEQUENCE]): r["length"] for r in rows}


#: Sequences whose lengths come to the driver unasked.
MOST_SEQUENCES = 100_000


def tree(p: Prepared, each_sequence: bool | None = None) -> dict[str, Any]:
    """The whole tree. each_sequence brings the length of every sequence to the driver, by default if there are at most
    MOST_SEQUENCES; else that leaf is empty, and what comes is of bounded size but for the histogram, which has a row for each
    different length."""
    c, series = p.config, p.series
    raw = dict(p.source.dtypes)[GLUCOSE] == "string" and c.replacement_enabled
    exact = lambda word: F.count_if(F.col(GLUCOSE) == word) if raw else F.lit(0)
    before = _one(p.source, high=exact(HIGH), low=exact(LOW), rows=F.count("*"), marked=F.count_if(F.col(EVENT) == CALIBRATION))
    gone = before["marked"] if c.remove_calibration else 0
    outage = {"outages": 0, "purged": 0, "affected": 0}
    if c.purges:
        hit = F.when(F.col("purged"), F.struct(*series.keys, SEQUENCE))
        outage = _one(p.first, outages=F.count(outage_ends(p.first, c.calibration_period_minutes)), purged=F.count_if("purged"), affected=F.count_distinct(hit))
    found = gap_counts(p.segmented, series).first()
    counted = _one(lengths(p.segmented, series), all=F.count("*"), several=F.count_if((F.col("length") >= 2) & F.col(SEQUENCE).isNotNull()))
    several = counted["several"]
    if each_sequence is None:
        each_sequence = counted["all"] <= MOST_SEQUENCES
    sizes = sequence_lengths(p.segmented, series) if each_sequence else {}
    fills = fill_counts(p.segmented, series, c.expected_interval_minutes, c.small_gap_max_minutes, c.drops_first).first()
    long = (F.col("length") >= c.min_sequence_len) & F.col(SEQUENCE).isNotNull()
    whole = _one(lengths(p.filled, series), s=F.count("*"), r=F.coalesce(F.sum("length"), F.lit(0)), long=F.count_if(long), rows=F.coalesce(F.sum(F.when(long, F.col("length"))), F.lit(0)))
    final = lengths(p.valued, series)
    summary = length_summary(final).first()
    histogram = {r["length"]: r["count"] for r in final.groupBy("length").count().orderBy("length").collect()}
    kept = whole["rows"] if whole["long"] else whole["r"]  # if no sequence is long enough, all rows stay
    there = set(p.valued.columns)
    text = time_text(TS)
    end = _one(
        p.valued, rows=F.count("*"), start=F.min(text), end=F.max(text), g=completeness(GLUCOSE), i=completeness(INSULIN, INSULIN in there), c=completeness(CARB, CARB in there),
        made=F.count_if(F.col(EVENT) == INTERPOLATED) if EVENT in there else F.lit(0),
    )
    return {
        "dataset_overview": {"total_records": end["rows"], "total_sequences": summary["count"], "date_range": {"start": end["start"] or "N/A", "end": end["end"] or "N/A"}},
        "sequence_analysis": {
            "sequence_lengths": {"count": summary["count"], "mean": summary["mean"] or 0.0, "std": summary["std"] or 0.0, "min": summary["min"] or 0, "25%": summary["p25"] or 0.0, "50%": summary["p50"] or 0.0, "75%": summary["p75"] or 0.0, "max": summary["max"] or 0},
            "longest_sequence": summary["max"] or 0,
            "shortest_sequence": summary["min"] or 0,
            "sequences_by_length": histogram,
        },
        "gap_analysis": {
            "total_sequences": found["total_sequences"],
            "gap_positions": found["total_gaps"],
            "total_gaps": found["total_gaps"],
            "sequence_lengths": sizes,
            "calibration_period_analysis": {"calibration_periods_detected": outage["outages"], "sequences_marked_for_removal": outage["affected"], "total_records_marked_for_removal": outage["purged"]},
        },
        "interpolation_analysis": {
            "total_interpolations": fills["total_interpolations"],
            "total_interpolated_data_points": fills["total_interpolated_data_points"],
            "glucose_value_mg/dl_interpolations": fills["glucose"],
            "insulin_value_u_interpolations": fills["insulin"],
            "carb_value_grams_interpolations": fills["carb"],
            "sequences_processed": several,
            "small_gaps_filled": fills["small_gaps_filled"],
            "large_gaps_skipped": 0,  # a large gap always ends a sequence
        },
        "calibration_removal_analysis": {"calibration_events_removed": gone, "records_before_removal": before["rows"], "records_after_removal": before["rows"] - gone, "calibration_removal_enabled": c.remove_calibration},
        "filtering_analysis": {
            "original_sequences": whole["s"],
            "filtered_sequences": whole["long"],
            "removed_sequences": whole["s"] - whole["long"],
            "original_records": whole["r"],
            "filtered_records": whole["rows"],
            "removed_records": whole["r"] - whole["rows"] if whole["long"] else 0,
        },
        "replacement_analysis": {"high_replacements": before["high"], "low_replacements": before["low"], "total_replacements": before["high"] + before["low"], "glucose_field_converted_to_float": True},
        "glucose_filtering_analysis": {
            "original_records": kept,
            "glucose_only_enabled": c.glucose_only,
            "records_after_filtering": end["rows"],
            "records_removed": kept - end["rows"] if c.glucose_only else 0,
            "fields_removed": [n for n in (EVENT, INSULIN, CARB) if n in p.kept.columns] if c.glucose_only else [],
        },
        "data_quality": {"glucose_data_completeness": end["g"], "insulin_data_completeness": end["i"], "carb_data_completeness": end["c"], "interpolated_records": end["made"]},
    }
