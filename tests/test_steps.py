"""The hand-derived fixture, step rules, and properties of the sequence engine."""

import math
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gapweave.config import Config
from gapweave.functions import configure, replace_first, seconds_between, strip, time_text, to_number, to_time
from gapweave.operators import Series, balanced, drop_events, fill_gaps, ml_columns, of_length, purge_after_outages, replace_sentinels, segment
from gapweave.operators.segment import outage_ends
from gapweave.plans import prepare, stats

DAY = datetime(2020, 1, 1)
SCHEMA = "ts timestamp_ntz, event_type string, glucose string, insulin string, carb string, src_file string, src_block long, src_pos long"
ROWS = [
    ("00:00", "EGV", "100", ""), ("00:05", "EGV", "110", ""), ("00:15", "EGV", "130", ""), ("00:30", "EGV", "High", ""), ("00:35", "Calibration", "300", ""),
    ("00:44", "EGV", "Low", ""), ("00:44", "Insulin", "", "2.5"), ("00:54", "EGV", "90", ""), ("01:10", "EGV", "95", ""), ("01:15", "EGV", "96", ""),
    ("04:00", "EGV", "70", ""), ("05:00", "EGV", "71", ""), ("05:05", "EGV", "81", ""), ("05:10", "EGV", "82", ""), ("05:15", "EGV", "83", ""),
]
CONFIG = Config(remove_after_calibration_hours=1, min_sequence_len=3)


def at(text):
    h, m = map(int, text.split(":"))
    return DAY + timedelta(hours=h, minutes=m)


@pytest.fixture(scope="module")
def golden(spark):
    configure(spark)
    return spark.createDataFrame([(at(t), e, g, i, "", "f", 0, n) for n, (t, e, g, i) in enumerate(ROWS)], SCHEMA)


def shown(df):
    return [(r["sequence_id"], f"{r['ts']:%H:%M}", r["event_type"], "nan" if r["glucose"] is not None and math.isnan(r["glucose"]) else r["glucose"]) for r in df.orderBy("sequence_id", "ts", F.desc("glucose")).collect()]


WANT = [
    (0, "00:05", "EGV", 110.0), (0, "00:10", "Interpolated", 120.0), (0, "00:15", "EGV", 130.0), (0, "00:20", "Interpolated", 220.33333333333331), (0, "00:25", "Interpolated", 310.66666666666663),
    (0, "00:30", "EGV", 401.0), (0, "00:35", "Interpolated", 220.0), (0, "00:44", "EGV", 39.0), (0, "00:44", "Insulin", None), (0, "00:49", "Interpolated", "nan"), (0, "00:54", "EGV", 90.0),
    (2, "05:05", "EGV", 81.0), (2, "05:10", "EGV", 82.0), (2, "05:15", "EGV", 83.0),
]


@pytest.mark.parametrize("span", [None, "hour", "day"])
def test_golden_rows(golden, span):
    assert shown(prepare(golden, CONFIG, Series(span=span)).kept) == WANT


def test_large_series_are_cut(golden):
    assert balanced(golden, Series(), most=15) == Series() and balanced(golden, Series(), most=14).span == "hour"
    assert balanced(golden, Series(("event_type",)), most=13).span is None and balanced(golden, Series(("event_type",)), most=12).span == "hour"
    assert balanced(golden, Series(), most=7).span == "minute" and balanced(golden, Series(), most=1).span == "second"
    assert balanced(golden, Series(span="hour"), most=1).span == "hour" and balanced(golden.limit(0), Series(), most=1).span is None


def test_one_busy_day_and_a_hot_key_are_cut_by_size(spark, monkeypatch):
    """Ten million rows of one day: by default they would be one window; and a key with most of the rows."""
    configure(spark)
    day = spark.range(10_000_000).selectExpr("timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 0.00864) AS ts", "if(id % 10 = 0, id % 1000, -1) AS k", "id AS n")
    assert balanced(day, Series((), ("n",))).span == "hour" and balanced(day, Series(("k",), ("n",))).span == "hour"
    cut = prepare(day.selectExpr("ts", "'EGV' AS event_type", "1D AS glucose", "null AS insulin", "null AS carb", "k", "n"), CONFIG, Series(("k",), ("n",)))
    assert cut.series.span == "hour"
    text = cut.segmented._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in text and "_span" in text and "SinglePartition" not in text


def test_golden_rows_clean(golden):
    got = shown(prepare(golden, CONFIG.but(compat="clean")).kept)
    assert got == [(0, "00:00", "EGV", 100.0)] + [(s, t, e, None if g == "nan" else g) for s, t, e, g in WANT]


def test_golden_statistics(golden, monkeypatch):
    s = prepare(golden, CONFIG).statistics()
    assert s["replacement_analysis"] == {"high_replacements": 1, "low_replacements": 1, "total_replacements": 2, "glucose_field_converted_to_float": True}
    assert s["calibration_removal_analysis"] == {"calibration_events_removed": 1, "records_before_removal": 15, "records_after_removal": 14, "calibration_removal_enabled": True}
    gap = s["gap_analysis"]
    assert gap["calibration_period_analysis"] == {"calibration_periods_detected": 1, "sequences_marked_for_removal": 2, "total_records_marked_for_removal": 2}
    assert (gap["total_gaps"], gap["gap_positions"], gap["total_sequences"]) == (2, 2, 3)
    assert gap["sequence_lengths"] == {None: 1, 0: 6, 1: 2, 2: 3}
    fill = s["interpolation_analysis"]
    assert (fill["small_gaps_filled"], fill["total_interpolated_data_points"], fill["sequences_processed"], fill["large_gaps_skipped"]) == (4, 5, 3, 0)
    assert (fill["glucose_value_mg/dl_interpolations"], fill["insulin_value_u_interpolations"], fill["carb_value_grams_interpolations"], fill["total_interpolations"]) == (5, 0, 0, 5)
    kept = s["filtering_analysis"]
    assert (kept["original_sequences"], kept["filtered_sequences"], kept["removed_sequences"], kept["original_records"], kept["filtered_records"], kept["removed_records"]) == (3, 2, 1, 16, 14, 2)
    length = s["sequence_analysis"]["sequence_lengths"]
    assert (length["mean"], length["std"], length["25%"], length["50%"], length["75%"], length["max"], length["min"]) == (7, 4, 5, 7, 9, 11, 3)
    assert s["sequence_analysis"]["sequences_by_length"] == {3: 1, 11: 1}
    assert prepare(golden, CONFIG).statistics(each_sequence=False)["interpolation_analysis"] == fill
    monkeypatch.setattr(stats, "MOST_SEQUENCES", 3)
    assert prepare(golden, CONFIG).statistics()["gap_analysis"]["sequence_lengths"] == {}
    quality = s["data_quality"]
    assert [round(quality[k], 3) for k in ("glucose_data_completeness", "insulin_data_completeness", "carb_data_completeness")] == [92.857, 7.143, 0]
    assert quality["interpolated_records"] == 5
    assert s["dataset_overview"]["date_range"] == {"start": "2020-01-01T00:05:00", "end": "2020-01-01T05:15:00"}


def test_clean_statistics_and_glucose_only(golden):
    s = prepare(golden, CONFIG.but(compat="clean", glucose_only=True)).statistics()
    assert s["interpolation_analysis"]["total_interpolations"] == 4
    assert s["glucose_filtering_analysis"]["records_removed"] == 2 and s["glucose_filtering_analysis"]["fields_removed"] == ["event_type", "insulin", "carb"]
    plan = prepare(golden, CONFIG.but(glucose_only=True))
    assert plan.valued.count() == 13
    assert plan.output.columns == ["sequence_id", "Timestamp (YYYY-MM-DDThh:mm:ss)", "Glucose Value (mg/dL)"]


def test_fallback_keeps_all_when_nothing_is_long(golden):
    plan = prepare(golden, CONFIG.but(min_sequence_len=1000))
    assert plan.kept.count() == plan.filled.count() == 16
    assert plan.statistics()["filtering_analysis"] == {"original_sequences": 3, "filtered_sequences": 0, "removed_sequences": 3, "original_records": 16, "filtered_records": 0, "removed_records": 0}
    for span in (None, "hour"):
        assert prepare(golden, CONFIG.but(min_sequence_len=1000), Series(("event_type",), span=span)).kept.count() == prepare(golden, CONFIG, Series(("event_type",), span=span)).filled.count()


def test_empty_table(golden):
    plan = prepare(golden.limit(0), CONFIG)
    assert plan.output.count() == 0
    s = plan.statistics()
    assert s["dataset_overview"]["date_range"] == {"start": "N/A", "end": "N/A"} and s["gap_analysis"]["total_sequences"] == 0


def test_switches(golden):
    assert prepare(golden, CONFIG.but(remove_calibration=False)).cleaned.count() == 15
    assert prepare(golden, CONFIG.but(calibration_period_minutes=10)).segmented.count() == 14  # no purge below the gap limit
    assert [r["glucose"] for r in replace_sentinels(golden, enabled=False).filter("src_pos in (3, 5)").collect()] == [None, None]


def test_text_functions(spark):
    configure(spark)
    one = lambda f, xs: [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x string").select(f(F.col("x")).alias("y"), "i").orderBy("i").collect()]
    assert one(strip, [" a\t", "\xa0b　", None, ""]) == ["a", "b", None, ""]
    good = ["2019-10-28T16:42:37", "2019-10-28 0:52:15", "2019-10-28 00:52:15.25", "2019-1-4T6:2:7", "2019-10-28  \t00:52:15", " 2019-10-28T16:42:37\t", "2019-10-28t16:42:37"]
    assert [str(t) for t in one(to_time, good)] == ["2019-10-28 16:42:37", "2019-10-28 00:52:15", "2019-10-28 00:52:15.250000", "2019-01-04 06:02:07", "2019-10-28 00:52:15", "2019-10-28 16:42:37", "2019-10-28 16:42:37"]
    assert one(to_time, ["", "x", "2019-10-28T16:42:37.5", "2019-10-28T16:42:37Z", "2019-02-30 00:00:00", None]) == [None] * 6
    assert one(lambda c: to_number(replace_first(replace_first(c, "High", 401), "Low", 39)), ["1High", "HighHigh", "HIGH", "abc", "High", "Low", " 12.5 ", "1e2", ""]) == [1401.0, None, None, None, 401.0, 39.0, 12.5, 100.0, None]
    assert one(to_number, ["1.0d", "0x1p3", "5f", "+.5", "7."]) == [None, None, None, 0.5, 7.0]


def test_durations_are_truncated_once(spark):
    configure(spark)
    row = spark.sql("select timestamp_ntz'2020-01-01 00:00:00.9' a, timestamp_ntz'2020-01-01 00:15:01.8' b").select(seconds_between("a", "b"), time_text("b")).first()
    assert row[0] == 900 and row[1] == "2020-01-01T00:15:01"


def test_config_precedence_and_checks(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("small_gap_max_minutes: 20\nmin_sequence_len: 7\nunknown: 1\nglucose_value_replacement:\n  high_value: 500\n  enabled: false\n")
    c = Config.from_file(str(path), min_sequence_len=9, low_value=None)
    assert (c.small_gap_max_minutes, c.min_sequence_len, c.high_value, c.low_value, c.replacement_enabled, c.expected_interval_minutes) == (20, 9, 500, 39, False, 5)
    for bad in ({"expected_interval_minutes": 0}, {"expected_interval_minutes": -1}, {"small_gap_max_minutes": -1}, {"compat": "x"}):
        with pytest.raises(ValueError):
            Config(**bad)


def purge_by_join(df, series, period_minutes, hours):
    """The rows of purge_after_outages() by a range anti-join, quadratic in a series."""
    ends = df.select(*(F.col(k).alias(f"_{k}") for k in series.keys), outage_ends(df, period_minutes).alias("_end")).filter("_end is not null")
    reach = F.timestamp_add("MICROSECOND", F.lit(int(hours * 3_600_000_000)), F.col("_end")).cast("timestamp_ntz")
    on = F.col("ts").between(F.col("_end"), reach)
    for k in series.keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return df.join(ends, on, "left_anti")


minutes = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 900), st.booleans()), max_size=40)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(minutes)
def test_properties(spark, found):
    configure(spark)
    rows = [(DAY + timedelta(minutes=m), "Calibration" if c else "EGV", float(m), None, None, k, n) for n, (k, m, c) in enumerate(found)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, event_type string, glucose double, insulin double, carb double, k long, n long")
    series, cut = Series(("k",), ("n",)), Series(("k",), ("n",), "hour")
    seg = drop_events(df).transform(segment, series, 15)
    again = drop_events(df).repartition(5).transform(segment, cut, 15)
    key = lambda d: sorted(map(tuple, d.select("n", "sequence_id", "is_gap", "diff_s").collect()))
    assert [list(map(str, r)) for r in key(seg)] == [list(map(str, r)) for r in key(again)]
    a, b, c = (sorted(r["n"] for r in f(seg, s, 60, 1.5).collect()) for f, s in ((purge_after_outages, series), (purge_after_outages, cut), (purge_by_join, series)))
    assert a == b == c
    for s in (series, cut):
        one = segment(drop_events(df), s, 15, outages=(60, 1.5), carry=("glucose",))
        assert sorted(r["n"] for r in one.filter("not purged").collect()) == a
        lagged = segment(drop_events(df), s, 15, carry=("glucose", "insulin", "carb"))
        assert sorted(str(tuple(r)) for r in fill_gaps(lagged, s, 5, 15).select("k", "sequence_id", "ts", "glucose", "event_type").collect()) == sorted(
            str(tuple(r)) for r in fill_gaps(seg, series, 5, 15).select("k", "sequence_id", "ts", "glucose", "event_type").collect()
        )
    full = fill_gaps(seg, series, 5, 15)
    other = fill_gaps(again, cut, 5, 15)
    show = lambda d: sorted(str(tuple(r)) for r in d.select("k", "sequence_id", "ts", "glucose", "event_type").collect())
    assert show(full) == show(other)
    got = [r.asDict() for r in full.collect()]
    assert len([r for r in got if not r["generated"]]) == seg.filter("sequence_id is not null").count()
    by = {}
    for r in sorted(got, key=lambda r: r["ts"]):
        by.setdefault((r["k"], r["sequence_id"]), []).append(r)
    for own in by.values():
        steps = [(y["ts"] - x["ts"]).total_seconds() / 60 for x, y in zip(own, own[1:])]
        assert all(s <= 15 for s in steps)
        assert all(s < 10 for s in steps)  # a gap of two steps or more has been filled


def test_null_keys_form_a_series(spark):
    configure(spark)
    rows = [(DAY + timedelta(minutes=5 * n), "EGV", 1.0, None, None, None if n % 2 else 1, n) for n in range(12)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, event_type string, glucose double, insulin double, carb double, k long, n long")
    for span in (None, "hour"):
        series = Series(("k",), ("n",), span)
        seg = segment(df, series, 15)
        assert seg.filter("sequence_id is null").count() == 2
        kept = of_length(fill_gaps(seg, series, 5, 15), series, 3)
        assert kept.count() == 18 and ml_columns(kept, series).columns[:2] == ["k", "sequence_id"]
