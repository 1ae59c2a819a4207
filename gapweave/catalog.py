"""Registered queries of the sequence-preparation engine with their SQL oracles.

They run over the events table: users are series, event_id breaks ties. Parameters suit its
spacing: a grid of 60 minutes, gaps up to 720, outages from 2880, 24 hours purged, 8 rows. The
unkeyed ones take the whole table as one series, cut into days, with 5, 15 and 30 minutes, 2 hours, 30 rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapweave.functions import configure, time_text, to_time
from gapweave.operators import Series, drop_events, fill_gaps, gap_census, ml_columns, of_length, purge_after_outages, replace_sentinels, segment, value_only
from gapweave.operators.segment import after_outage, gaps, outage_ends
from gapweave.operators.select import lengths, of_length_by_join, of_length_by_window
from gapweave.plans import stats
from gapweave.schema import CALIBRATION, CARB, EVENT, FILE_COLUMNS, GLUCOSE, HIGH, INSULIN, INTERPOLATED, LOW, SEQUENCE, TS
from gapweave.sources import from_frame

KEYED, SINGLE = Series(("user_id",), ("event_id",)), Series((), ("event_id",), "day")
E_, M_, P_, H_, N_ = 60, 720, 2880, 24, 8
QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}

# ---- stages over events ----


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    kind, value = F.col("event_type"), F.col("value")
    event = F.when(kind == "error", CALIBRATION).when(kind == "purchase", "Insulin").when(kind == "signup", "Carb").otherwise("EGV")
    text = F.when(kind.isin("purchase", "signup"), "").when(value >= 200, HIGH).when(value < 5, LOW).otherwise(value.cast("string"))
    return from_frame(rows, F.col("ts"), event, text, F.when(kind == "purchase", value), F.when(kind == "signup", value), ("user_id", "event_id"))


def cleaned(spark, sf_dir):
    return drop_events(replace_sentinels(events(spark, sf_dir)))


def segmented(spark, sf_dir):
    return segment(cleaned(spark, sf_dir), KEYED, M_)


def purged(spark, sf_dir):
    return purge_after_outages(segmented(spark, sf_dir), KEYED, P_, H_)


def resegmented(spark, sf_dir):
    return segment(purged(spark, sf_dir), KEYED, M_)


def filled(spark, sf_dir):
    return fill_gaps(resegmented(spark, sf_dir), KEYED, E_, M_, nan_glucose=False)


def kept(spark, sf_dir):
    return of_length(filled(spark, sf_dir), KEYED, N_)


# ---- the same stages as SQL ----

_SRC = """src AS (SELECT event_id, user_id, ts,
    CASE event_type WHEN 'error' THEN 'Calibration' WHEN 'purchase' THEN 'Insulin' WHEN 'signup' THEN 'Carb' ELSE 'EGV' END AS event_type,
    CASE WHEN event_type IN ('purchase', 'signup') THEN NULL WHEN value >= 200 THEN 401.0 WHEN value < 5 THEN 39.0 ELSE value END AS glucose,
    CASE WHEN event_type = 'purchase' THEN value END AS insulin, CASE WHEN event_type = 'signup' THEN value END AS carb FROM events)"""
_CLEANED = "cleaned AS (SELECT * FROM src WHERE event_type <> 'Calibration')"


def _seg(name: str, source: str, by: str, gap: float) -> str:
    w = f"({by} ORDER BY ts, event_id)"
    return f"""{name}_d AS (SELECT *, (epoch_us(ts) - epoch_us(lag(ts) OVER {w})) // 1000000 AS diff_s FROM {source}),
    {name}_g AS (SELECT *, diff_s > {gap * 60} AS is_gap FROM {name}_d),
    {name} AS (SELECT *, CAST(sum(CAST(is_gap AS INTEGER)) OVER ({by} ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS sequence_id FROM {name}_g)"""


def _chain(by: str = "PARTITION BY user_id", e: int = E_, m: int = M_, p: int = P_, h: int = H_, n: int = N_) -> str:
    key = "user_id, " if by else ""
    w = f"({by} ORDER BY ts, event_id)"
    return f"""WITH {_SRC}, {_CLEANED}, {_seg("seg1", "cleaned", by, m)},
    marked AS (SELECT *, coalesce(max(CASE WHEN is_gap AND diff_s >= {p * 60} THEN ts END) OVER ({by} ORDER BY ts RANGE UNBOUNDED PRECEDING) >= ts - INTERVAL {h} HOUR, false) AS purged FROM seg1),
    left1 AS (SELECT event_id, user_id, ts, event_type, glucose, insulin, carb FROM marked WHERE NOT purged),
    {_seg("seg2", "left1", by, m)},
    census0 AS (SELECT *, lag(ts) OVER {w} AS p_ts, lag(sequence_id) OVER {w} AS p_seq, lag(glucose) OVER {w} AS p_glucose, lag(insulin) OVER {w} AS p_insulin, lag(carb) OVER {w} AS p_carb FROM seg2),
    census1 AS (SELECT *, coalesce(diff_s / 60.0 > {e} AND diff_s / 60.0 <= {m} AND p_seq = sequence_id, false) AS small_gap FROM census0),
    census AS (SELECT *, CASE WHEN small_gap THEN greatest(CAST(floor(diff_s / 60.0 / {e}) AS BIGINT) - 1, 0) ELSE 0 END AS points FROM census1),
    places AS (SELECT *, unnest(range(0, points + 1)) AS j FROM census WHERE sequence_id IS NOT NULL),
    filled AS (SELECT user_id, event_id, sequence_id, CASE WHEN j > 0 THEN p_ts + to_minutes(CAST({e} * j AS BIGINT)) ELSE ts END AS ts,
        CASE WHEN j > 0 THEN 'Interpolated' ELSE event_type END AS event_type,
        CASE WHEN j > 0 THEN p_glucose + (CAST(j AS DOUBLE) / (points + 1)) * (glucose - p_glucose) ELSE glucose END AS glucose,
        CASE WHEN j > 0 THEN p_insulin + (CAST(j AS DOUBLE) / (points + 1)) * (insulin - p_insulin) ELSE insulin END AS insulin,
        CASE WHEN j > 0 THEN p_carb + (CAST(j AS DOUBLE) / (points + 1)) * (carb - p_carb) ELSE carb END AS carb FROM places),
    long AS (SELECT {key}sequence_id FROM filled GROUP BY ALL HAVING count(*) >= {n}),
    kept AS (SELECT * FROM filled WHERE ({key}sequence_id) IN (SELECT ({key}sequence_id) FROM long) OR NOT EXISTS (SELECT 1 FROM long)) """


_K = _chain()
_U = _chain("", 5, 15, 30, 2, 30)
_TEXT = "strftime(ts, '%Y-%m-%dT%H:%M:%S')"


def query(sql: str):
    """Register a query under its name with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return add


# ---- scalar steps ----


@query("SELECT event_id, strftime(CASE event_id % 4 WHEN 2 THEN ts WHEN 3 THEN NULL ELSE date_trunc('second', ts) END, '%Y-%m-%d %H:%M:%S.%f') AS parsed FROM events")
def parse_timestamp_formats(spark, sf_dir):
    forms = ["yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"]
    rows, text = events(spark, sf_dir), F.lit(None).cast("string")
    for i, form in enumerate(forms):
        text = F.when(F.col("event_id") % 4 == i, F.date_format(TS, form)).otherwise(text)
    return rows.select("event_id", F.date_format(to_time(F.concat(F.lit("\t "), text, F.lit("  "))), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("parsed"))


@query(f"WITH {_SRC} SELECT event_id, glucose, insulin, carb FROM src")
def sentinel_replace(spark, sf_dir):
    return replace_sentinels(events(spark, sf_dir)).select("event_id", GLUCOSE, INSULIN, CARB)


@query(f"WITH {_SRC}, {_CLEANED} SELECT event_id, event_type, glucose FROM cleaned")
def drop_calibration_events(spark, sf_dir):
    return cleaned(spark, sf_dir).select("event_id", EVENT, GLUCOSE)


# ---- windows and segmentation ----


@query(_K + "SELECT event_id, diff_s FROM seg1")
def time_diff_lag(spark, sf_dir):
    return gaps(cleaned(spark, sf_dir), KEYED, M_).select("event_id", "diff_s")


@query(_K + "SELECT event_id, is_gap FROM seg1")
def gap_flags(spark, sf_dir):
    return gaps(cleaned(spark, sf_dir), KEYED, M_).select("event_id", "is_gap")


@query(_K + "SELECT user_id, event_id, sequence_id FROM seg1")
def sequence_ids(spark, sf_dir):
    return segmented(spark, sf_dir).select("user_id", "event_id", SEQUENCE)


@query(_U + "SELECT event_id, sequence_id FROM seg1")
def sequence_ids_unkeyed(spark, sf_dir):
    return segment(cleaned(spark, sf_dir), SINGLE, 15).select("event_id", SEQUENCE)


@query(_K + f"SELECT user_id, event_id, diff_s FROM seg1 WHERE is_gap AND diff_s >= {P_ * 60}")
def calibration_gaps(spark, sf_dir):
    rows = segmented(spark, sf_dir)
    return rows.filter(outage_ends(rows, P_).isNotNull()).select("user_id", "event_id", "diff_s")


@query(_K + "SELECT event_id, sequence_id FROM marked WHERE NOT purged")
def post_calibration_purge(spark, sf_dir):
    return purged(spark, sf_dir).select("event_id", SEQUENCE)


@query(_K + "SELECT user_id, event_id, sequence_id FROM seg2")
def resequence_after_purge(spark, sf_dir):
    return resegmented(spark, sf_dir).select("user_id", "event_id", SEQUENCE)


# ---- gap fill ----


@query(_K + "SELECT event_id, small_gap, points FROM census")
def small_gap_census(spark, sf_dir):
    return gap_census(resegmented(spark, sf_dir), KEYED, E_, M_).select("event_id", "small_gap", F.col("points").cast("long").alias("points"))


_FILLED = f"SELECT user_id, sequence_id, {_TEXT} AS time, event_type, glucose, insulin, carb FROM "


def _shown(df: DataFrame) -> DataFrame:
    return df.select("user_id", SEQUENCE, time_text(TS).alias("time"), EVENT, GLUCOSE, INSULIN, CARB)


@query(_K + _FILLED + "filled WHERE event_type = 'Interpolated'")
def gap_fill_rows(spark, sf_dir):
    return _shown(filled(spark, sf_dir).filter("generated"))


@query(_K + _FILLED + "filled")
def gap_fill_full(spark, sf_dir):
    return _shown(filled(spark, sf_dir))


# ---- selection and output ----


@query(_K + _FILLED + f"filled WHERE (user_id, sequence_id) IN (SELECT (user_id, sequence_id) FROM filled GROUP BY user_id, sequence_id HAVING count(*) >= {N_})")
def length_filter_window(spark, sf_dir):
    return _shown(of_length_by_window(filled(spark, sf_dir), KEYED, N_))


@query(_K + _FILLED + f"filled WHERE (user_id, sequence_id) IN (SELECT (user_id, sequence_id) FROM filled GROUP BY user_id, sequence_id HAVING count(*) >= {N_})")
def length_filter_semi(spark, sf_dir):
    return _shown(of_length_by_join(filled(spark, sf_dir), KEYED, N_))


@query(_K + f"SELECT user_id, sequence_id, {_TEXT} AS time, glucose FROM kept WHERE glucose IS NOT NULL")
def value_only_rows(spark, sf_dir):
    return value_only(kept(spark, sf_dir)).select("user_id", SEQUENCE, time_text(TS).alias("time"), GLUCOSE)


_NAMES = FILE_COLUMNS
_ML = f'sequence_id, {_TEXT} AS "{_NAMES["ts_text"]}", event_type AS "{_NAMES[EVENT]}", glucose AS "{_NAMES[GLUCOSE]}", insulin AS "{_NAMES[INSULIN]}", carb AS "{_NAMES[CARB]}" FROM kept'


@query(_K + "SELECT user_id, " + _ML)
def full_pipeline(spark, sf_dir):
    rows = segment(cleaned(spark, sf_dir), KEYED, M_, outages=(P_, H_)).filter("not purged").drop("purged")
    rows = segment(rows, KEYED, M_, carry=(GLUCOSE, INSULIN, CARB))
    return ml_columns(of_length(fill_gaps(rows, KEYED, E_, M_, nan_glucose=False), KEYED, N_), KEYED)


@query(_U + "SELECT " + _ML)
def full_pipeline_unkeyed(spark, sf_dir):
    rows = segment(cleaned(spark, sf_dir), SINGLE, 15, outages=(30, 2)).filter("not purged").drop("purged")
    rows = segment(rows, SINGLE, 15, carry=(GLUCOSE, INSULIN, CARB))
    return ml_columns(of_length(fill_gaps(rows, SINGLE, 5, 15, nan_glucose=False), SINGLE, 30), SINGLE)


@query(_K + f'SELECT sequence_id, {_TEXT} AS "{_NAMES["ts_text"]}", glucose AS "{_NAMES[GLUCOSE]}" FROM kept WHERE glucose IS NOT NULL')
def ml_projection_glucose_only(spark, sf_dir):
    return ml_columns(value_only(kept(spark, sf_dir)))


# ---- statistics ----


@query(_K + "SELECT user_id, sequence_id, count(*) AS length FROM seg2 GROUP BY ALL")
def seq_length_counts(spark, sf_dir):
    return lengths(resegmented(spark, sf_dir), KEYED)


@query(_K + """, n AS (SELECT count(*) AS length FROM kept GROUP BY user_id, sequence_id)
    SELECT count(*) AS count, round(avg(length), 6) AS mean, round(stddev_pop(length), 6) AS std, min(length) AS min, quantile_cont(length, 0.25) AS p25,
    quantile_cont(length, 0.5) AS p50, quantile_cont(length, 0.75) AS p75, max(length) AS max FROM n""")
def seq_length_summary(spark, sf_dir):
    found = stats.length_summary(lengths(kept(spark, sf_dir), KEYED))
    return found.withColumns({c: F.round(c, 6) for c in ("mean", "std")})


@query(_K + ", n AS (SELECT count(*) AS length FROM kept GROUP BY user_id, sequence_id) SELECT length, count(*) AS sequences FROM n GROUP BY length")
def seq_length_histogram(spark, sf_dir):
    return lengths(kept(spark, sf_dir), KEYED).groupBy("length").agg(F.count("*").alias("sequences"))


@query(_K + """SELECT round((1 - count(*) FILTER (glucose IS NULL) / count(*)) * 100, 6) AS glucose, round((1 - count(*) FILTER (insulin IS NULL) / count(*)) * 100, 6) AS insulin,
    round((1 - count(*) FILTER (carb IS NULL) / count(*)) * 100, 6) AS carb, count(*) FILTER (event_type = 'Interpolated') AS interpolated FROM kept""")
def completeness(spark, sf_dir):
    percent = [F.round(stats.completeness(c), 6).alias(c) for c in (GLUCOSE, INSULIN, CARB)]
    return kept(spark, sf_dir).agg(*percent, F.count_if(F.col(EVENT) == INTERPOLATED).alias("interpolated"))


@query(_K + f"SELECT min({_TEXT}) AS start, max({_TEXT}) AS end FROM kept")
def date_range(spark, sf_dir):
    return kept(spark, sf_dir).agg(F.min(time_text(TS)).alias("start"), F.max(time_text(TS)).alias("end"))


@query(_K + "SELECT count(*) AS sequences FROM (SELECT DISTINCT user_id, sequence_id FROM seg2)")
def distinct_sequences_nullaware(spark, sf_dir):
    return resegmented(spark, sf_dir).agg(stats.distinct_with_null("user_id", SEQUENCE).alias("sequences"))


@query(_K + ", o AS (SELECT user_id, count(*) FILTER (is_gap) AS g, max(sequence_id) + 1 AS s FROM seg2 GROUP BY user_id) SELECT CAST(sum(g) AS BIGINT) AS total_gaps, CAST(sum(s) AS BIGINT) AS total_sequences FROM o")
def gap_summary(spark, sf_dir):
    return stats.gap_counts(resegmented(spark, sf_dir), KEYED)


@query(_K + f"SELECT count(*) FILTER (is_gap AND diff_s >= {P_ * 60}) AS outages, count(*) FILTER (purged) AS purged, count(DISTINCT CASE WHEN purged THEN (user_id, coalesce(sequence_id, -1)) END) AS affected FROM marked")
def outage_summary(spark, sf_dir):
    rows = after_outage(segmented(spark, sf_dir), KEYED, P_, H_)
    return rows.agg(F.count(outage_ends(rows, P_)).alias("outages"), F.count_if("purged").alias("purged"), F.count_distinct(F.when(F.col("purged"), F.struct("user_id", SEQUENCE))).alias("affected"))


@query(_K + """SELECT count(*) FILTER (small_gap) AS small_gaps_filled, CAST(sum(points) AS BIGINT) AS total_interpolated_data_points,
    CAST(sum(CASE WHEN (glucose IS NOT NULL AND p_glucose IS NOT NULL) OR (insulin IS NOT NULL AND p_insulin IS NOT NULL) OR (carb IS NOT NULL AND p_carb IS NOT NULL) THEN points ELSE 0 END) AS BIGINT) AS total_interpolations,
    CAST(sum(CASE WHEN glucose IS NOT NULL AND p_glucose IS NOT NULL THEN points ELSE 0 END) AS BIGINT) AS glucose,
    CAST(sum(CASE WHEN insulin IS NOT NULL AND p_insulin IS NOT NULL THEN points ELSE 0 END) AS BIGINT) AS insulin,
    CAST(sum(CASE WHEN carb IS NOT NULL AND p_carb IS NOT NULL THEN points ELSE 0 END) AS BIGINT) AS carb FROM census""")
def interpolation_summary(spark, sf_dir):
    return stats.fill_counts(resegmented(spark, sf_dir), KEYED, E_, M_, nan_glucose=False)


@query("""SELECT count(*) FILTER (value >= 200) AS high, count(*) FILTER (value < 5) AS low FROM events WHERE event_type NOT IN ('purchase', 'signup')""")
def replacement_summary(spark, sf_dir):
    return events(spark, sf_dir).agg(F.count_if(F.col(GLUCOSE) == HIGH).alias("high"), F.count_if(F.col(GLUCOSE) == LOW).alias("low"))


@query(_K + f"SELECT user_id, sequence_id, {_TEXT} AS time, glucose FROM kept ORDER BY user_id, sequence_id, ts, event_id LIMIT 10")
def preview_top10(spark, sf_dir):
    """The first rows of the result: the limit is the feature."""
    rows = kept(spark, sf_dir).orderBy("user_id", SEQUENCE, TS, "event_id").limit(10)
    return rows.select("user_id", SEQUENCE, time_text(TS).alias("time"), GLUCOSE)
