"""CSV folders, sinks, the command line and the catalogue."""

import json

import duckdb
import pytest

import __spark_entry__
from gapweave import catalog, catalog_io, cli, report
from gapweave.config import Config
from gapweave.plans import process
from gapweave.sources import files, read_folder
from gapweave.sources.files import first_record
from gapweave.streaming import sequence_sessions

T, E, G, I, C = "Timestamp (YYYY-MM-DDThh:mm:ss)", "Event Type", "Glucose Value (mg/dL)", "Insulin Value (u)", "Carb Value (grams)"


def rows_of(spark, folder, **more):
    return [(r["ts_text"], r["event_type"], r["glucose"], r["insulin"], r["carb"]) for r in read_folder(spark, str(folder), **more).orderBy("ts", "src_file", "src_block", "src_pos").collect()]


def test_reader(spark, tmp_path):
    head = f"Index,{T},{E},{G},{I},{C}\n"
    (tmp_path / "a.csv").write_text(
        "﻿" + head + '1,2019-10-28T00:00:01,EGV,"1""0",,\n2,2019-10-28T00:00:02,"E\nGV",5,,\n3, \t2019-10-28T00:00:03\xa0,EGV,High,1.5,30\n4,2019-10-28T00:00:04\n5,2019-10-28T00:00:05,EGV,7,,,extra\n6,,EGV,1,,\n7,nonsense,EGV,1,,\n8,2019-10-28T00:00:06.5,EGV,1,,\n',
        encoding="utf-8",
    )
    (tmp_path / "b.csv").write_text(f"{G},{T},{E}\n9,2019-10-28 00:00:07,EGV\n", encoding="utf-8")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "c.csv").write_text(head + "1,2019-10-28T00:00:08,EGV,1,,\n")
    for name in ("U.CSV", ".h.csv", "_u.csv"):
        (tmp_path / name).write_text(head + "1,2019-10-28T00:00:09,EGV,1,,\n")
    assert rows_of(spark, tmp_path) == [
        ("2019-10-28T00:00:01", "EGV", '1"0', "", ""), ("2019-10-28T00:00:02", "E\nGV", "5", "", ""), ("2019-10-28T00:00:03", "EGV", "High", "1.5", "30"),
        ("2019-10-28T00:00:04", "", "", "", ""), ("2019-10-28T00:00:05", "EGV", "7", "", ""), ("2019-10-28 00:00:07", "EGV", "9", "", ""),
    ]


def test_reader_refuses(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_folder(spark, str(tmp_path / "none"))
    (tmp_path / "x.csv").write_text(f"{T},{E}\n,EGV\nnever,EGV\n")
    with pytest.raises(ValueError):
        read_folder(spark, str(tmp_path / "x.csv"))
    with pytest.raises(ValueError):
        read_folder(spark, str(tmp_path))
    (tmp_path / "empty").mkdir()
    with pytest.raises(ValueError):
        read_folder(spark, str(tmp_path / "empty"))


def test_headers_of_many_lines(spark, tmp_path):
    row = "2019-10-28T00:00:01,x,EGV,5"
    (tmp_path / "a.csv").write_text(f'{T},"a\nb ""c"",\r\nd",{E},{G}\n{row}\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text(f'"{T}","{"long " * 9_000}\n",{E},{G}\n{row}\n', encoding="utf-8")
    (tmp_path / "c.csv").write_bytes(f"{T},\r\n".encode() + b"\x80")
    (tmp_path / "d.csv").write_bytes(b"\x80" + f"{T},{E}\n{row}\n".encode())
    (tmp_path / "e.csv").write_text(f"{T},x,{E},{G}", encoding="utf-8")
    assert first_record(spark, str(tmp_path / "a.csv"))[1] == 'a\nb "c",\r\nd'
    assert first_record(spark, str(tmp_path / "b.csv"), chunk=7)[2:] == [E, G]
    assert rows_of(spark, tmp_path) == [("2019-10-28T00:00:01", "EGV", "5", "", "")] * 2


def test_large_files_are_split_unless_lines_break_in_quotes(spark, tmp_path):
    lines = [f"2020-01-01 00:00:00.{n:06d},EGV,{n}" for n in range(3_000)]
    (tmp_path / "a.csv").write_text("\n".join([f"{T},{E},{G}", *lines]))
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.csv").write_text("\n".join([f"{T},{E},{G}", *lines, '2020-01-02 00:00:00,"E\nGV",7']))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        rows = read_folder(spark, str(tmp_path))
        assert rows.rdd.getNumPartitions() > 4
        order = [r["glucose"] for r in rows.orderBy("src_file", "src_block", "src_pos").collect()]
        assert order == [str(n) for n in range(3_000)]
        whole = read_folder(spark, str(tmp_path / "sub"))
        assert whole.rdd.getNumPartitions() == 1 and whole.count() == 3_001 and whole.filter("event_type = 'E\nGV'").count() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def test_a_cluster_needs_a_shared_folder():
    class Cluster:
        class sparkContext:
            master = "spark://host:7077"
            getConf = staticmethod(lambda: {})

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        files.scratch(Cluster, "x")


def test_unreadable_files_are_left_out_and_logged(spark, folder, caplog, monkeypatch):
    (folder / "in" / "b.csv").write_text((folder / "in" / "a.csv").read_text())
    real = files.first_record
    monkeypatch.setattr(files, "first_record", lambda spark, path: (_ for _ in ()).throw(OSError("gone")) if path.endswith("b.csv") else real(spark, path))
    with caplog.at_level("INFO"):
        assert read_folder(spark, str(folder / "in")).count() == 8
    assert "b.csv" in caplog.text and "1 left out" in caplog.text


def test_progress_is_logged_and_nothing_stays_in_memory(spark, folder, caplog):
    with caplog.at_level("INFO"):
        process(spark, str(folder / "in"), str(folder / "out.csv"), Config(min_sequence_len=3))
    assert all(f"step {n}" in caplog.text for n in range(1, 9)) and "out.csv" in caplog.text
    assert spark._jsc.getPersistentRDDs().isEmpty()


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    lines = [f"2020-01-01T{m // 60:02d}:{m % 60:02d}:00,EGV,{100 + m},," for m in (0, 5, 10, 20, 25, 60, 65, 70)]
    (tmp_path / "in" / "a.csv").write_text("\n".join([f"{T},{E},{G},{I},{C}", *lines]))
    return tmp_path


def test_process_writes_single_files(spark, folder):
    config = Config(min_sequence_len=3, save_intermediate_files=True, intermediate_dir=str(folder / "steps"))
    out, tree = process(spark, str(folder / "in"), str(folder / "out.csv"), config)
    lines = (folder / "out.csv").read_text().splitlines()
    assert lines[0] == f"sequence_id,{T},{E},{G},{I},{C}"
    assert lines[1] == "0,2020-01-01T00:05:00,EGV,105.0,," and "0,2020-01-01T00:15:00,Interpolated,115.0,," in lines
    assert len(lines) - 1 == out.count() == tree["dataset_overview"]["total_records"] == 8
    names = {p.name for p in (folder / "steps").glob("*.csv")}
    assert names == {"consolidated_data.csv", "step2_high_low_replaced.csv", "step3_calibrations_removed.csv", "step4_sequences_created.csv", "step5_interpolated_values.csv", "step6_filtered_sequences.csv", "step8_ml_ready.csv"}
    assert (folder / "steps" / "step8_ml_ready.csv").read_text().splitlines() == lines
    json.dumps(tree, default=str)
    text = report.full(tree, config)
    assert "points made: 1" in text and "Parameters" in text


def test_command_line(spark, folder, capsys, monkeypatch):
    monkeypatch.chdir(folder)
    (folder / "c.yaml").write_text("min_sequence_len: 100\nsmall_gap_max_minutes: 15\n")
    args = cli.parser().parse_args(["in", "--config", "c.yaml", "-l", "3", "--glucose-only", "--keep-calibration", "-c", "99"])
    c = cli.configuration(args)
    assert (c.min_sequence_len, c.glucose_only, c.remove_calibration, c.calibration_period_minutes, c.small_gap_max_minutes) == (3, True, False, 99, 15)
    assert cli.configuration(cli.parser().parse_args(["in"])) == Config()
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    assert cli.main(["in", "-l", "3", "-o", "o.csv", "-v"]) == 0
    out = capsys.readouterr().out
    assert "8 records in 2 sequences" in out and "Quality" in out and (folder / "o.csv").exists()
    assert cli.main(["in", "-l", "3", "-o", "o.csv", "--no-stats"]) == 0
    (folder / "in").rename(folder / "000-csv")
    capsys.readouterr()
    assert cli.main(["-l", "3", "--no-stats"]) == 0 and (folder / "glucose_ml_ready.csv").exists()
    lines = capsys.readouterr().out.splitlines()
    assert lines[:3] == ["8 records in 2 sequences", "written to glucose_ml_ready.csv", "0, 2020-01-01T00:05:00, EGV, 105.0, , "] and len(lines) == 10
    assert cli.main(["nowhere"]) == 1 and "nowhere" in capsys.readouterr().err


def test_stream_sessions(spark, sf_dir, tmp_path):
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("cast(ts as timestamp) ts", "user_id")
    rows.repartition(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    done = sequence_sessions(stream, ("user_id",), 720).writeStream.outputMode("complete").format("memory").queryName("sessions").start()
    done.processAllAvailable()
    done.stop()
    want = duckdb.sql(f"""WITH d AS (SELECT user_id, ts, coalesce(epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) >= 43201000000, false) g FROM '{sf_dir}/events.parquet'),
        s AS (SELECT *, sum(g::int) OVER (PARTITION BY user_id ORDER BY ts) i FROM d) SELECT user_id, count(*) FROM s GROUP BY user_id, i""").fetchall()
    assert sorted((r["user_id"], r["rows"]) for r in spark.table("sessions").collect()) == sorted(want)


def stream_sessions_and_sql(spark, folder, events, sql_events=None):
    """What the query gives over a table of events, and what its SQL gives over it, or over another."""
    (folder / "t").mkdir()
    duckdb.sql(f"COPY ({events}) TO '{folder}/t/events.parquet'")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS {sql_events or events}")
    got = catalog_io.QUERIES["stream_sessions"](spark, str(folder / "t")).select("user_id", "start", "end", "rows").collect()
    want = con.sql(f'SELECT user_id, start, "end", rows FROM ({catalog_io.ORACLE_SQL["stream_sessions"]})').fetchall()
    return sorted(map(tuple, got), key=repr), sorted(want, key=repr)


@pytest.mark.parametrize(
    "change",
    [
        "ts - INTERVAL 100 YEAR AS ts",
        "ts - to_days((event_id % 2 * 40000)::INTEGER) AS ts",
        "CASE WHEN event_id % 7 > 0 THEN ts END AS ts",
        "CASE WHEN user_id <> 3 THEN ts END AS ts",
        "CASE WHEN user_id <> 3 THEN user_id END AS user_id",
        "user_id - 3 AS user_id",
    ],
)
def test_stream_sessions_of_odd_rows_equal_sql(spark, sf_dir, tmp_path, change):
    got, want = stream_sessions_and_sql(spark, tmp_path, f"SELECT * REPLACE ({change}) FROM '{sf_dir}/events.parquet'")
    assert got == want and len(got) > 200


def test_stream_sessions_of_copies(spark, sf_dir, tmp_path):
    """Rows of one user and second stay in one sequence. The SQL leaves their order open, so it gets each row once."""
    once = f"SELECT * FROM '{sf_dir}/events.parquet'"
    got, want = stream_sessions_and_sql(spark, tmp_path, f"{once} UNION ALL {once} UNION ALL {once}", once)
    assert got == [(*key, 3 * rows) for *key, rows in want]


ALL, SQL = catalog.QUERIES | catalog_io.QUERIES, catalog.ORACLE_SQL | catalog_io.ORACLE_SQL


@pytest.mark.parametrize("name", sorted(ALL))
def test_catalogue_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{sf_dir}/events.parquet'")
    sql = con.sql(SQL[name])
    got = ALL[name](spark, sf_dir)
    names = sorted(got.columns)
    assert names == sorted(sql.columns)
    want = [dict(zip(sql.columns, r)) for r in sql.fetchall()]
    rows = lambda xs: sorted(tuple(repr(x[n]) for n in names) for x in xs)
    assert rows(r.asDict() for r in got.collect()) == rows(want)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 1900
    assert set(ALL) <= set(__spark_entry__.queries()) and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
