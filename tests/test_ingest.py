"""Taking drops into the raw zone, and the whole run from drops to warehouse."""

from __future__ import annotations

import csv
import datetime as dt
import logging
import os
import time

import pytest
from pyspark.sql import functions as F

from tests.helpers import SF_SMALL
from tests.test_sources import write_csv
from txnstar import PipelineConfig, create_warehouse, ingest_landing, read_raw_zone, run_pipeline
from txnstar import run_transform
from txnstar.plans.fixture import raw_transactions
from txnstar.schema import RAW_COLUMNS
from txnstar.sources.store import Store
from txnstar.streaming import ingest
from txnstar.streaming.ingest import refused_files


class Zone:
    def __init__(self, spark, base):
        self.spark, self.base = spark, base
        self.landing, self.raw, self.archive = base / "landing", base / "raw", base / "processed"
        self.landing.mkdir()

    def run(self, day="2025-01-01", **options):
        return ingest_landing(
            self.spark,
            str(self.landing),
            str(self.raw),
            str(self.base / "checkpoint"),
            self.archive and str(self.archive),
            day,
            **options,
        )

    def rows(self):
        return read_raw_zone(self.spark, str(self.raw))

    def ids(self):
        return sorted(r.TransactionID for r in self.rows().collect())


@pytest.fixture
def zone(spark, tmp_path):
    return Zone(spark, tmp_path)


def test_empty_landing_is_a_no_op(zone, caplog):
    with caplog.at_level(logging.WARNING):
        assert zone.run() is False
    assert "no new files" in caplog.text
    assert zone.ids() == []
    assert zone.rows().columns == [*RAW_COLUMNS, "ingest_date"]


def test_each_file_is_taken_once(zone):
    write_csv(zone.landing / "a.csv", {"TransactionID": "T1"}, {"TransactionID": "T2"})
    write_csv(zone.landing / "notes.txt", {"TransactionID": "T9"})
    assert zone.run() is True
    assert zone.ids() == ["T1", "T2"]
    zone.run()
    assert zone.ids() == ["T1", "T2"]
    write_csv(zone.landing / "b.csv", {"TransactionID": "T3"})
    assert zone.run("2025-01-02") is True
    assert zone.ids() == ["T1", "T2", "T3"]
    days = {r.TransactionID: r.ingest_date for r in zone.rows().collect()}
    assert (days["T1"], days["T3"]) == (dt.date(2025, 1, 1), dt.date(2025, 1, 2))


def test_equal_rows_all_arrive(zone):
    write_csv(zone.landing / "a.csv", {}, {})
    write_csv(zone.landing / "b.csv", {})
    zone.run()
    assert zone.rows().count() == 3


def test_today_by_default(zone):
    write_csv(zone.landing / "a.csv", {})
    before = dt.datetime.now(dt.timezone.utc).date()
    zone.run(day=None)
    after = dt.datetime.now(dt.timezone.utc).date()
    assert before <= zone.rows().first().ingest_date <= after


def test_archive_holds_what_was_read(zone):
    for day, name in enumerate("abc", 1):
        write_csv(zone.landing / f"{name}.csv", {"TransactionID": f"T{day}"})
        zone.run(f"2025-01-0{day}")
        assert list(zone.landing.glob("*.csv")) == []
    assert sorted(p.name for p in zone.archive.rglob("*.csv")) == ["a.csv", "b.csv", "c.csv"]
    assert zone.ids() == ["T1", "T2", "T3"]


def test_a_name_sent_again_with_other_content_is_taken_again(zone):
    for archive in (zone.archive, None):
        zone.archive = archive
        for n in range(2):
            name = f"{'kept' if archive is None else 'moved'}{n}"
            write_csv(zone.landing / "daily.csv", {"TransactionID": name})
            os.utime(zone.landing / "daily.csv", (1_700_000_000 + n, 1_700_000_000 + n))
            assert zone.run() is True
            assert zone.run() is False
    assert zone.ids() == ["kept0", "kept1", "moved0", "moved1"]
    contents = sorted(p.read_text().split("\n")[1][:6] for p in (zone.base / "processed").rglob("*.csv"))
    assert contents == ["moved0", "moved1"]


def test_files_of_any_age_are_taken(zone):
    write_csv(zone.landing / "a.csv", {"TransactionID": "T1"})
    zone.run()
    for n, age in enumerate((1, 30, 4000)):
        path = zone.landing / f"late{n}.csv"
        write_csv(path, {"TransactionID": f"L{n}"})
        then = time.time() - age * 86_400
        os.utime(path, (then, then))
    zone.run()
    assert zone.ids() == ["L0", "L1", "L2", "T1"]


def test_a_file_put_back_in_the_landing_folder_is_not_taken_twice(zone):
    write_csv(zone.landing / "a.csv", {"TransactionID": "T1"})
    zone.archive = None
    zone.run()
    zone.run()
    assert zone.ids() == ["T1"]


@pytest.mark.parametrize("broken", ["_write", "put_away"])
def test_a_crash_loses_and_repeats_nothing(zone, monkeypatch, broken):
    write_csv(zone.landing / "a.csv", {"TransactionID": "T1"})
    write = getattr(ingest._Zone, broken)

    def crash(self, *args):
        if broken == "_write":
            write(self, *args)  # the data are there, the note that they are is not
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(ingest._Zone, broken, crash)
        with pytest.raises(OSError):
            zone.run()
    write_csv(zone.landing / "b.csv", {"TransactionID": "T2"})
    zone.run("2025-01-02")
    assert zone.ids() == ["T1", "T2"]
    days = {r.TransactionID: str(r.ingest_date) for r in zone.rows().collect()}
    assert days == {"T1": "2025-01-01", "T2": "2025-01-02"}
    assert sorted(p.name for p in zone.archive.rglob("*.csv")) == ["a.csv", "b.csv"]


def _crashed(zone, monkeypatch):
    with monkeypatch.context() as patch:
        patch.setattr(ingest._Zone, "_write", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            zone.run()


def test_a_file_that_changes_under_an_unfinished_batch_is_taken_as_it_is(zone, monkeypatch, caplog):
    write_csv(zone.landing / "a.csv", {"TransactionID": "T1"})
    write_csv(zone.landing / "b.csv", {"TransactionID": "T9"})
    _crashed(zone, monkeypatch)
    write_csv(zone.landing / "a.csv", {"TransactionID": "T2"}, {"TransactionID": "T3"})
    with caplog.at_level(logging.WARNING):
        assert zone.run() is True
    assert "changed or went" in caplog.text
    assert zone.ids() == ["T2", "T3", "T9"]
    assert zone.run() is False


def test_a_file_that_went_under_an_unfinished_batch_holds_nothing_up(zone, monkeypatch):
    write_csv(zone.landing / "a.csv", {"TransactionID": "T1"})
    write_csv(zone.landing / "b.csv", {"TransactionID": "T2"})
    _crashed(zone, monkeypatch)
    text = (zone.landing / "a.csv").read_text()
    (zone.landing / "a.csv").unlink()
    assert zone.run() is True
    assert zone.ids() == ["T2"]
    (zone.landing / "a.csv").write_text(text)
    assert zone.run() is True
    assert zone.ids() == ["T1", "T2"]


def test_a_file_that_changes_while_it_is_read_is_taken_once(zone, monkeypatch):
    write_csv(zone.landing / "a.csv", {"TransactionID": "T1"})
    write_csv(zone.landing / "b.csv", {"TransactionID": "T2"})
    write, calls = ingest._Zone._write, []

    def overtaken(self, *args):
        found = write(self, *args)
        if not calls:
            write_csv(zone.landing / "a.csv", {"TransactionID": "T1"}, {"TransactionID": "T5"})
        calls.append(1)
        return found

    monkeypatch.setattr(ingest._Zone, "_write", overtaken)
    assert zone.run() is True
    assert zone.ids() == ["T1", "T2", "T5"] and len(calls) == 2


def test_rows_with_a_wrong_number_of_fields_are_set_apart(zone, caplog):
    write_csv(zone.landing / "a.csv", {"TransactionID": "T1"})
    path = zone.landing / "a.csv"
    path.write_text(path.read_text() + "T2,too,few\n" + ",".join(["T3"] * 17) + "\n")
    with caplog.at_level(logging.WARNING):
        zone.run()
    assert zone.ids() == ["T1"]
    assert "2 rows" in caplog.text
    refused = zone.spark.read.parquet(f"{zone.raw}/_rejected").collect()
    assert sorted(r._broken_line[:2] for r in refused) == ["T2", "T3"]


def test_absent_landing_folder_is_a_normal_day(zone, caplog):
    zone.landing.rmdir()
    with caplog.at_level(logging.WARNING):
        assert zone.run() is False
    assert "no new files" in caplog.text


def test_an_empty_file_brings_nothing(zone):
    (zone.landing / "a.csv").write_text("")
    write_csv(zone.landing / "b.csv")
    assert zone.run() is False
    assert zone.ids() == []


def test_batches_of_bounded_size(zone):
    for i in range(5):
        write_csv(zone.landing / f"{i}.csv", {"TransactionID": f"T{i}"})
    zone.run(max_bytes_per_trigger=1)
    assert zone.ids() == [f"T{i}" for i in range(5)]


def test_header_in_another_order(zone):
    write_csv(zone.landing / "a.csv", {"Channel": "Branch"}, columns=list(reversed(RAW_COLUMNS)))
    zone.run()
    row = zone.rows().first()
    assert (row.TransactionID, row.Channel) == ("T1", "Branch")


@pytest.mark.parametrize("archived", [True, False])
def test_headers_change_from_day_to_day(zone, archived):
    if not archived:
        zone.archive = None
    write_csv(zone.landing / "a.csv", {"TransactionID": "T1"})
    zone.run()
    columns = [*reversed(RAW_COLUMNS), "Note"]
    write_csv(zone.landing / "b.csv", {"TransactionID": "T2", "Note": "x"}, columns=columns)
    zone.run("2025-01-02")
    write_csv(zone.landing / "c.csv", {"TransactionID": "T3"})
    zone.run("2025-01-03")
    rows = {r.TransactionID: r for r in zone.rows().collect()}
    assert {k: r.Note for k, r in rows.items()} == {"T1": None, "T2": "x", "T3": None}
    assert {r.Channel for r in rows.values()} == {"ATM"}
    assert zone.rows().columns == [*RAW_COLUMNS, "Note", "ingest_date"]


def test_names_that_differ_in_case_are_one_column(zone):
    write_csv(zone.landing / "a.csv", {"TransactionID": "T1", "Note": "x"}, columns=[*RAW_COLUMNS, "Note"])
    write_csv(zone.landing / "b.csv", {"TransactionID": "T2", "NOTE": "y"}, columns=[*RAW_COLUMNS, "NOTE"])
    zone.run()
    write_csv(zone.landing / "c.csv", {"TransactionID": "T3", "note": "z"}, columns=[*RAW_COLUMNS, "note"])
    zone.run("2025-01-02")
    assert {(r.TransactionID, r.Note) for r in zone.rows().collect()} == {("T1", "x"), ("T2", "y"), ("T3", "z")}
    assert zone.rows().columns == [*RAW_COLUMNS, "Note", "ingest_date"]


def test_files_of_one_day_may_have_different_headers(zone):
    write_csv(zone.landing / "a.csv", {"TransactionID": "T1"})
    write_csv(zone.landing / "b.csv", {"TransactionID": "T2"}, columns=list(reversed(RAW_COLUMNS)))
    write_csv(zone.landing / "c.csv", {"TransactionID": "T3", "X": "9"}, columns=["X", *RAW_COLUMNS])
    zone.run()
    assert {(r.TransactionID, r.Channel, r.X) for r in zone.rows().collect()} == {
        ("T1", "ATM", None), ("T2", "ATM", None), ("T3", "ATM", "9"),
    }


BAD_HEADERS = {
    "missing": (RAW_COLUMNS[1:], "columns that are missing: TransactionID"),
    "twice": ([*RAW_COLUMNS, "Note", "Note"], "columns that appear more than once: note"),
    "twice_by_case": ([*RAW_COLUMNS, "channel"], "columns that appear more than once: channel"),
    "blanks": ([f" {c}" for c in RAW_COLUMNS], "blanks around them:  TransactionID"),
    "nameless": ([*RAW_COLUMNS, ""], "column names that are empty"),
    "foreign": (["X", "Y"], "columns that are missing: TransactionID, AccountID"),
    "own": ([*RAW_COLUMNS, "Batch"], "names that the raw zone uses itself: batch"),
}


@pytest.mark.parametrize("kind", BAD_HEADERS)
def test_a_bad_file_is_refused_and_holds_up_no_other(zone, spark, caplog, kind):
    columns, reason = BAD_HEADERS[kind]
    bad = zone.landing / "b.csv"
    bad.write_text(",".join(columns) + "\n" + ",".join("x" for _ in columns) + "\n")
    write_csv(zone.landing / "a.csv", {"TransactionID": "T1"})
    write_csv(zone.landing / "c.csv", {"TransactionID": "T2"})
    with caplog.at_level(logging.WARNING):
        assert zone.run() is True
    assert reason in caplog.text
    assert zone.ids() == ["T1", "T2"]
    refused = refused_files(spark, str(zone.base / "checkpoint")).collect()
    assert [(r.path.split("/")[-1], reason in r.reason) for r in refused] == [("b.csv", True)]
    assert [p.name for p in zone.landing.glob("*.csv")] == ["b.csv"]
    assert zone.run() is False  # neither taken nor reported again
    bad.unlink()
    write_csv(zone.landing / "d.csv", {"TransactionID": "T3"})
    assert zone.run() is True
    write_csv(bad, {"TransactionID": "T4"})  # mended under its name
    assert zone.run() is True
    assert zone.ids() == ["T1", "T2", "T3", "T4"]


def test_only_bad_files(zone):
    (zone.landing / "a.csv").write_text("X\n1\n")
    assert zone.run() is False
    assert zone.run() is False
    assert zone.ids() == []


HEADER_LINES = [
    "A,B", '"A","B b"', '"a ""q"" z",B', '"x,y",z', "", "   ", "A", "A,", "A,,B", '"",A', "é,ß",
]


def test_header_names_are_what_a_csv_reader_reads(spark):
    df = spark.createDataFrame([(x,) for x in HEADER_LINES], "line string")
    found = df.select("line", ingest.header_names(F.col("line")).alias("names")).collect()
    for r in found:
        expected = next(csv.reader([r.line]), []) if r.line.strip() else []
        assert r.names == expected, r.line


@pytest.mark.parametrize("limit", [ingest.CONTENT_BYTES, 10])
def test_headers_after_marks_and_blank_lines(zone, monkeypatch, limit):
    monkeypatch.setattr(ingest, "CONTENT_BYTES", limit)  # larger files are opened by the driver
    write_csv(zone.landing / "a.csv", {"TransactionID": "T1"})
    text = (zone.landing / "a.csv").read_text()
    (zone.landing / "b.csv").write_bytes(b"\xef\xbb\xbf" + text.replace("T1", "T2").encode())
    (zone.landing / "c.csv").write_text("\n" + text.replace("T1", "T3"))
    (zone.landing / "d.csv").write_bytes(text.replace("T1", "T4").replace("\n", "\r\n").encode())
    zone.run()
    assert zone.ids() == ["T1", "T2", "T3", "T4"]


def _calls(monkeypatch):
    """Counts the driver's calls to the file store."""
    made = []
    for name in ("exists", "names", "size", "delete", "touch", "move", "rename", "first_line", "qualified"):
        real = getattr(Store, name)

        def counted(self, *args, real=real, name=name):
            made.append(name)
            return real(self, *args)

        monkeypatch.setattr(Store, name, counted)
    return made


def test_the_drivers_calls_do_not_grow_with_the_files(spark, tmp_path, monkeypatch):
    made, counts = _calls(monkeypatch), []
    for files in (3, 60):
        base = tmp_path / str(files)
        base.mkdir()
        zone = Zone(spark, base)
        for n in range(files):
            write_csv(zone.landing / f"{n:03}.csv", {"TransactionID": f"T{n}"})
        made.clear()
        zone.run()
        counts.append(sorted(made))
        assert zone.rows().count() == files
        assert len(list(zone.archive.rglob("*.csv"))) == files
        assert list(zone.landing.glob("*.csv")) == []
    assert counts[0] == counts[1]


def test_files_of_a_batch_are_found_in_few_tasks(zone, spark):
    """Spark gives each of many named files a task of its own to find it in."""
    for n in range(100):
        write_csv(zone.landing / f"drop-{n}.csv", {"TransactionID": f"T{n}"})
    before = spark.conf.get(ingest.LISTING)
    spark.sparkContext.setJobGroup("files", "")
    try:
        assert zone.run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    status = spark.sparkContext.statusTracker()
    stages = [s for j in status.getJobIdsForGroup("files") for s in status.getJobInfo(j).stageIds]
    tasks = [status.getStageInfo(s).numTasks for s in stages if status.getStageInfo(s)]
    assert max(tasks) <= ingest.LISTING_TASKS * spark.sparkContext.defaultParallelism
    assert spark.conf.get(ingest.LISTING) == before


@pytest.mark.parametrize("archived", [True, False])
def test_a_compacted_ledger_still_knows_every_file(zone, spark, monkeypatch, archived):
    monkeypatch.setattr(ingest, "COMPACT_AFTER", 2)
    if not archived:
        zone.archive = None
    (zone.landing / "bad.csv").write_text("X\n1\n")
    for n in range(5):
        write_csv(zone.landing / f"{n}.csv", {"TransactionID": f"T{n}"})
        assert zone.run() is True
        assert zone.run() is False
    state = zone.base / "checkpoint"
    assert len([p for p in (state / "files").iterdir() if p.is_dir()]) < 2
    assert len([p for p in (state / "snapshots").iterdir() if p.is_dir()]) == 1
    assert zone.ids() == [f"T{n}" for n in range(5)]
    assert refused_files(spark, str(state)).count() == 1


def test_a_crash_while_the_ledger_is_compacted(zone, monkeypatch):
    monkeypatch.setattr(ingest, "COMPACT_AFTER", 2)
    zone.archive = None
    for n in range(2):
        write_csv(zone.landing / f"{n}.csv", {"TransactionID": f"T{n}"})
        with monkeypatch.context() as patch:
            if n:
                patch.setattr(Store, "delete", lambda *args: 1 / 0)
                with pytest.raises(ZeroDivisionError):
                    zone.run()
            else:
                zone.run()
    assert zone.run() is False
    write_csv(zone.landing / "2.csv", {"TransactionID": "T2"})
    assert zone.run() is True
    assert zone.ids() == ["T0", "T1", "T2"]


def test_transform_of_an_empty_zone(zone, spark):
    zone.run()
    audit = run_transform(spark, str(zone.raw), str(zone.base / "staged"), "parquet")
    assert {r.row_count for r in audit.collect()} == {0}


def test_whole_run(zone, spark):
    target = "warehouse_whole_run"
    create_warehouse(spark, target, f"file:{zone.base}/tables")
    cfg = PipelineConfig(
        landing=str(zone.landing),
        raw_root=str(zone.raw),
        checkpoint=str(zone.base / "checkpoint"),
        staged_root=str(zone.base / "staged"),
        target=target,
        archive=str(zone.archive),
    )
    raw_transactions(spark, SF_SMALL).write.mode("append").option("header", True).csv(cfg.landing)
    for _ in range(2):  # a second run finds no new file and changes nothing
        audit = {r.stage: r.row_count for r in run_pipeline(spark, cfg).collect()}
        assert audit == {
            "raw": 1530,
            "deduplicated": 1500,
            "required": 1395,
            "clean": 1321,
            "dim_date": 1001,
            "dim_account": 150,
            "dim_merchant": 90,
            "dim_transaction_type": 3,
            "fact_transactions": 1321,
            "null_dates": 74,
            "loaded_dim_date": 1001,
            "loaded_dim_account": 150,
            "loaded_dim_merchant": 90,
            "loaded_dim_transaction_type": 3,
            "loaded_fact_transactions": 1321,
        }
        assert spark.table(f"{target}.FACT_TRANSACTIONS").count() == 1321
    spark.sql(f"DROP DATABASE {target} CASCADE")


def test_whole_run_stops_at_the_first_failure(zone, spark, monkeypatch):
    write_csv(zone.landing / "a.csv", {})
    monkeypatch.setattr(ingest._Zone, "_write", lambda *args: 1 / 0)
    cfg = PipelineConfig(
        landing=str(zone.landing),
        raw_root=str(zone.raw),
        checkpoint=str(zone.base / "checkpoint"),
        staged_root=str(zone.base / "staged"),
        target="no_such_database",
    )
    with pytest.raises(ZeroDivisionError):
        run_pipeline(spark, cfg)
    assert not (zone.base / "staged").exists()
