"""CSV scan, staged Parquet, projection for the warehouse, warehouse tables."""

from __future__ import annotations

import csv
import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.helpers import DEFAULTS, SF_SMALL, raw_rows, sorted_rows
from txnstar import (
    clean_transactions,
    create_warehouse,
    load_projection,
    load_star,
    load_table,
    read_raw,
    read_staged,
    run_transform,
    stage_star,
    timestamps_to_text,
    upper_columns,
    write_staged,
)
from txnstar.plans.fixture import raw_transactions
from txnstar.schema import RAW_COLUMNS, STAR_TABLES, warehouse_schema
from txnstar import broken_rows, new_version
from txnstar.plans import jobs, queries, sizing
from txnstar.sources import staged, workdir
from txnstar.sources.store import Store


def write_csv(path, *rows, columns=RAW_COLUMNS):
    path.parent.mkdir(parents=True, exist_ok=True)
    lines = [",".join(columns)]
    lines += [",".join({**DEFAULTS, **row}.get(c, "") for c in columns) for row in rows]
    path.write_text("\n".join(lines) + "\n")


def test_scan_takes_all_folders_as_text(spark, tmp_path):
    write_csv(tmp_path / "date=2025-01-01" / "a.csv", {"TransactionID": "T1"})
    write_csv(tmp_path / "date=2025-01-01" / "b.csv", {"TransactionID": "T2"})
    write_csv(
        tmp_path / "date=2025-01-02" / "c.csv",
        {"TransactionID": "T3", "Channel": "", "CustomerAge": "007"},
    )
    df = read_raw(spark, str(tmp_path))
    assert df.columns == [*RAW_COLUMNS, "ingest_date"]
    assert {f.dataType for f in df.schema if f.name != "ingest_date"} == {T.StringType()}
    rows = {r.TransactionID: r for r in df.collect()}
    assert set(rows) == {"T1", "T2", "T3"}
    assert (rows["T3"].Channel, rows["T3"].CustomerAge) == (None, "007")
    assert rows["T3"].ingest_date == dt.date(2025, 1, 2)


def test_scan_prunes_folders(spark, tmp_path, capsys):
    for day in ("2025-01-01", "2025-01-02"):
        write_csv(tmp_path / f"date={day}" / "a.csv", {"TransactionID": day})
    one_day = read_raw(spark, str(tmp_path)).filter(F.col("ingest_date") == "2025-01-02")
    assert [r.TransactionID for r in one_day.collect()] == ["2025-01-02"]
    one_day.explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(date" in plan


def test_scan_follows_the_header(spark, tmp_path):
    columns = list(reversed(RAW_COLUMNS))
    write_csv(tmp_path / "date=2025-01-01" / "a.csv", {"Channel": "Branch"}, columns=columns)
    row = read_raw(spark, str(tmp_path)).first()
    assert {c: row[c] for c in RAW_COLUMNS} == {**DEFAULTS, "Channel": "Branch"}


def test_scan_reads_names_in_any_case(spark, tmp_path):
    columns = [c.lower() for c in RAW_COLUMNS]
    path = tmp_path / "date=2025-01-01" / "a.csv"
    path.parent.mkdir(parents=True)
    path.write_text(",".join(columns) + "\n" + ",".join(DEFAULTS[c] for c in RAW_COLUMNS) + "\n")
    assert read_raw(spark, str(tmp_path)).columns[:15] == RAW_COLUMNS


def test_scan_refuses_headers_that_differ(spark, tmp_path):
    write_csv(tmp_path / "date=2025-01-01" / "a.csv", {})
    write_csv(tmp_path / "date=2025-01-01" / "b.csv", {}, columns=list(reversed(RAW_COLUMNS)))
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_raw(spark, str(tmp_path)).collect()


def test_scan_refuses_missing_columns(spark, tmp_path):
    write_csv(tmp_path / "date=2025-01-01" / "a.csv", {}, columns=RAW_COLUMNS[:-1])
    with pytest.raises(ValueError, match="AccountBalance"):
        read_raw(spark, str(tmp_path))


def test_scan_keeps_other_columns(spark, tmp_path):
    columns = [*RAW_COLUMNS, "Note"]
    write_csv(tmp_path / "date=2025-01-01" / "a.csv", {"Note": "x"}, {"Note": "y"}, columns=columns)
    df = read_raw(spark, str(tmp_path))
    assert df.columns == [*RAW_COLUMNS, "Note", "ingest_date"]
    assert clean_transactions(df).count() == 2


def test_scan_reads_quotes_as_they_are_written(spark, tmp_path):
    raw = raw_rows(spark, {"DeviceID": 'say "hi", ok'}, {"DeviceID": "back\\\\slash"}, {"DeviceID": '"'})
    path = tmp_path / "date=2025-01-01" / "a.csv"
    path.parent.mkdir()
    with open(path, "w", newline="") as out:
        lines = csv.writer(out)
        lines.writerow(RAW_COLUMNS)
        lines.writerows([list(r) for r in raw.collect()])
    found = read_raw(spark, str(tmp_path)).drop("ingest_date")
    assert sorted_rows(found) == sorted_rows(raw)


def test_scan_refuses_rows_with_another_number_of_fields(spark, tmp_path):
    for text in ("T1,A1,5", ",".join(["x"] * 16)):
        path = tmp_path / "date=2025-01-01" / "a.csv"
        write_csv(path, {})
        path.write_text(path.read_text() + text + "\n")
        with pytest.raises(Exception, match="MALFORMED"):
            read_raw(spark, str(tmp_path)).collect()


def test_scan_with_inference(spark, tmp_path):
    write_csv(
        tmp_path / "date=2025-01-01" / "a.csv",
        {"TransactionID": "TX1", "TransactionDate": "2023-04-11 10:00:00"},
        {"TransactionID": "TX2", "TransactionAmount": "20000"},
    )
    df = read_raw(spark, str(tmp_path), infer_schema=True)
    assert df.schema["CustomerAge"].dataType == T.IntegerType()
    rows = {r.TransactionID: r for r in clean_transactions(df).collect()}
    assert rows["TX1"].TransactionDate == dt.datetime(2023, 4, 11, 10)
    assert (rows["TX1"].is_suspicious, rows["TX2"].is_suspicious) == (False, True)


def test_csv_and_parquet_give_the_same_star(spark, tmp_path):
    raw = raw_transactions(spark, SF_SMALL)
    raw.write.option("header", True).csv(str(tmp_path / "raw" / "date=2025-01-01"))
    run_transform(spark, str(tmp_path / "raw"), str(tmp_path / "a"))
    stage_star(raw, str(tmp_path / "b"))
    for table in STAR_TABLES:
        left, right = (read_staged(spark, str(tmp_path / d), table) for d in "ab")
        assert sorted_rows(left) == sorted_rows(right), table


def test_staged_write_replaces(spark, tmp_path):
    for n in (5, 3):
        write_staged(spark.range(n), str(tmp_path), "numbers")
    assert read_staged(spark, str(tmp_path), "numbers").count() == 3


def test_upper_columns(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, Mixed int")
    assert upper_columns(df).columns == ["A B", "MIXED"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_timestamps_to_text(spark, conf, zone):
    conf("spark.sql.session.timeZone", zone)
    df = spark.sql(
        """SELECT TIMESTAMP_NTZ'2023-03-12 02:30:00' AS gap,
        TIMESTAMP_NTZ'2023-04-11 01:02:03.456' AS fraction, TIMESTAMP'2023-04-11 01:02:03' AS local,
        DATE'2023-04-11' AS day, CAST(NULL AS TIMESTAMP_NTZ) AS none, 'x' AS other"""
    )
    assert timestamps_to_text(df).collect() == [
        (
            "2023-03-12 02:30:00",
            "2023-04-11 01:02:03",
            "2023-04-11 01:02:03",
            dt.date(2023, 4, 11),
            None,
            "x",
        )
    ]


@pytest.fixture
def warehouse(spark, tmp_path):
    name = f"warehouse_{tmp_path.name.replace('-', '_')}"
    create_warehouse(spark, name, f"file:{tmp_path}/warehouse")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_load_star_replaces_and_keeps_the_schema(spark, tmp_path, warehouse):
    stage_star(raw_transactions(spark, SF_SMALL), str(tmp_path / "a"))
    stage_star(raw_rows(spark, {}, {"TransactionID": "T2"}), str(tmp_path / "b"))
    load_star(spark, str(tmp_path / "a"), warehouse)
    load_star(spark, str(tmp_path / "a"), warehouse)
    for table in STAR_TABLES:
        staged = read_staged(spark, str(tmp_path / "a"), table).transform(load_projection)
        loaded = spark.table(f"{warehouse}.{table.upper()}")
        assert sorted_rows(loaded) == sorted_rows(staged), table
    load_star(spark, str(tmp_path / "b"), warehouse)
    for table in STAR_TABLES:
        found = spark.table(f"{warehouse}.{table.upper()}")
        assert [(f.name, f.dataType) for f in found.schema] == [
            (f.name, f.dataType) for f in warehouse_schema(table)
        ]
    counts = [spark.table(f"{warehouse}.{t.upper()}").count() for t in STAR_TABLES]
    assert counts == [1, 1, 1, 1, 2]
    fact = spark.table(f"{warehouse}.FACT_TRANSACTIONS").first()
    assert fact.TRANSACTION_DATE == "2023-04-11 00:00:00"


def test_create_warehouse_keeps_what_is_there(spark, tmp_path, warehouse):
    load_table(
        spark.createDataFrame([("Debit", 1)], "TRANSACTION_TYPE string, TYPE_ID long"),
        f"{warehouse}.DIM_TRANSACTION_TYPE",
    )
    create_warehouse(spark, warehouse)
    assert spark.table(f"{warehouse}.DIM_TRANSACTION_TYPE").count() == 1


def test_load_matches_columns_by_name(spark, warehouse):
    swapped = spark.createDataFrame([(7, "Debit")], "TYPE_ID long, TRANSACTION_TYPE string")
    load_table(swapped, f"{warehouse}.DIM_TRANSACTION_TYPE")
    assert spark.table(f"{warehouse}.DIM_TRANSACTION_TYPE").collect() == [("Debit", 7)]


def test_load_refuses_unknown_tables_and_columns(spark, warehouse):
    rows = spark.createDataFrame([(7,)], "TYPE_ID long")
    with pytest.raises(AnalysisException):
        load_table(rows, f"{warehouse}.NO_SUCH_TABLE")
    with pytest.raises(AnalysisException):
        load_table(rows, f"{warehouse}.DIM_TRANSACTION_TYPE")


def test_load_through_a_connector(spark):
    """The no-op connector takes what a database would be sent."""
    rows = spark.createDataFrame([(7, "Debit")], "TYPE_ID long, TRANSACTION_TYPE string")
    load_table(rows, "DIM_TRANSACTION_TYPE", fmt="noop", options={"any": "option"})


class _Conf:
    def __init__(self, values):
        self.conf = self
        self.values = values

    def get(self, key, default):
        return self.values.get(key, default)


def test_shared_dir():
    named = _Conf({"spark.checkpoint.dir": "hdfs://x/shared/", "spark.master": "yarn"})
    assert workdir.shared_dir(named) == "hdfs://x/shared"
    with pytest.raises(RuntimeError):
        workdir.shared_dir(_Conf({"spark.master": "yarn"}))
    local = _Conf({"spark.master": "local[2]"})
    assert workdir.shared_dir(local) == workdir.shared_dir(local)


def test_materialise_writes_to_the_shared_folder(spark):
    df = workdir.materialise(spark.range(5), "numbers")
    folder = spark.conf.get("spark.checkpoint.dir")
    assert all(f.startswith(folder.replace("file:", "file://")) for f in df.inputFiles())
    assert df.count() == 5


def test_scratch_is_removed(spark, tmp_path):
    with workdir.scratch(spark) as folder:
        inside = workdir.materialise(spark.range(5), "numbers")
        assert all(folder.removeprefix("file:") in f for f in inside.inputFiles())
        assert Store(spark).names(folder)
    assert not Store(spark).exists(folder)
    assert not workdir.fresh_dir(spark, "x").startswith(folder)


def test_a_job_leaves_only_its_outputs(spark, tmp_path):
    store, shared = Store(spark), workdir.shared_dir(spark)
    raw_transactions(spark, SF_SMALL).write.option("header", True).csv(str(tmp_path / "raw" / "date=2025-01-01"))
    before = store.names(shared)
    run_transform(spark, str(tmp_path / "raw"), str(tmp_path / "staged"))
    assert store.names(shared) == before
    (version,) = (tmp_path / "staged" / "_versions").iterdir()
    assert sorted(p.name for p in version.iterdir()) == sorted([*STAR_TABLES, "standard_transactions"])


def test_an_absent_connector_target_is_refused(spark):
    rows = spark.createDataFrame([(7, "Debit")], "TYPE_ID long, TRANSACTION_TYPE string")
    with pytest.raises(Exception):
        load_table(rows, "NO_SUCH_TABLE", fmt="jdbc", options={"url": "jdbc:none:x"})


# ---- versions of the star -------------------------------------------------------------------


def _star_rows(spark, root):
    return {t: sorted_rows(read_staged(spark, root, t)) for t in STAR_TABLES}


@pytest.mark.parametrize("table", ["dim_merchant", "fact_transactions"])
def test_a_job_that_dies_between_tables_leaves_the_old_star(spark, tmp_path, monkeypatch, table):
    root = str(tmp_path / "staged")
    raw = raw_transactions(spark, SF_SMALL)
    stage_star(raw.filter("TransactionType = 'Debit'"), root)
    before = _star_rows(spark, root)
    write = jobs.write_staged

    def dying(df, folder, name):
        if name == table:
            raise OSError("lost")
        write(df, folder, name)

    with monkeypatch.context() as patch:
        patch.setattr(jobs, "write_staged", dying)
        with pytest.raises(OSError):
            stage_star(raw, root)
        assert _star_rows(spark, root) == before
        patch.setattr(Store, "delete", lambda *args: None)  # the process is gone
        with pytest.raises(OSError):
            stage_star(raw, root)
    assert _star_rows(spark, root) == before
    open_reader = read_staged(spark, root, "fact_transactions")
    stage_star(raw, root)
    after = _star_rows(spark, root)
    assert after != before and len(after["dim_transaction_type"]) == 3
    assert sorted_rows(open_reader) == before["fact_transactions"]
    assert len(list((tmp_path / "staged" / "_versions").iterdir())) == 2


def test_old_versions_go_and_names_only_rise(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    for n in range(4):
        with new_version(spark, root) as folder:
            write_staged(spark.range(n), folder, "numbers")
        assert read_staged(spark, root, "numbers").count() == n
        assert len(list((tmp_path / "_versions").iterdir())) == min(n + 1, staged.KEPT)

    class Early(dt.datetime):
        @classmethod
        def now(cls, tz=None):
            return dt.datetime(2001, 1, 1, tzinfo=tz)

    monkeypatch.setattr(staged.dt, "datetime", Early)
    with new_version(spark, root) as folder:
        write_staged(spark.range(9), folder, "numbers")
    assert read_staged(spark, root, "numbers").count() == 9


# ---- counts and sizes -----------------------------------------------------------------------


def test_counts_are_not_taken_below_the_shuffle(spark, tmp_path, monkeypatch):
    """Tasks below a shuffle run again when its files are lost, and would count again."""
    plans = []
    write = jobs.write_staged

    def noted(df, root, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        write(df, root, name)

    monkeypatch.setattr(jobs, "write_staged", noted)
    raw = raw_rows(spark, {}, {}, {"TransactionID": "T2"}, {"AccountID": None})
    counts = stage_star(raw, str(tmp_path))
    assert (counts["raw"], counts["deduplicated"], counts["required"]) == (4, 3, 2)
    counting = [p for p in plans if "CollectMetrics" in p]
    assert len(counting) == 1 and "Exchange" in counting[0]
    assert all("CollectMetrics" not in p.split("Exchange", 1)[1] for p in counting)


def test_an_error_while_counting_is_no_zero(spark, tmp_path, monkeypatch):
    class Broken(jobs.Observation):
        @property
        def get(self):
            raise jobs.Py4JJavaError("lost", type("E", (), {"_target_id": "o0", "_gateway_client": None})())

    monkeypatch.setattr(jobs, "Observation", Broken)
    with pytest.raises(jobs.Py4JJavaError):
        stage_star(raw_rows(spark, {}), str(tmp_path))
    assert not (tmp_path / "_committed").exists()
    counts = stage_star(raw_rows(spark, {}).limit(0), str(tmp_path))
    assert set(counts.values()) == {0}


def test_text_and_parquet_are_sized_alike(spark, tmp_path):
    raw = raw_transactions(spark, SF_SMALL).withColumn("Note", F.lit("x" * 400))
    raw.write.option("header", True).csv(str(tmp_path / "csv"))
    raw.write.parquet(str(tmp_path / "parquet"))
    plain = Store(spark).size(str(tmp_path / "csv"))
    packed = Store(spark).size(str(tmp_path / "parquet"))
    measured = sizing.text_bytes(spark.read.parquet(str(tmp_path / "parquet")))
    assert packed < plain / 3 and 2 / 3 < measured / plain < 1.5
    assert sizing.text_bytes(spark.read.parquet(str(tmp_path / "parquet")).limit(0)) == 0


# ---- broken rows ----------------------------------------------------------------------------


def _broken_zone(tmp_path):
    path = tmp_path / "raw" / "date=2025-01-01" / "a.csv"
    write_csv(path, {"TransactionID": "T1"}, {"TransactionID": "T2"})
    path.write_text(path.read_text() + "T3,too,few\n" + ",".join(["T4"] * 16) + "\n")
    return str(tmp_path / "raw")


@pytest.mark.parametrize("columns", [["TransactionID"], ["Channel", "AccountID"], RAW_COLUMNS])
def test_broken_rows_count_whatever_is_read(spark, tmp_path, columns):
    root = _broken_zone(tmp_path)
    wanted = [F.col(f"`{c}`") for c in columns]
    with pytest.raises(Exception, match="MALFORMED"):
        read_raw(spark, root).select(wanted).collect()
    good = read_raw(spark, root, set_apart=True)
    assert good.select(wanted).count() == len(good.select(wanted).collect()) == 2
    assert {r.line[:2] for r in broken_rows(spark, root).collect()} == {"T3", "T4"}


def test_the_audit_counts_broken_rows(spark, tmp_path):
    root = _broken_zone(tmp_path)
    with pytest.raises(Exception, match="MALFORMED"):
        run_transform(spark, root, str(tmp_path / "staged"))
    audit = run_transform(spark, root, str(tmp_path / "staged"), set_apart=True)
    counts = {r.stage: r.row_count for r in audit.collect()}
    assert (counts["raw"], counts["broken"], counts["fact_transactions"]) == (2, 2, 2)


def _orders_in_parts(spark, path):
    """Order tables; the orders are six files, each a task's."""
    orders = (
        "id AS o_orderkey, id % 7 AS o_custkey, DATE'1995-01-01' AS o_orderdate, "
        "'F' AS o_orderstatus, '2-HIGH' AS o_orderpriority, 100.0D AS o_totalprice"
    )
    customer = "id AS c_custkey, 0L AS c_nationkey, 'X' AS c_mktsegment, 1.0D AS c_acctbal"
    for name, n, files, columns in (
        ("orders", 6000, 6, orders),
        ("customer", 7, 1, customer),
        ("nation", 1, 1, "id AS n_nationkey, 'PERU' AS n_name"),
    ):
        rows = spark.range(0, n, 1, files).selectExpr(*columns.split(", "))
        rows.write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_broken_files_are_written_by_many_tasks(spark, conf, tmp_path, monkeypatch):
    """One task once wrote them all, and held what the join of all rows takes."""
    monkeypatch.setattr(workdir, "shared_dir", lambda spark: str(tmp_path / "work"))
    conf("spark.sql.files.openCostInBytes", "200m")
    found = queries.scan_broken_rows(spark, _orders_in_parts(spark, tmp_path / "in"))
    rows = found.collect()
    raw = raw_transactions(spark, str(tmp_path / "in")).count()
    assert len(rows) == raw + 1
    assert [r.LoginAttempts for r in rows if r.TransactionID == "broken"] == [str(2 * raw)]
    files = list((tmp_path / "work").glob("*/date=2025-01-02/*.csv"))
    assert len(files) == 6
    assert {f.read_text().split("\n")[0] for f in files} == {",".join(RAW_COLUMNS)}


# ---- long projections -----------------------------------------------------------------------


@pytest.mark.parametrize(("given", "then"), [("65535", "8000"), ("100", "100")])
def test_no_method_is_too_long_for_the_jvm_to_compile(spark, conf, tmp_path, given, then):
    conf(sizing.HUGE_METHOD, given)
    raw_transactions(spark, SF_SMALL)
    assert spark.conf.get(sizing.HUGE_METHOD) == then
    conf(sizing.HUGE_METHOD, given)
    stage_star(raw_rows(spark, {}), str(tmp_path))
    assert spark.conf.get(sizing.HUGE_METHOD) == then


def test_raw_rows_take_their_time_once_and_are_long_only_at_the_end(spark):
    raw = raw_transactions(spark, SF_SMALL)
    plan = raw._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("timestampadd") == 1
    assert "lpad" not in plan[plan.index("Generate explode") :]
