"""Loads that fail leave the rows of the load before, in the catalog and behind a connector."""

from __future__ import annotations

import os
import pickle
import shutil
import uuid

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import _parse_datatype_json_string

from tests.helpers import raw_rows, sorted_rows
from txnstar import create_warehouse, load_star, load_table, load_tables, read_staged, stage_star
from txnstar.plans.jobs import run_load
from txnstar.schema import STAR_TABLES, warehouse_schema
from txnstar.sources import warehouse as loads
from txnstar.sources.warehouse import Load, Swap, swap_by_jdbc

SCHEMA = "TRANSACTION_TYPE string, TYPE_ID long"
TABLE = "DIM_TRANSACTION_TYPE"


@pytest.fixture
def database(spark, tmp_path):
    name = f"loads_{uuid.uuid4().hex[:8]}"
    create_warehouse(spark, name, f"file:{tmp_path}/warehouse")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def _types(spark, *ids):
    return spark.createDataFrame([(f"t{i}", i) for i in ids], SCHEMA)


def _breaking(spark):
    """Rows of which one fails when it is written."""
    broken = F.when(F.col("TYPE_ID") == 3, F.raise_error(F.lit("broken row")).cast("long"))
    return _types(spark, 1, 2, 3, 4).repartition(4).withColumn("TYPE_ID", broken.otherwise(F.col("TYPE_ID")))


# ---- catalog --------------------------------------------------------------------------------


def _folders(tmp_path, table):
    found = tmp_path / "warehouse" / "_loads" / table.lower()
    return sorted(p.name for p in found.iterdir()) if found.exists() else []


def test_a_failing_load_leaves_the_rows_and_nothing_else(spark, tmp_path, database):
    name = f"{database}.{TABLE}"
    load_table(_types(spark, 7), name)
    before = _folders(tmp_path, TABLE)
    with pytest.raises(Exception, match="broken row"):
        load_table(_breaking(spark), name)
    assert sorted_rows(spark.table(name)) == [("t7", 7)]
    assert _folders(tmp_path, TABLE) == before
    assert len(spark.catalog.listTables(database)) == len(STAR_TABLES)


def test_tables_of_a_load_change_together(spark, tmp_path, database, monkeypatch):
    stage_star(raw_rows(spark, {}), str(tmp_path / "a"))
    stage_star(raw_rows(spark, {}, {"TransactionID": "T2", "AccountID": "A2"}), str(tmp_path / "b"))
    load_star(spark, str(tmp_path / "a"), database)
    found = lambda: {t: sorted_rows(spark.table(f"{database}.{t.upper()}")) for t in STAR_TABLES}
    before = found()
    good = [
        Load(read_staged(spark, str(tmp_path / "b"), t).transform(loads.load_projection), f"{database}.{t.upper()}")
        for t in STAR_TABLES
    ]
    with pytest.raises(Exception, match="broken row"):  # the last table fails
        load_tables(spark, [*good[:3], Load(_breaking(spark), f"{database}.{TABLE}")])
    assert found() == before
    sql, tables = type(spark).sql, []

    def dying(self, text, *args, **kwargs):
        if text.startswith("ALTER TABLE") and "fact" in text.lower() and not tables:
            tables.append(text)
            raise OSError("lost")
        return sql(self, text, *args, **kwargs)

    with monkeypatch.context() as patch:  # the last table is not switched
        patch.setattr(type(spark), "sql", dying)
        with pytest.raises(OSError):
            load_star(spark, str(tmp_path / "b"), database)
    assert tables and found() == before
    load_star(spark, str(tmp_path / "b"), database)
    assert len(found()["fact_transactions"]) == 2


def test_open_readers_and_old_folders(spark, tmp_path, database):
    name = f"{database}.{TABLE}"
    for n in range(1, 5):
        reader = spark.read.parquet(*spark.table(name).inputFiles()) if n > 1 else None
        load_table(_types(spark, n), name)
        assert reader is None or sorted_rows(reader) == [(f"t{n - 1}", n - 1)]
        assert sorted_rows(spark.table(name)) == [(f"t{n}", n)]
        assert len(_folders(tmp_path, TABLE)) == min(n, 2)
    assert not (tmp_path / "warehouse" / TABLE.lower()).exists()
    load_table(_types(spark).limit(0), name)
    assert spark.table(name).count() == 0
    assert spark.table(name).schema == _types(spark).schema


def test_a_load_may_read_its_own_target(spark, database):
    name = f"{database}.{TABLE}"
    load_table(_types(spark, 1, 2), name)
    load_table(spark.table(name).filter("TYPE_ID = 2"), name)
    assert sorted_rows(spark.table(name)) == [("t2", 2)]


def test_counts_that_differ_are_refused(spark, database):
    name = f"{database}.{TABLE}"
    load_table(_types(spark, 7), name)
    with pytest.raises(ValueError, match="3 rows were sent, 2 arrived"):
        load_tables(spark, [Load(_types(spark, 1, 2), name, spark.range(3))])
    assert sorted_rows(spark.table(name)) == [("t7", 7)]


def test_partitioned_tables_are_overwritten_in_place(spark, database):
    spark.sql(f"CREATE TABLE {database}.p (n long, k string) USING parquet PARTITIONED BY (k)")
    for k in "ab":
        load_table(spark.createDataFrame([(k, 1)], "k string, n long"), f"{database}.p")
    assert sorted_rows(spark.table(f"{database}.p")) == [(1, "b")]


def test_odd_names(spark, database):
    """A column called like a line of the description, and a folder with a quote."""
    place = spark.catalog.getDatabase(database).locationUri + "/it's"
    spark.sql(f"CREATE TABLE {database}.`odd` (`Location` string, `a.b` long) USING parquet LOCATION \"{place}\"")
    for n in range(3):
        load_table(spark.createDataFrame([(n, "here")], "`a.b` long, Location string"), f"{database}.odd")
        assert sorted_rows(spark.table(f"{database}.odd")) == [("here", n)]


# ---- connectors -----------------------------------------------------------------------------


class _Reader(DataSourceReader):
    def __init__(self, folder):
        self.folder = folder

    def read(self, partition):
        for name in sorted(os.listdir(self.folder)):
            if name.startswith("part"):
                with open(f"{self.folder}/{name}", "rb") as file:
                    yield from pickle.load(file)


class _Writer(DataSourceWriter):
    """Empties the table when it starts, as a truncating connector does."""

    def __init__(self, folder, schema, fails):
        self.folder, self.fails = folder, fails
        shutil.rmtree(folder, ignore_errors=True)
        os.makedirs(folder)
        with open(f"{folder}/schema", "w") as file:
            file.write(schema.json())

    def write(self, rows):
        found = [tuple(row) for row in rows]
        with open(f"{self.folder}/part-{uuid.uuid4().hex}", "wb") as file:
            pickle.dump(found, file)
        if self.fails and found:
            raise RuntimeError("connection lost")
        return WriterCommitMessage()


class FolderTables(DataSource):
    """A connector for tests: a table is a folder."""

    @classmethod
    def name(cls):
        return "foldertables"

    @property
    def folder(self):
        return f"{self.options['root']}/{self.options['dbtable']}"

    def schema(self):
        with open(f"{self.folder}/schema") as file:
            return _parse_datatype_json_string(file.read())

    def reader(self, schema):
        return _Reader(self.folder)

    def writer(self, schema, overwrite):
        return _Writer(self.folder, schema, self.options["dbtable"].startswith(self.options.get("fails", "none")))


def swap_folders(spark, swaps, options):
    for one in swaps:
        shutil.rmtree(f"{options['root']}/{one.table}")
        os.rename(f"{options['root']}/{one.shadow}", f"{options['root']}/{one.table}")


@pytest.fixture
def server(spark, tmp_path):
    spark.dataSource.register(FolderTables)
    for table in STAR_TABLES:
        folder = tmp_path / "tables" / f"W.{table.upper()}"
        folder.mkdir(parents=True)
        (folder / "schema").write_text(warehouse_schema(table).json())
    return {"root": str(tmp_path / "tables")}


def _held(spark, options, table=f"W.{TABLE}"):
    return sorted_rows(spark.read.format("foldertables").options(**options).option("dbtable", table).load())


def test_a_connector_load_that_fails_leaves_the_old_rows(spark, server):
    load = lambda rows, **more: load_table(
        rows, f"W.{TABLE}", "foldertables", server | more, swap_folders
    )
    load(_types(spark, 7))
    assert _held(spark, server) == [("t7", 7)]
    with pytest.raises(Exception, match="connection lost"):
        load(_types(spark, 8), fails="W.")
    assert _held(spark, server) == [("t7", 7)]
    load(_types(spark, 8, 9).select("TYPE_ID", "TRANSACTION_TYPE"))
    assert _held(spark, server) == [("t8", 8), ("t9", 9)]
    with pytest.raises(ValueError, match="5 rows were sent, 1 arrived"):
        load_tables(spark, [Load(_types(spark, 1), f"W.{TABLE}", spark.range(5))], "foldertables", server, swap_folders)
    assert _held(spark, server) == [("t8", 8), ("t9", 9)]


def test_the_star_through_a_connector(spark, server, tmp_path):
    stage_star(raw_rows(spark, {}, {"TransactionID": "T2"}), str(tmp_path / "a"))
    stage_star(raw_rows(spark, {}), str(tmp_path / "b"))
    load_star(spark, str(tmp_path / "a"), "W", "foldertables", server, swap_folders)
    assert len(_held(spark, server, "W.FACT_TRANSACTIONS")) == 2
    with pytest.raises(Exception, match="connection lost"):
        load_star(spark, str(tmp_path / "b"), "W", "foldertables", server | {"fails": "W.FACT"}, swap_folders)
    assert len(_held(spark, server, "W.FACT_TRANSACTIONS")) == 2


def test_without_a_swap_a_warning_is_given(spark, server, tmp_path, caplog):
    stage_star(raw_rows(spark, {}), str(tmp_path / "a"))
    loaded = run_load(spark, str(tmp_path / "a"), "W", "foldertables", server)
    assert "partly filled" in caplog.text
    assert {r.row_count for r in loaded.collect()} == {1}


def test_an_absent_target_of_any_connector_is_refused(spark, server):
    with pytest.raises((AnalysisException, OSError), match="NO_SUCH"):
        load_table(_types(spark, 1), "W.NO_SUCH", "foldertables", server, swap_folders)
    assert not [name for name in os.listdir(server["root"]) if "NO_SUCH" in name]


class _Connection:
    """Notes what a database would be told."""

    def __init__(self, fails=None):
        self.said, self.fails = [], fails

    def createStatement(self):  # noqa: N802
        return self

    def executeUpdate(self, text):  # noqa: N802
        if self.fails and self.fails in text:
            raise RuntimeError("refused")
        self.said.append(text)

    def __getattr__(self, name):
        return lambda *args: self.said.append(name)


def test_a_jdbc_swap_is_one_transaction(monkeypatch):
    swaps = [Swap("S.A__LOAD", "S.A", ["DATE", "DAY"]), Swap("S.B__LOAD", "S.B", ["N"])]
    quote = lambda name: f'"{name}"'
    connection = _Connection()
    monkeypatch.setattr(loads, "_connect", lambda *args: (connection, quote))
    swap_by_jdbc(None, swaps, {"url": "jdbc:none:x"})
    assert connection.said == [
        "setAutoCommit",
        "DELETE FROM S.A",
        'INSERT INTO S.A ("DATE", "DAY") SELECT "DATE", "DAY" FROM S.A__LOAD',
        "DELETE FROM S.B",
        'INSERT INTO S.B ("N") SELECT "N" FROM S.B__LOAD',
        "commit",
        "DROP TABLE S.A__LOAD",
        "DROP TABLE S.B__LOAD",
        "commit",
        "close",
    ]
    connection = _Connection("INTO S.B")
    with pytest.raises(RuntimeError):
        swap_by_jdbc(None, swaps, {"url": "jdbc:none:x"})
    assert "commit" not in connection.said and connection.said[-2:] == ["rollback", "close"]


def test_a_jdbc_connection_is_asked_of_spark(spark):
    """No database may be started here; an unknown URL fails where the driver is looked for."""
    with pytest.raises(Exception, match="No suitable driver|driver"):
        loads._connect(spark, "jdbc:none:x", "T", {"url": "jdbc:none:x"})
