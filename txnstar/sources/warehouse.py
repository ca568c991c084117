"""Replace the contents of warehouse tables that already exist.

Executors write; no table passes through the driver. A load is first written beside its target
and counted there, and takes the target's place when all tables of the load are ready. Until
then, and if the load fails, readers find the rows of the load before.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnstar.operators.audit import row_counts
from txnstar.operators.projection import load_projection
from txnstar.schema import STAR_TABLES, warehouse_schema
from txnstar.sources.staged import current_root, read_staged
from txnstar.sources.store import Store

log = logging.getLogger(__name__)

# Folder beside a catalog table's own for what later loads wrote.
LOADS = "_loads"
# What the name of a connector's second table ends in.
SHADOW = "__LOAD"
# What Spark says of a connector that can be written but not read.
NOT_READABLE = ("is not a valid Spark SQL Data Source", "does not support batch scan")
# Catalog tables of these providers are a folder of files and nothing else.
FILE_PROVIDERS = {"parquet", "orc", "avro", "json", "csv"}
SESSION_CATALOG = "spark_catalog"


@dataclass(frozen=True)
class Load:
    """Rows for a table; ``counted`` is a cheaper frame with as many rows, to check against."""

    rows: DataFrame
    table: str
    counted: DataFrame | None = None


@dataclass(frozen=True)
class Swap:
    """A filled second table that is to take the place of a target's rows."""

    shadow: str
    table: str
    columns: list[str]


Swapper = Callable[[SparkSession, list[Swap], dict[str, str]], None]


def create_warehouse(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Empty catalog tables to load into; needed once, before the first load."""
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{at}")
    for table in STAR_TABLES:
        name = f"{database}.{table.upper()}"
        if not spark.catalog.tableExists(name):
            spark.catalog.createTable(name, source="parquet", schema=warehouse_schema(table))


def load_table(
    df: DataFrame,
    table: str,
    fmt: str = "table",
    options: dict[str, str] | None = None,
    swap: Swapper | None = None,
) -> None:
    """Replace the rows of ``table``, keeping its schema; it must exist. See ``load_tables``."""
    load_tables(df.sparkSession, [Load(df, table)], fmt, options, swap)


def load_tables(
    spark: SparkSession,
    loads: list[Load],
    fmt: str = "table",
    options: dict[str, str] | None = None,
    swap: Swapper | None = None,
) -> None:
    """Replace the rows of several tables together, keeping their schemas; all must exist.

    ``fmt="table"`` is the catalog, matching columns by name. An unpartitioned table of files
    gets a new folder each load, which becomes its location at the end; the folder before stays
    for readers that have it open until the next load. If one of the tables cannot be switched,
    those before it are switched back. Other catalog tables are overwritten in place, which is
    one commit where their format has commits.

    Any other format is a Spark connector. All targets are looked up first, and nothing is
    written if one is absent. The rows go to a second table, named like the target with
    ``__LOAD`` behind, are counted there, and ``swap`` moves them; for ``jdbc`` that is
    ``swap_by_jdbc`` unless another is given. With no way to swap, or a connector that can only
    be written, the target is truncated and filled: a warning says so, as a load that fails
    leaves such a table partly filled and has to be run again.
    """
    if fmt == "table":
        _replace_in_catalog(spark, loads)
    else:
        _replace_by_connector(spark, loads, fmt, options or {}, swap or SWAPS.get(fmt))


def load_star(
    spark: SparkSession,
    staged_root: str,
    target: str,
    fmt: str = "table",
    options: dict[str, str] | None = None,
    swap: Swapper | None = None,
) -> None:
    """Load the five staged tables, all of one version, into the database or schema ``target``.

    The counts of what arrived must be those of the staged files.
    """
    root = current_root(spark, staged_root)
    loads = []
    for table in STAR_TABLES:
        staged = read_staged(spark, root, table)
        loads.append(Load(load_projection(staged), f"{target}.{table.upper()}", staged))
    load_tables(spark, loads, fmt, options, swap)


def connector_table(
    spark: SparkSession, table: str, fmt: str, options: dict[str, str]
) -> DataFrame | None:
    """A connector's table; None if the connector can only write. Raises if there is no such table."""
    try:
        found = spark.read.format(fmt).options(**options).option("dbtable", table).load()
        found.schema  # noqa: B018  asks the connector
        return found
    except AnalysisException as error:
        if any(words in str(error) for words in NOT_READABLE):
            return None
        raise


def _check_counts(loads: list[Load], arrived: list[DataFrame]) -> None:
    """Compare what was sent and what is there, for all tables in one job."""
    pairs = [(load, found) for load, found in zip(loads, arrived, strict=True) if load.counted]
    if not pairs:
        return
    frames = {f"sent {load.table}": load.counted for load, _ in pairs}
    frames |= {f"found {load.table}": found for load, found in pairs}
    counts = {row.stage: row.row_count for row in row_counts(frames).collect()}
    for load, _ in pairs:
        sent, found = counts[f"sent {load.table}"], counts[f"found {load.table}"]
        if sent != found:
            raise ValueError(f"{load.table}: {sent} rows were sent, {found} arrived")


# ---- catalog --------------------------------------------------------------------------------


@dataclass(frozen=True)
class _Placed:
    """A table of files in Spark's own catalog: where its rows are, and where those to come go."""

    name: str
    shadow: str
    location: str
    home: str
    folder: str


def _quoted(*parts: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _placed(spark: SparkSession, table: str, version: str) -> _Placed | None:
    """None for a table that is more than one folder of files."""
    rows = [(r.col_name, r.data_type) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()]
    names = [name for name, _ in rows]
    if "# Detailed Table Information" not in names or "# Partition Information" in names:
        return None
    facts = dict(rows[names.index("# Detailed Table Information") + 1 :])
    if facts.get("Provider", "").lower() not in FILE_PROVIDERS or "Location" not in facts:
        return None
    if facts.get("Catalog", SESSION_CATALOG) != SESSION_CATALOG:
        return None
    location = facts["Location"].rstrip("/")
    parent, last = location.rsplit("/", 1)
    # A loaded table is at <folder>/_loads/<name>/<version>, one never loaded at <folder>/<name>.
    loaded = parent.rsplit("/", 2)[-2:-1] == [LOADS]
    home = parent if loaded else f"{parent}/{LOADS}/{last}"
    return _Placed(
        _quoted(facts["Database"], facts["Table"]),
        _quoted(facts["Database"], f"{facts['Table']}_load_{version[-8:]}"),
        location,
        home,
        f"{home}/{version}",
    )


def _table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(f"{SESSION_CATALOG}.{name}")


def _by_name(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[F.col(_quoted(name)) for name in columns])


def _replace_in_catalog(spark: SparkSession, loads: list[Load]) -> None:
    store = Store(spark)
    version = f"{dt.datetime.now(dt.UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    ready = [
        (load, _by_name(load.rows, spark.table(load.table).columns), _placed(spark, load.table, version))
        for load in loads
    ]
    beside = [(load, rows, placed) for load, rows, placed in ready if placed]
    switched = []
    try:
        for _, rows, placed in beside:
            # The second table has the target's columns and types, and turns away what it would.
            at = _text(placed.folder)
            spark.sql(f"CREATE TABLE {placed.shadow} LIKE {placed.name} LOCATION {at}")
            rows.write.insertInto(f"{SESSION_CATALOG}.{placed.shadow}", overwrite=True)
        _check_counts([load for load, _, _ in beside], [_table(spark, p.shadow) for *_, p in beside])
        for _, _, placed in beside:
            switched.append(placed)
            spark.sql(f"ALTER TABLE {SESSION_CATALOG}.{placed.name} SET LOCATION {_text(placed.folder)}")
    except BaseException:
        for placed in switched:
            spark.sql(f"ALTER TABLE {SESSION_CATALOG}.{placed.name} SET LOCATION {_text(placed.location)}")
        for _, _, placed in beside:
            store.delete(placed.folder)
        raise
    finally:
        for _, _, placed in beside:
            spark.sql(f"DROP TABLE IF EXISTS {SESSION_CATALOG}.{placed.shadow}")  # the files stay
    for _, _, placed in beside:
        _remove_older(store, placed)
    for load, rows, placed in ready:
        if not placed:
            rows.write.insertInto(load.table, overwrite=True)


def _remove_older(store: Store, placed: _Placed) -> None:
    """Folders of loads before the last, and what loads that were killed left before it."""
    parent, last = placed.location.rsplit("/", 1)
    if parent != placed.home:
        return  # the first load; the folder the table was made with stays until the second
    for old in store.names(placed.home):
        if old < min(last, placed.folder.rsplit("/", 1)[1]):
            store.delete(f"{placed.home}/{old}")
    above, name = placed.home.rsplit("/", 1)
    store.delete(f"{above.removesuffix('/' + LOADS)}/{name}")


# ---- connectors -----------------------------------------------------------------------------


def _send(rows: DataFrame, table: str, fmt: str, options: dict[str, str]) -> None:
    writer = rows.write.format(fmt).mode("overwrite").option("truncate", True)
    writer.options(**options).option("dbtable", table).save()


def _replace_by_connector(
    spark: SparkSession,
    loads: list[Load],
    fmt: str,
    options: dict[str, str],
    swap: Swapper | None,
) -> None:
    targets = [connector_table(spark, load.table, fmt, options) for load in loads]
    if swap is None or None in targets:
        log.warning("%s has no way to swap tables: a load that fails leaves them partly filled", fmt)
        for load in loads:
            _send(load.rows, load.table, fmt, options)
        return
    swaps = [
        Swap(load.table + SHADOW, load.table, target.columns)
        for load, target in zip(loads, targets, strict=True)
    ]
    for load, one in zip(loads, swaps, strict=True):
        _send(_by_name(load.rows, one.columns), one.shadow, fmt, options)
    _check_counts(loads, [connector_table(spark, one.shadow, fmt, options) for one in swaps])
    swap(spark, swaps, options)


def _connect(spark: SparkSession, url: str, table: str, options: dict[str, str]):
    """A connection of the driver's, made as Spark's JDBC source makes its own."""
    jvm = spark._jvm
    given = jvm.org.apache.spark.api.python.PythonUtils.toScalaMap(options)
    settings = jvm.org.apache.spark.sql.execution.datasources.jdbc.JDBCOptions(url, table, given)
    dialect = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url)
    return dialect.createConnectionFactory(settings).apply(-1), dialect.quoteIdentifier


def swap_by_jdbc(spark: SparkSession, swaps: list[Swap], options: dict[str, str]) -> None:
    """Move the rows of the second tables within the database, all targets in one transaction.

    Targets keep their definition, indexes and rights. The database copies; no row comes here.
    If a statement fails all targets keep their rows; the second tables stay then, and the next
    load empties them.
    """
    connection, quote = _connect(spark, options["url"], swaps[0].table, options)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        try:
            for one in swaps:
                columns = ", ".join(quote(name) for name in one.columns)
                statement.executeUpdate(f"DELETE FROM {one.table}")
                statement.executeUpdate(
                    f"INSERT INTO {one.table} ({columns}) SELECT {columns} FROM {one.shadow}"
                )
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
        for one in swaps:
            statement.executeUpdate(f"DROP TABLE {one.shadow}")
        connection.commit()
    finally:
        connection.close()


SWAPS: dict[str, Swapper] = {"jdbc": swap_by_jdbc}
