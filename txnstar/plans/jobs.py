"""The jobs a user runs: transform, load, and the whole day in order."""

from __future__ import annotations

from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from txnstar.operators.audit import row_counts
from txnstar.operators.clean import (
    calendar_parts,
    cast_numbers,
    drop_exact_duplicates,
    drop_unparsed,
    flag_suspicious,
    parse_mixed_timestamps,
    require_columns,
)
from txnstar.operators.keys import assign_key, assign_key_in_ranges, hot_keys, in_ranges
from txnstar.operators.star import (
    build_dim_account,
    build_dim_date,
    build_dim_merchant,
    build_fact,
    transaction_types,
)
from txnstar.plans.sizing import compiled, sized_for, text_bytes
from txnstar.schema import STANDARD_TABLE, STAR_TABLES
from txnstar.sources.raw import broken_rows, read_raw, read_raw_zone
from txnstar.sources.staged import current_root, new_version, read_staged, write_staged
from txnstar.sources.store import Store
from txnstar.sources.warehouse import connector_table, load_star
from txnstar.sources.workdir import fresh_dir, materialise, scratch
from txnstar.streaming.ingest import ingest_landing

DIMENSIONS = {
    "dim_date": build_dim_date,
    "dim_account": build_dim_account,
    "dim_merchant": build_dim_merchant,
}
# Of a written table: what one task may sort alone, and what every executor may hold. Its
# Parquet files take less than a tenth of the memory its rows do.
SMALL_FILE_BYTES = 8 * 1024 * 1024
# How many raw rows a distinct one stands for; no column of a file is called so.
COPIES = "_copies"


def _write_counted(df: DataFrame, root: str, name: str) -> int:
    """Write a table; how many rows its files hold, by their footers."""
    write_staged(df, root, name)
    return df.sparkSession.read.parquet(f"{root}/{name}").count()


def _write_standard(raw: DataFrame, root: str) -> dict[str, int]:
    """Write the standard rows and count every step on the way, in the one pass over raw.

    A step is counted where nothing is counted twice if executors are lost: in the tasks that
    write, of which Spark takes each once, or in the written files. The raw rows are the copies
    of the distinct ones.
    """
    seen = Observation()
    rows = raw.transform(drop_exact_duplicates, copies=COPIES).observe(
        seen, F.count(F.lit(1)).alias("distinct"), F.sum(COPIES).alias("raw")
    )
    rows = rows.drop(COPIES).transform(require_columns).transform(parse_mixed_timestamps)
    rows = rows.transform(cast_numbers).transform(flag_suspicious).transform(calendar_parts)
    write_staged(rows, root, STANDARD_TABLE)
    try:
        came, distinct = seen.get["raw"], seen.get["distinct"]
    except Py4JJavaError:
        if not raw.isEmpty():
            raise
        came = distinct = 0  # Spark left an empty plan, and its counting, out
    written = raw.sparkSession.read.parquet(f"{root}/{STANDARD_TABLE}")
    kept, dated = written.agg(F.count(F.lit(1)), F.count("TransactionDate")).first()
    return {
        "raw": came or 0,
        "deduplicated": distinct,
        "required": kept,
        "clean": dated,
        "null_dates": kept - dated,
    }


def stage_star(
    raw: DataFrame, staged_root: str, small_file_bytes: int = SMALL_FILE_BYTES
) -> dict[str, int]:
    """Write the standard rows, the dimensions and the fact, each from written input.

    The only wide shuffle is the deduplication, and it runs once: the dimensions read
    their few columns of its written result, and the fact joins the written dimensions,
    so its keys are theirs. Dimensions whose files exceed ``small_file_bytes`` are numbered
    in ranges and joined by shuffle. All tables become current together, when the last is written;
    until then, and if the run fails, ``read_staged`` finds those of the run before. Returns the
    rows of every step and table, as committed; intermediate tables are removed.
    """
    compiled(raw.sparkSession)
    with new_version(raw.sparkSession, staged_root) as root:
        return _write_star(raw, root, small_file_bytes)


def _write_star(raw: DataFrame, root: str, small_file_bytes: int) -> dict[str, int]:
    spark = raw.sparkSession
    store = Store(spark)
    counts = _write_standard(raw, root)
    clean = drop_unparsed(read_staged(spark, root, STANDARD_TABLE))
    for name, build in DIMENSIONS.items():
        counts[name] = _write_counted(build(clean), root, name)
    with scratch(spark):
        place = fresh_dir(spark, "types")
        transaction_types(clean).write.parquet(place)
        types = spark.read.parquet(place)
        if store.size(place) <= small_file_bytes:
            types = assign_key(types, "transaction_type", "type_id")
        else:
            ranged = materialise(in_ranges(types, "transaction_type"), "ranges")
            types = assign_key_in_ranges(ranged, "transaction_type", "type_id")
        counts["dim_transaction_type"] = _write_counted(types, root, "dim_transaction_type")
        small = {
            name: store.size(f"{root}/{name}") <= small_file_bytes
            for name in ("dim_date", "dim_transaction_type")
        }
        hot = None
        if not small["dim_transaction_type"]:
            hot = materialise(hot_keys(clean, ["TransactionType"]), "hot")
        fact = build_fact(
            clean,
            read_staged(spark, root, "dim_date"),
            read_staged(spark, root, "dim_transaction_type"),
            small["dim_date"],
            small["dim_transaction_type"],
            hot,
        )
        counts["fact_transactions"] = _write_counted(fact, root, "fact_transactions")
    return counts


def audit_frame(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """``(stage, row_count)``, one row for each count."""
    return spark.createDataFrame(list(counts.items()), "stage string, row_count bigint").coalesce(1)


def run_transform(
    spark: SparkSession,
    raw_root: str,
    staged_root: str,
    raw_format: str = "csv",
    infer_schema: bool = False,
    set_apart: bool = False,
) -> DataFrame:
    """Rebuild the staged star from all raw rows; returns the audit.

    ``raw_format`` is ``csv`` for folders of drops, ``parquet`` for the raw zone. With
    ``infer_schema``, for CSV only, values are typed as they are read, so rows that differ in
    how a number is written are equal. Rows of CSV with a wrong number of fields fail the run; with
    ``set_apart`` they are left out and counted as ``broken``. Shuffles are sized for the bytes
    that the raw rows have as text, whatever format they are in.
    The audit's numbers are those of the pass that built the star.
    """
    if (infer_schema or set_apart) and raw_format != "csv":
        raise ValueError("the raw zone holds checked text; only CSV can be read with these")
    if raw_format == "csv":
        raw = read_raw(spark, raw_root, infer_schema, set_apart)
        size = Store(spark).size(raw_root)
    else:
        raw = read_raw_zone(spark, raw_root)
        size = text_bytes(raw)
    with sized_for(spark, size):
        counts = stage_star(raw, staged_root)
        if set_apart:
            counts["broken"] = broken_rows(spark, raw_root).count()
        return audit_frame(spark, counts)


def run_load(
    spark: SparkSession,
    staged_root: str,
    target: str,
    fmt: str = "table",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Replace the five warehouse tables together; returns how many rows each has now.

    Behind a connector that can only write the count is that of the rows sent.
    """
    load_star(spark, staged_root, target, fmt, options)
    root = current_root(spark, staged_root)
    loaded = {}
    for name in STAR_TABLES:
        table = f"{target}.{name.upper()}"
        if fmt == "table":
            loaded[name] = spark.table(table)
        else:
            found = connector_table(spark, table, fmt, options or {})
            loaded[name] = found or read_staged(spark, root, name)
    return row_counts(loaded)


@dataclass
class PipelineConfig:
    """Where one run of the whole job reads and writes."""

    landing: str
    raw_root: str
    checkpoint: str
    staged_root: str
    target: str
    archive: str | None = None
    fmt: str = "table"
    options: dict[str, str] = field(default_factory=dict)
    ingest_date: str | None = None
    max_bytes_per_trigger: int | None = None


def run_pipeline(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """Ingest, transform, load; an error ends the run there.

    Returns the audit, and the rows each warehouse table has now as ``loaded_`` stages.
    """
    ingest_landing(
        spark,
        cfg.landing,
        cfg.raw_root,
        cfg.checkpoint,
        cfg.archive,
        cfg.ingest_date,
        cfg.max_bytes_per_trigger,
    )
    audit = run_transform(spark, cfg.raw_root, cfg.staged_root, "parquet")
    loaded = run_load(spark, cfg.staged_root, cfg.target, cfg.fmt, cfg.options)
    named = loaded.select(F.concat(F.lit("loaded_"), "stage").alias("stage"), "row_count")
    return audit.unionByName(named)
