"""Raw transactions: CSV drops as they came, or the raw zone that ingest fills."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnstar.schema import INGEST_DATE, RAW_COLUMNS, RAW_ZONE_SCHEMA, text_schema
from txnstar.sources.store import Store

# Beside the rows of the raw zone: the columns each batch had, and rows that were refused.
COLUMNS_FOLDER = "_columns"
REJECTED_FOLDER = "_rejected"
BATCH = "batch"
# A whole line that has too many or too few fields; no column of a file is called so.
BROKEN = "_broken_line"


def contract_columns(columns: list[str]) -> list[Column]:
    """Of a file with these ``columns``, the contract's in its order, then any others.

    Others stay because they are part of what makes two raw rows equal.
    """
    found = {c.lower() for c in columns}
    missing = [c for c in RAW_COLUMNS if c.lower() not in found]
    if missing:
        raise ValueError(f"raw files lack the columns {missing}")
    known = {c.lower() for c in RAW_COLUMNS}
    names = RAW_COLUMNS + [c for c in columns if c.lower() not in known]
    return [F.col(f"`{c}`").alias(c) for c in names]


def csv_reader(spark: SparkSession) -> DataFrameReader:
    """Files with a header and RFC 4180 quotes: a quote within quotes is written twice.

    A line is a row, so files split; a line break within quotes is not read as part of a value
    but makes two rows with too few fields, and those are refused.
    """
    return (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("quote", '"')
        .option("escape", '"')
    )


def _scan(spark: SparkSession, root: str, infer_schema: bool) -> tuple[DataFrame, list[str]]:
    """All lines, with those of a wrong number of fields whole in ``BROKEN``; the file's columns.

    Every line is parsed to its end whatever columns are asked for, else a broken one would pass
    unseen where few are.
    """
    reader = csv_reader(spark).option("columnPruning", False)
    found = reader.option("inferSchema", infer_schema).csv(root)
    columns = [c for c in found.columns if c != "date"]
    contract_columns(columns)
    schema = T.StructType([*found.schema.fields, T.StructField(BROKEN, T.StringType())])
    rows = reader.schema(schema).option("columnNameOfCorruptRecord", BROKEN).csv(root)
    return rows, columns


def _parsed(columns: list[str]) -> Column:
    """Always true, and takes a column to tell: Spark reads no lines for the broken ones alone."""
    return F.coalesce(F.length(F.col(f"`{columns[0]}`").cast("string")), F.lit(0)) >= 0


def read_raw(
    spark: SparkSession, root: str, infer_schema: bool = False, set_apart: bool = False
) -> DataFrame:
    """All CSV files under ``root/date=YYYY-MM-DD/``, all values as text.

    The header names the columns, in any order; a file whose header differs from the
    others' fails the read instead of shifting values. So does a row with another number of
    fields, whatever columns are read of it; with ``set_apart`` such rows are left out, and
    ``broken_rows`` has them. The folder's date becomes ``ingest_date``, so a filter on it prunes
    folders. ``infer_schema`` costs a pass over the data and may take identifiers such as ``T1`` for
    times of day; with it, rows that write a number in two ways are equal.
    """
    df, columns = _scan(spark, root, infer_schema)
    wrong = F.raise_error(F.concat(F.lit("MALFORMED row in the raw files: "), F.col(BROKEN)))
    good = F.col(BROKEN).isNull() & _parsed(columns)
    # As a filter, so that it is asked for whatever columns are read.
    df = df.filter(good if set_apart else F.when(good, True).otherwise(wrong.cast("boolean")))
    cols = contract_columns(columns)
    if "date" in df.columns:
        cols.append(F.col("date").cast("date").alias(INGEST_DATE))
    return df.select(*cols)


def broken_rows(spark: SparkSession, root: str) -> DataFrame:
    """``(line, ingest_date)`` of the rows that ``read_raw`` sets apart."""
    df, columns = _scan(spark, root, False)
    cols = [F.col(BROKEN).alias("line")]
    if "date" in df.columns:
        cols.append(F.col("date").cast("date").alias(INGEST_DATE))
    return df.filter(F.col(BROKEN).isNotNull() & _parsed(columns)).select(*cols)


def zone_columns(spark: SparkSession, root: str) -> list[str]:
    """Every column any batch had, the contract's first, as ingest has noted them.

    Names that differ in case alone are one column, spelled as it first came.
    """
    noted = f"{root}/{COLUMNS_FOLDER}"
    if not Store(spark).names(noted):
        return RAW_COLUMNS
    schema = "position int, name string, batch string"
    rows = spark.read.schema(schema).parquet(noted).groupBy(F.lower("name").alias("lower"))
    first = rows.agg(F.min(F.struct("batch", "position", "name")).alias("at")).orderBy("at")
    known = {c.lower() for c in RAW_COLUMNS}
    return RAW_COLUMNS + [r["at"]["name"] for r in first.collect() if r["lower"] not in known]


def read_raw_zone(spark: SparkSession, root: str) -> DataFrame:
    """The Parquet raw zone with every column any drop had; no rows while it is empty.

    The columns come from ingest's notes, so no file's footer is read to find them.
    """
    if not any(name.startswith(f"{INGEST_DATE}=") for name in Store(spark).names(root)):
        return spark.createDataFrame([], RAW_ZONE_SCHEMA)
    names = zone_columns(spark, root)
    schema = text_schema(names).add(INGEST_DATE, T.DateType()).add(BATCH, T.StringType())
    return spark.read.schema(schema).parquet(root).drop(BATCH)
