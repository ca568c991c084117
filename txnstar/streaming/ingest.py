"""Take new CSV drops into the raw zone: each content once, none lost, and no file holding up others.

A file is its path, modification time and length. The state folder holds a ledger: the files
each batch takes, written before the batch, and the files it refuses with the reason. Empty
files say which batches are ``planned``, ``done`` and ``away``, and which were given up as ``void``.
A batch writes a folder of its own, so repeating it after a crash replaces it. Headers and
identities are read, compared and moved by executors; the driver's calls do not grow with the files.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from txnstar.schema import INGEST_DATE, RAW_COLUMNS, text_schema
from txnstar.sources.raw import (
    BATCH,
    BROKEN,
    COLUMNS_FOLDER,
    REJECTED_FOLDER,
    contract_columns,
    csv_reader,
)
from txnstar.sources.store import Store

log = logging.getLogger(__name__)
DROPS = "*.csv"
FILE = "path string, modified bigint, length bigint"
DECIDED = f"{FILE}, header array<string>, reason string"
LEDGER = f"{DECIDED}, day string"
IDENTITY = ["path", "modified", "length"]
# Executors read a file up to this size to see its header, of which this much counts; the
# driver opens larger ones, of which there are few for their bytes.
CONTENT_BYTES = 64 * 1024 * 1024
HEADER_BYTES = 1024 * 1024
# Finished batches after which their ledgers become one.
COMPACT_AFTER = 16
ATTEMPTS = 3
# Spark finds each of many named files by a task of its own, up to 10,000; for each core so many do.
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTING_TASKS = 4
_FIELD = r'(?:^|,)("(?:[^"]|"")*"|[^,]*)'
_FIRST_LINE = r"^\uFEFF?(?:[ \t]*\r?\n)*([^\r\n]*)"


def header_names(line: Column) -> Column:
    """The column names in the first line of a CSV file; none if the line is blank."""
    quoted = lambda x: F.replace(x.substr(F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))
    fields = F.transform(
        F.regexp_extract_all(line, F.lit(_FIELD), F.lit(1)),
        lambda x: F.when(x.startswith('"'), quoted(x)).otherwise(x),
    )
    return F.when(F.trim(line) == "", F.array().cast("array<string>")).otherwise(fields)


def refusal(names: Column) -> Column:
    """Why a file with these column names can't be taken, NULL if it can."""
    lower = F.transform(names, F.lower)
    twice = F.filter(F.array_distinct(lower), lambda x: F.size(F.filter(lower, lambda y: y == x)) > 1)
    odd = F.filter(names, lambda x: (x == "") | (x != F.trim(x)))
    taken = F.array_intersect(lower, F.array(*[F.lit(c) for c in (INGEST_DATE, BATCH, BROKEN, "_copies")]))
    contract = F.array(*[F.lit(c) for c in RAW_COLUMNS])
    missing = F.filter(contract, lambda c: ~F.array_contains(lower, F.lower(c)))
    reason = F.when(F.size(names) == 0, F.lit(None).cast("string"))  # an empty file has no rows
    for found, says in (
        (twice, "columns that appear more than once: "),
        (odd, "column names that are empty or have blanks around them: "),
        (taken, "column names that the raw zone uses itself: "),
        (missing, "columns that are missing: "),
    ):
        reason = reason.when(F.size(found) > 0, F.concat(F.lit(says), F.array_join(found, ", ")))
    return reason


def _mover(archive: str) -> callable:
    """Moves files to their batch's folder, wherever ``pyarrow`` reaches; says which it did."""

    def rows(batches: Iterator) -> Iterator:
        import posixpath

        import pyarrow as pa
        from pyarrow import fs

        def at(path: str) -> tuple:
            if path.startswith("file:"):
                return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
            return fs.FileSystem.from_uri(path)

        def move(path: str, name: str) -> bool:
            try:
                store, source = at(path)
                other, folder = at(f"{archive}/{name}")
                target = posixpath.join(folder, posixpath.basename(source))
                kinds = [x.type for x in other.get_file_info([source, target])]
                if fs.FileType.NotFound == kinds[0]:  # moved by an earlier attempt of the task
                    return fs.FileType.File == kinds[1]
                other.create_dir(folder, recursive=True)
                store.move(source, target)
            except (OSError, ValueError, NotImplementedError):
                return False
            return True

        for batch in batches:
            paths, names = (batch.column(c).to_pylist() for c in ("path", "name"))
            moved = [move(*x) for x in zip(paths, names, strict=True)]
            yield pa.record_batch(
                {**{c: batch.column(c) for c in ("path", "name")}, "moved": pa.array(moved, pa.bool_())}
            )

    return rows


@contextmanager
def _listed_in_few(spark: SparkSession) -> Iterator[None]:
    """Within it the files a reader is given by name are found in a few tasks, many in each."""
    before = spark.conf.get(LISTING)
    most = LISTING_TASKS * spark.sparkContext.defaultParallelism
    spark.conf.set(LISTING, min(int(before), most))
    try:
        yield
    finally:
        spark.conf.set(LISTING, before)


@dataclass
class _Zone:
    spark: SparkSession
    landing: str
    raw_root: str
    state: str
    archive: str | None
    store: Store

    def waiting(self) -> DataFrame:
        """The files in the landing folder, of any age; only names and sizes are read."""
        if not self.store.exists(self.landing):
            return self.spark.createDataFrame([], FILE)
        return self._files().select(
            "path", F.unix_millis("modificationTime").alias("modified"), "length"
        )

    def _files(self) -> DataFrame:
        files = self.spark.read.format("binaryFile").option("pathGlobFilter", DROPS)
        return files.option("ignoreMissingFiles", True).load(self.landing)

    def compacted(self) -> str:
        """The last batch whose ledger is in the snapshot; all earlier ones are too."""
        return max(self.store.names(f"{self.state}/compacted"), default="")

    def marked(self, step: str) -> set[str]:
        """The batches after the snapshot that got as far as ``step``."""
        last = self.compacted()
        return {name for name in self.store.names(f"{self.state}/{step}") if name > last}

    def mark(self, step: str, name: str) -> None:
        self.store.touch(f"{self.state}/{step}/{name}")

    def ledger(self, batches: set[str], snapshot: str = "") -> DataFrame:
        paths = [f"{self.state}/files/{b}" for b in sorted(batches)]
        paths += [f"{self.state}/snapshots/{snapshot}"] if snapshot else []
        if not paths:
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(LEDGER).parquet(*paths)

    def seen(self) -> DataFrame:
        """All files that a batch took or refused."""
        return self.ledger(self.marked("planned") - self.marked("void"), self.compacted())

    def _pending(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.state}/pending/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def decide(self) -> DataFrame:
        """New files with their headers, and the reason where one is refused; written once."""
        new = self._pending("new", self.waiting().join(self.seen(), IDENTITY, "left_anti"))
        large = F.col("length") > CONTENT_BYTES
        totals = new.agg(F.min("modified").alias("oldest"), F.bool_or(large).alias("large")).first()
        if totals.oldest is None:
            return self._pending("decided", self.spark.createDataFrame([], DECIDED))
        begin = F.substring("content", 1, HEADER_BYTES).cast("string")
        lines = (
            self._files()
            .filter(F.col("modificationTime") >= F.timestamp_millis(F.lit(totals.oldest)))
            .filter(F.col("length") <= CONTENT_BYTES)
            .select(
                "path",
                F.unix_millis("modificationTime").alias("modified"),
                "length",
                F.regexp_extract(begin, _FIRST_LINE, 1).alias("line"),
            )
        )
        if totals.large:
            rows = [(*r, self.store.first_line(r.path)) for r in new.filter(large).collect()]
            lines = lines.union(self.spark.createDataFrame(rows, f"{FILE}, line string"))
        names = lines.join(new, IDENTITY, "left_semi").select(
            *IDENTITY, header_names(F.col("line")).alias("header")
        )
        return self._pending("decided", names.withColumn("reason", refusal(F.col("header"))))

    def plan(self, files: DataFrame, day: str) -> str:
        """Note which files the next batch takes and refuses; from here on it will be done."""
        name = f"{dt.datetime.now(dt.UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
        last = max([self.compacted(), *self.store.names(f"{self.state}/planned")])
        if name <= last:  # the clock went back
            name = f"{last}-{uuid.uuid4().hex[:8]}"
        rows = files.withColumn("day", F.lit(day))
        rows.coalesce(1).write.parquet(f"{self.state}/files/{name}")
        self.mark("planned", name)
        return name

    def finish(self, name: str) -> int:
        """Write a planned batch, or write it again, and note that it is done.

        If a file of it changed or went since the plan, the batch is given up before it counts:
        what it wrote is removed, and its files are new again, as they are by then.
        """
        rows = self.ledger({name}).filter("reason IS NULL")
        day = rows.select("day").first()
        count = 0
        if day is not None:
            place = f"{self.raw_root}/{INGEST_DATE}={day.day}/{BATCH}={name}"
            if not self._still_there(rows):
                return self._give_up(name, place)
            count, refused = self._write(name, day.day, rows)
            if not self._still_there(rows):
                return self._give_up(name, place)
            if refused:
                where = f"{self.raw_root}/{REJECTED_FOLDER}"
                log.warning("%d rows with a wrong number of fields are in %s", refused, where)
        self.mark("done", name)
        return count

    def _still_there(self, rows: DataFrame) -> bool:
        return rows.join(self.waiting(), IDENTITY, "left_anti").isEmpty()

    def _give_up(self, name: str, place: str) -> int:
        log.warning("a file changed or went while batch %s was taking it; its files count as new", name)
        for path in (place, *[f"{self.raw_root}/{x}/{BATCH}={name}" for x in (COLUMNS_FOLDER, REJECTED_FOLDER)]):
            self.store.delete(path)
        self.mark("void", name)
        return 0

    def _write(self, name: str, day: str, files: DataFrame) -> tuple[int, int]:
        """Rows of files with the same header are read together, all headers written at once."""
        groups = files.filter("size(header) > 0").groupBy("header")
        groups = groups.agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("paths")
        groups = groups.collect()
        if not groups:
            return 0, 0
        parts, columns = [], []
        for header, paths in groups:
            known = {c.lower() for c in columns}
            columns += [c for c in header if c.lower() not in known]
            schema = text_schema(list(header)).add(BROKEN, "string")
            rows = csv_reader(self.spark).option("columnNameOfCorruptRecord", BROKEN)
            with _listed_in_few(self.spark):
                parts.append(rows.schema(schema).csv(paths))
        counts = Observation()
        every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        every = every.observe(
            counts, F.count(F.lit(1)).alias("rows"), F.count(F.col(BROKEN)).alias("refused")
        )
        good = every.filter(F.col(BROKEN).isNull()).select(*contract_columns(columns))
        noted = [(i, c.name) for i, c in enumerate(good.schema)]
        noted = self.spark.createDataFrame(noted, "position int, name string").coalesce(1)
        place = f"{BATCH}={name}"
        noted.write.mode("overwrite").parquet(f"{self.raw_root}/{COLUMNS_FOLDER}/{place}")
        good.write.mode("overwrite").parquet(f"{self.raw_root}/{INGEST_DATE}={day}/{place}")
        found = counts.get
        if found["refused"]:
            bad = every.filter(F.col(BROKEN).isNotNull()).write.mode("overwrite")
            bad.parquet(f"{self.raw_root}/{REJECTED_FOLDER}/{place}")
        return found["rows"] - found["refused"], found["refused"]

    def put_away(self) -> None:
        """Move the files of batches that are done, if they still are what was read.

        Executors move them; the driver moves what ``pyarrow`` does not reach.
        """
        names = sorted(self.marked("done") - self.marked("away"))
        if not names:
            return
        rows = [
            self.ledger({name}).filter("reason IS NULL").withColumn("name", F.lit(name))
            for name in names
        ]
        rows = reduce(DataFrame.union, rows).join(self.waiting(), IDENTITY, "left_semi")
        rows = self._pending("away", rows.select("path", "name"))
        target = self.store.qualified(self.archive)
        spread = rows.repartition(self.spark.sparkContext.defaultParallelism)
        moved = spread.mapInArrow(_mover(target), "path string, name string, moved boolean")
        for r in self._pending("moved", moved).filter("NOT moved").toLocalIterator():
            self.store.move(r.path, f"{self.archive}/{r.name}")
        for name in names:
            self.mark("away", name)

    def compact(self) -> None:
        """Put the ledgers of finished batches into one snapshot, and remove them."""
        planned, void = sorted(self.marked("planned")), self.marked("void")
        settled = self.marked("away" if self.archive else "done") | void
        ended = []
        for name in planned:
            if name not in settled:
                break
            ended.append(name)
        if len(ended) < COMPACT_AFTER:
            return
        before, last = self.compacted(), ended[-1]
        rows = self.ledger(set(ended) - void, before)
        rows.write.mode("overwrite").parquet(f"{self.state}/snapshots/{last}")
        self.mark("compacted", last)  # from here on the older ones are not read
        for name in ended:
            for step in ("files", "planned", "done", "away", "void"):
                self.store.delete(f"{self.state}/{step}/{name}")
        if before:
            self.store.delete(f"{self.state}/snapshots/{before}")
            self.store.delete(f"{self.state}/compacted/{before}")


def _portions(files: DataFrame, most: int | None) -> list[DataFrame]:
    """Files in order of their names, as many together as have ``most`` bytes.

    Names and sizes stream by the driver, which keeps the first name of each portion.
    """
    if not most:
        return [files]
    starts: list[str] = []
    room = 0
    for r in files.select("path", "length").orderBy("path").toLocalIterator():
        if not starts or r.length > room:
            starts.append(r.path)
            room = most
        room -= r.length
    out = []
    for low, high in zip(starts, [*starts[1:], None], strict=True):
        part = files.filter(F.col("path") >= low)
        out.append(part if high is None else part.filter(F.col("path") < high))
    return out


def refused_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``(path, modified, length, day, reason)`` of every file that ingest has refused."""
    state = checkpoint.rstrip("/")
    zone = _Zone(spark, "", "", state, None, Store(spark))
    return zone.seen().filter("reason IS NOT NULL").select(*IDENTITY, "day", "reason")


def ingest_landing(
    spark: SparkSession,
    landing: str,
    raw_root: str,
    checkpoint: str,
    archive: str | None = None,
    ingest_date: dt.date | str | None = None,
    max_bytes_per_trigger: int | None = None,
) -> bool:
    """Take every new file in ``landing`` into ``raw_root/ingest_date=.../`` and stop.

    New is a file whose path, modification time and length no batch took or refused, whatever its
    age: a name sent again with other content is taken again. Files may differ in their headers, in
    the order and in additional columns. A file that lacks a column of the contract, names one
    twice, or has names the raw zone can't hold is refused: it stays where it is, ``refused_files``
    and a warning say why, and all others come in. Rows with a wrong number of fields go to
    ``raw_root/_rejected`` and are counted in a warning.

    ``checkpoint`` keeps the ledger. A rerun takes nothing twice, and finishes first what a
    crash left undone; a file that changed or went meanwhile is left out, or taken as what it is
    by then. One run at a time. With ``archive``, the files of a batch move to a folder
    of their own there once it is done. ``max_bytes_per_trigger`` bounds a batch after a long
    outage. Returns whether any rows came in.
    """
    landing, raw_root, checkpoint = (p.rstrip("/") for p in (landing, raw_root, checkpoint))
    zone = _Zone(spark, landing, raw_root, checkpoint, archive, Store(spark))
    undone = zone.marked("planned") - zone.marked("done") - zone.marked("void")
    came = sum(zone.finish(name) for name in sorted(undone))
    day = str(ingest_date) if ingest_date else str(spark.sql("SELECT current_date()").first()[0])
    for attempt in range(ATTEMPTS):
        given_up = len(zone.marked("void"))
        new = zone.decide()
        if new.isEmpty():
            if not attempt:
                log.warning("no new files in the landing folder %s", landing)
            break
        refused = new.filter("reason IS NOT NULL")
        for r in refused.groupBy("reason").agg(F.count("*").alias("n"), F.min("path").alias("path")).collect():
            log.warning("refused %d files, %s among them: %s", r.n, r.path, r.reason)
        for portion in _portions(new, max_bytes_per_trigger):
            came += zone.finish(zone.plan(portion, day))
        if len(zone.marked("void")) == given_up:
            break
    if archive:
        zone.put_away()
    zone.compact()
    return came > 0
