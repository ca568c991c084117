"""Merkle manifest of a dataset: a tree whose parents keep the hash state before each child.

A row's leaf is the SHA-256 of its typed columns. Leaves of one source, in the order of their
ids, are hashed by runs of sixteen until one node is left, the source's subroot; subroots, in
the order of the sources, are hashed likewise into the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnstar.llm.frames import sized
from txnstar.llm.sha_state import STATE_BYTES, build, resume, to_states
from txnstar.sources.workdir import materialise

FANOUT = 16
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# monotonically_increasing_id() counts rows of a partition in its lower bits.
PLACE_BITS = 33
_LEAVES = "array<struct<slot:int,digest:binary,doc:bigint,altered:binary,tampered:boolean>>"
_LANE = "array<struct<slot:int,state:binary,children:binary>>"


def _field(value: Column) -> Column:
    text = value.cast("string")
    told = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(told, F.lit("-"))


def leaf_digest(**columns: Column) -> Column:
    """Hex SHA-256 of ``LEAF_COLUMNS``: ``-`` for NULL, else byte count, colon and value."""
    return F.sha2(F.concat(*[_field(columns[c]) for c in LEAF_COLUMNS]), 256)


def tampered(doc_id: Column) -> Column:
    """Rows whose text a report lower-cases: 5 divides the CRC-32 of the id's digits."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """``(key, doc, digest, altered, tampered, tie)`` for each row, written once.

    ``key`` orders like the source with NULL first and is never NULL. ``altered`` is the digest
    of the tampered row, NULL where nothing is tampered with.
    """
    own = {c: F.col(f"`{c}`") for c in LEAF_COLUMNS}
    lower = own | {"text": F.translate(own["text"], UPPER, UPPER.lower())}
    hit = tampered(own["doc_id"])
    source = own["source"].cast("string")
    rows = docs.select(
        F.coalesce(F.concat(F.lit("s"), source), F.lit("n")).alias("key"),
        own["doc_id"].cast("bigint").alias("doc"),
        F.unhex(leaf_digest(**own)).alias("digest"),
        F.when(hit, F.unhex(leaf_digest(**lower))).alias("altered"),
        hit.alias("tampered"),
        F.monotonically_increasing_id().alias("tie"),
    )
    return materialise(rows, "leaves")


def numbered(rows: DataFrame, group: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``pos``, 0.. within each group by ``order``, and ``(group, n)``.

    Rows are dealt by ranges of group and order, so a group of any size is split; a place in
    a range becomes a place in the group by the counts of the earlier ranges, of which there is
    one row for each group and range it touches. ``order`` must tell rows apart for the ranges
    to be even.
    """
    cols = [F.col(group), *[F.col(c) for c in order]]
    placed = rows.repartitionByRange(*cols).sortWithinPartitions(*cols)
    placed = materialise(placed.withColumn("_place", F.monotonically_increasing_id()), "placed")
    span = F.shiftright("_place", PLACE_BITS).alias("_range")
    pieces = placed.groupBy(group, span).agg(
        F.min("_place").alias("_first"), F.count("*").alias("_rows")
    )
    pieces = materialise(pieces, "pieces")
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("_rows").over(before), F.lit(0))
    shift = pieces.select(group, "_range", (earlier - F.col("_first")).alias("_shift"))
    shift = sized(materialise(shift, "shift"), 64)
    found = placed.withColumn("_range", F.shiftright("_place", PLACE_BITS)).join(
        shift, [group, "_range"]
    )
    found = found.withColumn("pos", F.col("_place") + F.col("_shift"))
    counts = pieces.groupBy(group).agg(F.sum("_rows").alias("n"))
    return found.drop("_place", "_range", "_shift"), materialise(counts, "counts")


def _bytes_of(column: pa.Array, width: int) -> np.ndarray:
    """Equally long binary values as rows of bytes."""
    column = column.cast(pa.binary(width))
    raw = np.frombuffer(column.buffers()[1], np.uint8)
    return raw.reshape(-1, width)[column.offset : column.offset + len(column)]


def _binaries(rows: np.ndarray, ends: np.ndarray) -> pa.Array:
    """One binary value for the rows of bytes up to each of ``ends``."""
    offsets = (np.concatenate([[0], ends]) * rows.shape[1]).astype(np.int32)
    data = pa.py_buffer(np.ascontiguousarray(rows).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), data])


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)])[:-1].astype(np.int64)


def _parents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of runs of children, their digests, the states before each, and the parent's digest."""
    for batch in batches:
        if not batch.num_rows:
            continue
        nodes = batch.column("nodes")
        sizes = np.diff(np.asarray(nodes.offsets)).astype(np.int64)
        pool = _bytes_of(nodes.flatten().field("digest"), STATE_BYTES)
        states, digests = build(pool, _starts(sizes), sizes)
        ends = np.cumsum(sizes)
        yield pa.record_batch(
            {
                **{c: batch.column(c) for c in batch.schema.names},
                "children": _binaries(pool, ends),
                "states": _binaries(states, ends),
                "digest": _binaries(digests, np.arange(1, len(sizes) + 1)),
            }
        )


def _runs(nodes: DataFrame, payload: list[str], kinds: str) -> DataFrame:
    """``(key, run, n, nodes, children, states, digest)``, a row for each run of sixteen."""
    slot = F.pmod("pos", F.lit(FANOUT)).cast("int").alias("slot")
    run = F.shiftright("pos", 4).alias("run")
    runs = (
        nodes.groupBy("key", run)
        .agg(F.first("n").alias("n"), F.collect_list(F.struct(slot, *payload)).alias("nodes"))
        .select("key", "run", "n", F.array_sort("nodes").cast(kinds).alias("nodes"))
    )
    schema = f"key string, run bigint, n bigint, nodes {kinds}, children binary, states binary, digest binary"
    return materialise(runs.mapInArrow(_parents, schema), "runs")


def tree(nodes: DataFrame, most: int, payload: list[str], kinds: str) -> list[DataFrame]:
    """The written levels of runs over ``nodes (key, pos, n, digest)``, lowest first.

    ``most`` is the largest ``n``. The lowest level also keeps ``payload`` of its nodes. Keys
    of one node have no run.
    """
    levels: list[DataFrame] = []
    while most > 1:
        levels.append(_runs(nodes.filter("n > 1"), payload, kinds))
        above = ((F.col("n") + FANOUT - 1) / FANOUT).cast("bigint").alias("n")
        nodes = levels[-1].select("key", F.col("run").alias("pos"), above, "digest")
        payload, kinds = ["digest"], "array<struct<slot:int,digest:binary>>"
        most = -(-most // FANOUT)
    return levels


def tops(nodes: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """``(key, digest)`` of the one node in which each key ends."""
    found = nodes.filter("n = 1").select("key", "digest")
    for runs in levels:
        found = found.union(runs.filter(f"n <= {FANOUT}").select("key", "digest"))
    return materialise(found, "tops")


def _entry(slot: Column) -> Column:
    """What a fold at ``slot`` of a run needs, and the run's digests for the proof."""
    state = F.substring("states", slot * STATE_BYTES + 1, F.lit(STATE_BYTES))
    return F.struct(slot.alias("slot"), state.alias("state"), F.col("children").alias("children"))


def lanes(levels: list[DataFrame], last: DataFrame | None) -> list[DataFrame]:
    """For each level ``(key, run, lane)``: the entries above a run, up to the root.

    ``last`` is ``(key, top)``, the lane above a key's own top; without it that lane is empty.
    """
    none = F.expr(f"cast(array() as {_LANE})")
    out: list[DataFrame] = []
    for depth in range(len(levels) - 1, -1, -1):
        runs = levels[depth].select("key", "run", "n")
        top = runs.filter(f"n <= {FANOUT}").select("key", "run")
        if last is None:
            found = top.select("key", "run", none.alias("lane"))
        else:
            found = top.join(last, "key").select("key", "run", F.col("top").alias("lane"))
        if depth + 1 < len(levels):
            above = levels[depth + 1].select("key", F.col("run").alias("up"), "children", "states")
            above = above.join(out[0].withColumnRenamed("run", "up"), ["key", "up"])
            # At most 16 rows of up to 600 bytes and as much again for each level of the lane.
            above = sized(materialise(above, "above"), 1200 * (len(levels) + 4))
            below = runs.filter(f"n > {FANOUT}").withColumn("up", F.shiftright("run", 4))
            entry = _entry(F.pmod("run", F.lit(FANOUT)).cast("int"))
            below = below.join(above, ["key", "up"]).select(
                "key", "run", F.concat(F.array(entry), F.col("lane")).cast(_LANE).alias("lane")
            )
            found = found.union(below)
        out.insert(0, materialise(found, "lanes"))
    return out


def _fold_report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Proof and refolded root of every leaf of some runs."""
    for batch in batches:
        if not batch.num_rows:
            continue
        nodes, lane = batch.column("nodes"), batch.column("lane")
        leaves, entries = nodes.flatten(), lane.flatten()
        sizes = np.diff(np.asarray(nodes.offsets)).astype(np.int64)
        depths = np.diff(np.asarray(lane.offsets)).astype(np.int64)
        first, lane_first = _starts(sizes), _starts(depths)
        pool = _bytes_of(leaves.field("digest"), STATE_BYTES)
        alone = np.asarray(batch.column("states").is_null())
        states = np.zeros((len(pool), STATE_BYTES), np.uint8)
        run_of = np.repeat(np.arange(len(sizes)), sizes)
        held = b"".join(s for s in batch.column("states").to_pylist() if s)
        states[~alone[run_of]] = np.frombuffer(held, np.uint8).reshape(-1, STATE_BYTES)

        # Every leaf as it is to be folded, and the digests of its parent.
        altered = leaves.field("altered")
        changed = np.asarray(altered.is_valid())
        folded = pool.copy()
        if changed.any():
            folded[changed] = _bytes_of(altered.drop_null(), STATE_BYTES)
        slot = np.arange(len(pool)) - first[run_of]
        on = np.flatnonzero(~alone[run_of])
        if len(on):
            right = sizes[run_of[on]] - slot[on] - 1
            size = sizes[run_of[on]]
            folded[on] = resume(to_states(states[on]), folded[on], pool, on + 1, right, size)

        # Leaves of a run that fold to the same parent share the way up from there.
        labelled = np.concatenate([run_of.astype(">i8")[:, None].view(np.uint8), folded], axis=1)
        ways, way_of = np.unique(labelled, axis=0, return_inverse=True)
        way_run = np.ascontiguousarray(ways[:, :8]).view(">i8").ravel().astype(np.int64)
        digest = np.ascontiguousarray(ways[:, 8:])
        if len(entries):
            children = entries.field("children")
            child_sizes = np.asarray(pc.binary_length(children)) // STATE_BYTES
            child_first = _starts(child_sizes)
            child_pool = np.frombuffer(b"".join(children.to_pylist()), np.uint8)
            child_pool = child_pool.reshape(-1, STATE_BYTES)
            lane_slot = np.asarray(entries.field("slot")).astype(np.int64)
            lane_state = _bytes_of(entries.field("state"), STATE_BYTES)
            for level in range(int(depths.max())):
                on = np.flatnonzero(depths[way_run] > level)
                at = lane_first[way_run[on]] + level
                right = child_sizes[at] - lane_slot[at] - 1
                begin = child_first[at] + lane_slot[at] + 1
                state = to_states(lane_state[at])
                digest[on] = resume(state, digest[on], child_pool, begin, right, child_sizes[at])
        folded = digest[way_of.ravel()]

        proofs = []
        lane_slots = entries.field("slot").to_pylist()
        lane_children = entries.field("children").to_pylist()
        digests = [row.tobytes().hex() for row in pool]
        for r in range(len(sizes)):
            above = []
            for e in range(lane_first[r], lane_first[r] + depths[r]):
                run = lane_children[e].hex()
                cut = 64 * lane_slots[e]
                above.append(run[:cut] + run[cut + 64 :])
            above = "".join(above).encode()
            run = "".join(digests[first[r] : first[r] + sizes[r]]).encode()
            for cut in range(0, 64 * int(sizes[r]), 64):
                proof = hashlib.sha256(run[:cut])
                proof.update(run[cut + 64 :])
                proof.update(above)
                proofs.append(proof.hexdigest())
        yield pa.record_batch(
            {
                "doc_id": leaves.field("doc"),
                "leaf": pa.array(digests, pa.string()),
                "subroot": pa.array(np.asarray(batch.column("subroot"))[run_of], pa.string()),
                "proof_sha256": pa.array(proofs, pa.string()),
                "folded_root": pa.array([row.tobytes().hex() for row in folded], pa.string()),
                "tampered": leaves.field("tampered"),
            }
        )


class Manifest:
    """The written tree of a table: leaves, levels of runs, subroots and the root."""

    def __init__(self, docs: DataFrame):
        rows, counts = numbered(leaves(docs), "key", ["doc", "digest", "tie"])
        self.counts = counts
        self.rows = rows.join(sized(counts, 64), "key")
        most = counts.agg(F.max("n")).first()[0] or 0
        self.levels = tree(
            self.rows, most, ["digest", "doc", "altered", "tampered"], _LEAVES
        )
        self.subroots = tops(self.rows, self.levels)
        one = self.subroots.select(F.lit("all").alias("key"), F.col("key").alias("name"), "digest")
        nodes, total = numbered(one, "key", ["name"])
        self.sources = nodes.join(F.broadcast(total), "key")
        sources = total.agg(F.max("n")).first()[0] or 0
        self.upper = tree(self.sources, sources, ["digest"], "array<struct<slot:int,digest:binary>>")
        found = tops(self.sources, self.upper).first()
        self.root: str | None = found["digest"].hex() if found else None

    def source_lanes(self) -> DataFrame:
        """``(key, top)``: the entries above each source's subroot."""
        none = F.expr(f"cast(array() as {_LANE})")
        if not self.upper:
            return self.sources.select(F.col("name").alias("key"), none.alias("top"))
        runs = self.upper[0].join(lanes(self.upper, None)[0], ["key", "run"])
        own = self.sources.withColumn("run", F.shiftright("pos", 4))
        entry = _entry(F.pmod("pos", F.lit(FANOUT)).cast("int"))
        way = F.concat(F.array(entry), F.col("lane")).cast(_LANE).alias("top")
        runs = sized(materialise(runs.drop("nodes", "digest"), "upper"), 6000)
        return own.select("name", "pos", "run").join(runs, "run").select(
            F.col("name").alias("key"), way
        )

    def ways(self) -> DataFrame:
        """``(key, nodes, states, lane, subroot)`` for every run of leaves.

        A source of one row is a run of its own without states: its leaf is the subroot.
        """
        last = sized(materialise(self.source_lanes(), "source_lanes"), 6000)
        names = sized(
            self.subroots.select("key", F.lower(F.hex("digest")).alias("subroot")), 128
        )
        slot = F.lit(0).alias("slot")
        lone = F.struct(slot, "digest", "doc", "altered", "tampered")
        single = self.rows.filter("n = 1").join(last, "key")
        single = single.select(
            "key",
            F.array(lone).cast(_LEAVES).alias("nodes"),
            F.lit(None).cast("binary").alias("states"),
            F.col("top").alias("lane"),
        )
        found = single
        if self.levels:
            above = lanes(self.levels, last)[0]
            runs = self.levels[0].select("key", "run", "nodes", "states").join(above, ["key", "run"])
            found = runs.select("key", "nodes", "states", "lane").union(single)
        return found.join(names, "key")


def tamper_report(docs: DataFrame) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, tampered)`` per row.

    ``folded_root`` is the root that follows when the row's leaf, recomputed from its tampered
    text where the rule says so, is folded with the siblings of the untampered tree. It resumes
    the state before the leaf's slot, and so on at each level; nothing left of a slot is hashed
    again. ``proof_sha256`` is that of the siblings, level by level, left to right.

    NULL columns are ``-`` in a leaf; a NULL source is a source and comes first. Rows without an
    id come first in their source and are not tampered with. Rows with equal ids are in the order of their
    leaves; equal rows take places next to one another, in any order. A table of one row has its leaf as root and
    the proof of no siblings; an empty table has no rows. Extra columns play no part.
    """
    manifest = Manifest(docs)
    schema = "doc_id bigint, leaf string, subroot string, proof_sha256 string, folded_root string, tampered boolean"
    found = manifest.ways().select("nodes", "states", "lane", "subroot")
    found = found.mapInArrow(_fold_report, schema)
    root = F.lit(manifest.root).cast("string")
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        root.alias("root"),
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == root).alias("verified"),
        "tampered",
    )


def _oracle(row_levels: int = 8, source_levels: int = 6) -> str:
    """The report in SQL: as many steps as 16**8 rows of a source and 16**6 sources need."""

    def field(col: str) -> str:
        return f"coalesce(octet_length(encode({col}::VARCHAR))::VARCHAR || ':' || {col}::VARCHAR, '-')"

    def steps(base: str, folds: str, count: int) -> str:
        out = ""
        for i in range(count):
            out += f""",
    {base}_runs{i} AS (
        SELECT k, pos // 16 AS run, string_agg(h, '' ORDER BY pos) AS txt, any_value(c) AS c
        FROM (SELECT *, count(*) OVER (PARTITION BY k) AS c FROM {base}{i})
        GROUP BY k, pos // 16),
    {base}{i + 1} AS (
        SELECT k, run AS pos, CASE WHEN c > 1 THEN sha256(txt) ELSE txt END AS h
        FROM {base}_runs{i}),
    {folds}{i + 1} AS (
        SELECT f.* EXCLUDE (c, l, r) REPLACE (
            f.pos // 16 AS pos,
            CASE WHEN c > 1 THEN f.proof || l || r ELSE f.proof END AS proof,
            CASE WHEN c > 1 THEN sha256(l || f.cur || r) ELSE f.cur END AS cur)
        FROM (
            SELECT f.*, c, left(txt, 64 * (f.pos % 16)) AS l, substr(txt, 64 * (f.pos % 16) + 65) AS r
            FROM {folds}{i} f JOIN {base}_runs{i} g ON g.k = f.k AND g.run = f.pos // 16) f)"""
        return out

    columns = " || ".join(field(c) for c in LEAF_COLUMNS)
    lower = columns.replace("text::", f"translate(text, '{UPPER}', '{UPPER.lower()}')::")
    return f"""
    WITH crc AS (
        SELECT doc_id AS hashed_id, list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda x : ord(x)::BIGINT),
            lambda c, b : list_reduce(list_prepend(xor(c, b), range(8)),
                lambda v, i : xor(v >> 1, 3988292384 * (v & 1))), 4294967295) AS c
        FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
    base AS (
        SELECT coalesce('s' || source, 'n') AS k, doc_id, sha256({columns}) AS leaf,
            sha256({lower}) AS lower_leaf, coalesce(xor(c, 4294967295) % 5 = 0, false) AS tampered
        FROM documents LEFT JOIN crc ON hashed_id = doc_id),
    f0 AS (
        SELECT k, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
            doc_id, leaf, tampered, '' AS proof,
            CASE WHEN tampered THEN lower_leaf ELSE leaf END AS cur
        FROM base),
    t0 AS (SELECT k, pos, leaf AS h FROM f0){steps("t", "f", row_levels)},
    s AS (SELECT k AS name, h, row_number() OVER (ORDER BY k) - 1 AS pos FROM t{row_levels}),
    u0 AS (SELECT 'all' AS k, pos, h FROM s),
    g0 AS (
        SELECT 'all' AS k, s.pos, f.doc_id, f.leaf, s.h AS subroot, f.tampered, f.proof, f.cur
        FROM f{row_levels} f JOIN s ON s.name = f.k){steps("u", "g", source_levels)}
    SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256,
        cur AS folded_root, cur = h AS verified, tampered
    FROM g{source_levels} g CROSS JOIN (SELECT h FROM u{source_levels})"""


ORACLE = _oracle()
