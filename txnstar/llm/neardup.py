"""Near-duplicate documents: fast similarity sketches, banding, exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnstar.llm.components import components, merge_components
from txnstar.llm.frames import first_rows, only, packed, sized
from txnstar.llm.sketch import band_keys, fast_sketches
from txnstar.llm.words import WordHashes, lower_words, mix64, shingle_set
from txnstar.sources.workdir import materialise

# 32 bands of 4: a pair at similarity 0.8 meets in none with probability 5e-8.
COORDINATES = 128
BAND_ROWS = 4
# What one side of a verification task holds.
BLOCK_SHINGLES = 24_000
BLOCK_MEMBERS = 1_000
BATCH_TEXTS = 256
# Times the members of a large group are dealt into blocks anew, to link most of what links.
DEALS = 2
# Shingles of a group that are known to be common there; more of them would only save time.
COMMON_SHINGLES = 16_384
_SIGN = -(1 << 63)


def class_key(doc: Column, digest: Column) -> Column:
    """Names a class of equal sets by its least id; classes that share the id stay apart.

    Keys order by id. An id whose rows have several sets can be the least of several classes.
    """
    ordered = F.lpad(F.hex(doc.bitwiseXOR(F.lit(_SIGN))), 16, "0")
    return F.concat(F.unhex(ordered), digest)


def key_doc(key: Column) -> Column:
    """The id in a class key."""
    unsigned = F.conv(F.hex(F.substring(key, 1, 8)), 16, 10).cast("decimal(20,0)")
    return (unsigned + F.lit(_SIGN).cast("decimal(20,0)")).cast("bigint")


def _signatures(k: int) -> callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_TEXTS):
                part = batch.slice(start, BATCH_TEXTS)
                sets = [
                    shingle_set(hashes.of(lower_words(t)), k) for t in part.column(1).to_pylist()
                ]
                sizes = np.array([len(s) for s in sets])
                owner = np.repeat(np.arange(len(sets)), sizes)
                sketches = fast_sketches(np.concatenate(sets), owner, len(sets), COORDINATES)
                keys = band_keys(sketches, BAND_ROWS).view(np.int64)
                offsets = np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32)
                digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
                yield pa.record_batch(
                    {
                        "doc": part.column(0),
                        "n": pa.array(sizes, pa.int64()),
                        "set": pa.array(digests, pa.binary()),
                        "keys": pa.ListArray.from_arrays(offsets, pa.array(keys.ravel())),
                    }
                )

    return rows


def linked_matrix(sets: list[np.ndarray], others: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of ``sets`` reach ``percent`` Jaccard similarity with which of ``others``.

    Shared shingles are counted by matrix products over the shingles that occur more than
    once, a few thousand columns at a time; the counts are exact.
    """
    every = sets + others
    sizes = np.array([len(s) for s in every])
    values, column, seen = np.unique(
        np.concatenate(every), return_inverse=True, return_counts=True
    )
    owner = np.repeat(np.arange(len(every)), sizes)
    shared = seen[column] > 1
    owner, column = owner[shared], (np.cumsum(seen > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((len(sets), len(others)), np.float32)
    step = 4096
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        a, b = np.searchsorted(column, [low, low + step])
        block = np.zeros((len(every), step), np.float32)
        block[owner[a:b], column[a:b] - low] = 1
        both += block[: len(sets)] @ block[len(sets) :].T
    both = both.astype(np.int64)
    union = sizes[: len(sets), None] + sizes[None, len(sets) :] - both
    return 100 * both >= percent * union


def _forest(nodes: np.ndarray, left: np.ndarray, right: np.ndarray, linked: np.ndarray) -> tuple:
    """Edges to the least node of each component of a two-sided link matrix."""
    n = nodes.max() + 1 if len(nodes) else 0
    label = np.arange(n)
    while True:
        before = label.copy()
        big = np.iinfo(np.int64).max
        low = np.where(linked, label[right][None, :], big).min(axis=1, initial=big)
        np.minimum.at(label, left, low)
        low = np.where(linked, label[left][:, None], big).min(axis=0, initial=big)
        np.minimum.at(label, right, low)
        if (label == before).all():
            break
    child = np.flatnonzero(label != np.arange(n))
    return label[child], child


def _linked(nodes: list[bytes], sets: list[np.ndarray], percent: int) -> pa.Table:
    """A spanning forest of the links within one block."""
    keys, rank = np.unique(np.array(nodes, object), return_inverse=True)
    root, child = _forest(rank, rank, rank, linked_matrix(sets, sets, percent))
    ends = [pa.array(list(keys[x]), pa.binary()) for x in (root, child)]
    return pa.table({"a": ends[0], "b": ends[1]})


def _verify(k: int, percent: int) -> callable:
    def links(table: pa.Table) -> pa.Table:
        hashes = WordHashes()
        texts = table.column("text").to_pylist()
        sets = [shingle_set(hashes.of(lower_words(t)), k) for t in texts]
        return _linked(table.column("node").to_pylist(), sets, percent)

    return links


def _sets_of(k: int) -> callable:
    """Whole shingle sets, as sorted 64-bit hashes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            sets = [shingle_set(hashes.of(lower_words(t)), k).tobytes() for t in texts]
            shingles = pa.array(sets, pa.binary())
            yield pa.record_batch({"set": batch.column("set"), "shingles": shingles})

    return rows


def _read_sets(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(b, np.uint64) for b in column.to_pylist()]


def _deal_links(percent: int) -> callable:
    """Links within a block, and the shingles that several of its members have."""

    def rows(table: pa.Table) -> pa.Table:
        sets = _read_sets(table.column("shingles"))
        found = _linked(table.column("node").to_pylist(), sets, percent)
        values, seen = np.unique(np.concatenate(sets), return_counts=True)
        common, n = values[seen > 1].view(np.int64), seen[seen > 1]
        hub = pa.array([table.column("hub")[0].as_py()], pa.binary())
        none = pa.nulls(len(common), pa.binary())
        shared = pa.table(
            {
                "a": none,
                "b": none,
                "hub": hub.take(pa.array(np.zeros(len(common), np.int32))),
                "shingle": pa.array(common),
                "seen": pa.array(n),
            }
        )
        return pa.concat_tables([found, shared], promote_options="default")

    return rows


def _prefixes(percent: int) -> callable:
    """The first shingles of each member in an order that all members of the group share.

    Shingles that are not known to be common come first, by hash, then the common ones, the
    rarest first. Two sets that reach the similarity share one of their first few shingles.
    """

    def rows(table: pa.Table) -> pa.Table:
        given = table.column("common").drop_null().to_pylist()
        common = np.frombuffer(given[0], ">u8").astype(np.uint64) if given else np.zeros(0, np.uint64)
        rank = np.argsort(common)
        known = common[rank]
        members = table.filter(table.column("common").is_null())
        salt = np.frombuffer(table.column("hub")[0].as_py()[:8], np.uint64)
        keys, places, owner = [], [], []
        sets = _read_sets(members.column("shingles"))
        for i, shingles in enumerate(sets):
            n = len(shingles)
            at = np.searchsorted(known, shingles)
            at[at == len(known)] = 0
            hit = known[at] == shingles if len(known) else np.zeros(n, bool)
            first = np.concatenate([shingles[~hit], common[np.sort(rank[at[hit]])]])
            first = first[: n - -(-percent * n // 100) + 1]
            keys.append(mix64(first ^ salt))
            places.append(np.arange(len(first)))
            owner.append(np.full(len(first), i))
        if not sets:
            keys, places, owner = [np.zeros(0, np.uint64)], [np.zeros(0, int)], [np.zeros(0, int)]
        owner = pa.array(np.concatenate(owner))
        return pa.table(
            {
                "key": pa.array(np.concatenate(keys).view(np.int64)),
                "set": members.column("set").take(owner),
                "component": members.column("component").take(owner),
                "n": members.column("n").take(owner),
                "pos": pa.array(np.concatenate(places).astype(np.int64)),
            }
        )

    return rows


def _pair_links(percent: int) -> callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            for x, y in zip(batch.column("sx").to_pylist(), batch.column("sy").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                links.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(links, pa.bool_()))

    return rows


def _with_sets(k: int) -> callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            sets = [shingle_set(hashes.of(lower_words(t)), k) for t in texts]
            digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            yield pa.record_batch(
                {
                    "doc": batch.column("doc"),
                    "set": pa.array(digests, pa.binary()),
                    "text": batch.column("text"),
                }
            )

    return rows


def _one_text_each(texts: DataFrame, sig: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """``(set, text)``, one row for each class of ``members``, however often ids repeat.

    An id of one row has the text of its class. Texts of other ids are told apart by their
    sets, and each task keeps one of a set before they are shuffled.
    """
    repeated = sig.filter("doc IS NOT NULL").groupBy("doc").agg(F.count("*").alias("_rows"))
    repeated = repeated.filter("_rows > 1").select(F.col("doc").alias("_doc"))
    repeated = sized(materialise(repeated, "repeated"), 16)
    classes = members.select(key_doc(F.col("node")).alias("node"), "set").distinct()
    classes = classes.join(repeated, F.col("node") == F.col("_doc"), "left")
    again = F.col("_doc").isNotNull().alias("again")
    wanted = sized(materialise(classes.select("node", "set", again), "wanted"), 48)
    once = texts.join(wanted.filter("NOT again"), F.col("doc") == F.col("node"))
    once = once.select("set", "text")
    if repeated.isEmpty():
        return once
    several = wanted.filter("again").select("node", F.col("set").alias("_set"))
    ids = several.select("node").distinct()
    several = (
        texts.join(ids, F.col("doc") == F.col("node"), "left_semi")
        .mapInArrow(_with_sets(k), "doc bigint, set binary, text string")
        .join(several, (F.col("doc") == F.col("node")) & (F.col("set") == F.col("_set")))
        .groupBy("set")
        .agg(F.first("text").alias("text"))
    )
    return once.union(materialise(several, "several"))


def _unresolved(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the groups that are not one component, with their components."""
    named = labels.withColumnRenamed("node", "_node")
    found = members.join(named, F.col("node") == F.col("_node"), "left")
    found = found.withColumn("component", F.coalesce("component", "node")).drop("_node")
    found = materialise(found, "components")
    several = found.groupBy("hub").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    several = sized(materialise(several.filter("x < y").select("hub"), "several"), 16)
    return found.join(several, "hub", "left_semi")


def _across(members: DataFrame, common: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components of a large group, each candidate pair verified on whole sets.

    Candidates share a shingle among so few of their first that sets at ``percent`` must; passages
    that a group has in common come last in everyone's order, so they bring nobody together.
    Of each such shingle's component with most members, none are paired with each other.
    """
    kept = ["hub", "i", "set", "component", "n", "shingles"]
    blocks = members.join(sets, "set").select(*kept, F.lit(None).cast("binary").alias("common"))
    none = [F.lit(None).cast(blocks.schema[c].dataType).alias(c) for c in kept[2:]]
    spread = members.select("hub", "i").distinct().join(sized(common, 8 * COMMON_SHINGLES), "hub")
    blocks = blocks.union(spread.select("hub", "i", *none, "common"))
    entries = blocks.groupBy("hub", "i").applyInArrow(
        _prefixes(percent), "key bigint, set binary, component binary, n bigint, pos bigint"
    )
    entries = materialise(entries, "prefixes")
    sizes = entries.groupBy("key", "component").agg(F.count("*").alias("c"))
    largest = sizes.groupBy("key").agg(
        F.max_by("component", F.struct("c", "component")).alias("largest"), F.count("*").alias("m")
    )
    largest = sized(materialise(largest.filter("m > 1").drop("m"), "shared"), 48)
    live = materialise(entries.join(largest, "key").distinct(), "live")
    apart = live.filter("component <> largest").select(
        "key", *[F.col(c).alias(f"{c}_x") for c in ("set", "component", "n", "pos")]
    )
    both = F.col("n") + F.col("n_x")
    needed = F.floor((percent * both + (99 + percent)) / (100 + percent))
    pairs = apart.join(live, "key").filter(
        (F.col("component") != F.col("component_x"))
        & (100 * F.least("n", "n_x") >= percent * F.greatest("n", "n_x"))
        & (F.col("pos") <= F.col("n") - needed)
        & (F.col("pos_x") <= F.col("n_x") - needed)
    )
    low, high = F.least("set", "set_x"), F.greatest("set", "set_x")
    pairs = materialise(pairs.select(low.alias("x"), high.alias("y")).distinct(), "pairs")
    named = members.select("set", "node").distinct().join(sets, "set")
    left, right = (
        named.select(F.col("set").alias(x), F.col("node").alias(c), F.col("shingles").alias(f"s{x}"))
        for x, c in (("x", "a"), ("y", "b"))
    )
    rows = pairs.join(left, "x").join(right, "y").select("a", "b", "sx", "sy")
    return rows.mapInArrow(_pair_links(percent), "a binary, b binary")


def _links(
    members: DataFrame,
    needed: DataFrame,
    k: int,
    percent: int,
    block_shingles: int,
    block_members: int,
) -> DataFrame:
    """``(node, component)`` of all members of groups ``(hub, set, node, n)`` by verified links.

    A member is a class, ``hub`` the set of the first in its group; ``needed`` has one text of
    each, so what a task gets is what its blocks are sized by. Every block of a group, with
    the hub in each, is verified within. Groups of several blocks that this leaves in several
    components are dealt into other blocks ``DEALS`` times, which links most copies at the cost
    of reading them; what then is still apart is compared by ``_across``.
    """
    size = F.greatest(
        F.ceil(F.sum("n") / block_shingles), F.ceil(F.count("*") / block_members)
    ).cast("int")
    groups = members.groupBy("hub").agg(size.alias("blocks"), F.count("*").alias("m"))
    groups = sized(materialise(groups.filter("m > 1").select("hub", "blocks"), "groups"), 32)
    block = F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int")
    every = F.when(F.col("set") == F.col("hub"), F.sequence(F.lit(0), F.col("blocks") - 1))
    grouped = members.join(groups, "hub")
    placed = grouped.select(
        "hub", "set", "node", F.explode(F.coalesce(every, F.array(block))).alias("i")
    )
    first = placed.join(needed, "set").select("hub", "i", "node", "text")
    edges = first.groupBy("hub", "i").applyInArrow(_verify(k, percent), "a binary, b binary")
    labels = components(materialise(edges, "edges"))

    large = _unresolved(grouped.filter("blocks > 1"), labels)
    large = materialise(large, "large")
    if large.isEmpty():
        return labels
    wanted = sized(materialise(large.select("set").distinct(), "wanted"), 32)
    sets = needed.join(wanted, "set").select("set", "text")
    sets = materialise(sets.mapInArrow(_sets_of(k), "set binary, shingles binary"), "sets")
    schema = "a binary, b binary, hub binary, shingle bigint, seen bigint"
    common = None
    for deal in range(1, DEALS + 1):
        salted = F.pmod(F.xxhash64("set", F.lit(deal)), F.col("blocks")).cast("int")
        large = large.withColumn("i", salted)
        rows = large.select("hub", "i", "set", "node").join(sets, "set")
        found = rows.groupBy("hub", "i").applyInArrow(_deal_links(percent), schema)
        found = materialise(found, "deal")
        if common is None:
            common = found.filter("hub IS NOT NULL")
        labels = merge_components(labels, found.filter("a IS NOT NULL").select("a", "b"))
        large = _unresolved(large.drop("component", "i"), labels).withColumn("i", salted)
        large = materialise(large, "large")
        if large.isEmpty():
            return labels
    common = common.groupBy("hub", "shingle").agg(F.sum("seen").alias("seen"))
    commonest = [F.col("seen").desc(), F.col("shingle")]
    common = first_rows(common, "hub", F.col("shingle"), commonest, COMMON_SHINGLES, "at")
    # Eight bytes a shingle, the rarest at the front.
    packed_row = F.array_sort(F.collect_list(F.struct((-F.col("at")).alias("at"), "shingle")))
    listed = F.transform(packed_row, lambda x: F.lpad(F.hex(x["shingle"]), 16, "0"))
    common = common.groupBy("hub").agg(F.unhex(F.array_join(listed, "")).alias("common"))
    common = materialise(common, "common")
    more = _across(large, common, sets, percent)
    return merge_components(labels, materialise(more, "edges"))


def _assigned(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    k: int,
    percent: int,
    block_shingles: int,
    block_members: int,
) -> DataFrame:
    """``(doc, n, set, component_id)`` for every row, in the steps of ``near_duplicates``."""
    texts = only(docs, doc=id_col, text=text_col).withColumn("doc", F.col("doc").cast("bigint"))
    sig = materialise(
        texts.mapInArrow(_signatures(k), "doc bigint, n bigint, set binary, keys array<bigint>"),
        "signatures",
    )
    classes = sig.filter("n > 0 AND doc IS NOT NULL").groupBy("set")
    classes = classes.agg(
        F.min("doc").alias("least"), F.first("n").alias("n"), F.first("keys").alias("keys")
    )
    node = class_key(F.col("least"), F.col("set")).alias("node")
    classes = materialise(classes.select(node, "set", "n", "keys"), "classes")
    entries = classes.select("node", "set", "n", F.explode("keys").alias("key"))
    hubs = materialise(
        entries.groupBy("key")
        .agg(F.min(F.struct("node", "set")).alias("least"), F.count("*").alias("_size"))
        .filter("_size > 1")
        .select("key", F.col("least.set").alias("hub")),
        "hubs",
    )
    members = materialise(
        entries.join(hubs, "key").select("hub", "set", "node", "n").distinct(), "members"
    )
    needed = _one_text_each(texts, sig, members, k)
    labels = _links(members, needed, k, percent, block_shingles, block_members)
    named = classes.select("set", "node").join(labels, "node", "left")
    least = key_doc(F.coalesce("component", "node")).alias("component")
    named = materialise(named.select("set", least), "named")
    found = sig.select("doc", "n", "set").join(named, "set", "left")
    component = F.when(F.col("n") == 0, F.col("doc")).otherwise(F.col("component"))
    return found.select("doc", "n", "set", component.alias("component_id"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = 4,
    percent: int = 80,
    block_shingles: int = BLOCK_SHINGLES,
    block_members: int = BLOCK_MEMBERS,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs``.

    Two documents are linked when ``100 * |A & B| >= percent * |A | B|`` over their sets of
    ``k``-word shingles (64-bit hashes; a text of fewer words is one shingle). The component
    is the least id that links reach. Steps, each written:

    1. Sketch every set. Documents with equal sets are one class, named by its least id, so
       copies are never paired.
    2. Classes that share a band key form a bucket, and buckets with the same least class
       form one group, so a pair that meets in many bands is verified once.
    3. Each group is verified exactly on whole sets, split by hash into blocks of at most
       ``block_shingles`` shingles or ``block_members`` classes. What the blocks of a large
       group leave apart is dealt anew, and then compared where a prefix of the sets says that a
       link is possible. So a group of any size is bounded in every task, and no link is lost.
       A task returns a spanning forest of its links, never all pairs.
    4. Components of the forests, and every row takes its class's.

    NULL or blank text has the empty set and links with nothing. A row without an id takes
    the component of its class, if that has an id, and otherwise none; it is kept only in
    the latter case. Rows that repeat an id with the same set are one document; rows that repeat
    it with other sets are documents of their own, each in the component of its set, and the id may
    then be in several. Extra columns are ignored.
    """
    found = _assigned(docs, id_col, text_col, k, percent, block_shingles, block_members)
    return found.select(
        F.col("doc").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("doc").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def _digests(k: int) -> callable:
    """Rows as they are, with the digest of their set in place of the text beside them."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            sets = [shingle_set(hashes.of(lower_words(t)), k) for t in texts]
            digests = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
            columns = {"row": batch.column("row"), "_doc": batch.column("_doc"), "_set": digests}
            yield pa.record_batch(columns)

    return rows


def keep_one_of_each(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = 4,
    percent: int = 80,
    block_shingles: int = BLOCK_SHINGLES,
    block_members: int = BLOCK_MEMBERS,
) -> DataFrame:
    """The rows of ``docs`` that are kept: one document of each group of near-duplicates.

    All columns of ``docs`` are kept. A row without an id can't be named by another; it
    stays. Of an id whose rows have several sets, each row goes or stays by its own set; rows that
    repeat id and set are one document and stay together.
    """
    found = _assigned(docs, id_col, text_col, k, percent, block_shingles, block_members)
    found = found.filter("doc IS NOT NULL").groupBy("doc", "set")
    found = found.agg(F.first(F.col("doc") == F.col("component_id")).alias("stays"))
    found = materialise(found, "kept")
    ids = found.groupBy("doc").agg(F.bool_or("stays").alias("some"), F.bool_and("stays").alias("all"))
    ids = materialise(ids.filter("NOT all").select(F.col("doc").alias("_gone"), "some"), "gone")
    gone = sized(ids.filter("NOT some").select("_gone"), 16)
    rows = packed(docs, _doc=F.col(f"`{id_col}`").cast("bigint"), _text=F.col(f"`{text_col}`"))
    rows = rows.join(gone, F.col("_doc") == F.col("_gone"), "left_anti")
    divided = sized(ids.filter("some").select(F.col("_gone").alias("_some")), 16)
    if divided.isEmpty():
        return rows.select("row.*")
    whole = rows.join(divided, F.col("_doc") == F.col("_some"), "left_anti").select("row")
    parts = rows.join(divided, F.col("_doc") == F.col("_some"), "left_semi")
    schema = T.StructType(
        [rows.schema["row"], rows.schema["_doc"], T.StructField("_set", T.BinaryType())]
    )
    away = found.filter("NOT stays").select(F.col("doc").alias("_gone"), F.col("set").alias("_away"))
    away = away.join(divided, F.col("_gone") == F.col("_some"), "left_semi")
    away = sized(materialise(away, "away"), 48)
    gone = (F.col("_doc") == F.col("_gone")) & (F.col("_set") == F.col("_away"))
    parts = parts.mapInArrow(_digests(k), schema).join(away, gone, "left_anti").select("row")
    return whole.union(parts).select("row.*")


ORACLE = r"""
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') AS words
        FROM documents),
    s AS (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN []
            WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
            ELSE list_transform(range(1, len(words) - 2),
                lambda i : array_to_string(words[i:i + 3], ' ')) END) AS shingle
        FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (
        SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
        FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
        GROUP BY a.doc_id, b.doc_id),
    l AS (
        SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
        WHERE 100 * shared >= 80 * (nx.n + ny.n - shared)),
    e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
    r AS (
        SELECT doc_id AS node, doc_id AS root FROM documents
        UNION SELECT e.y, r.root FROM r JOIN e ON e.x = r.node),
    c AS (SELECT node, min(root) AS component_id FROM r GROUP BY node)
    SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id,
        d.doc_id = c.component_id AS kept
    FROM documents d JOIN c ON c.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id"""
