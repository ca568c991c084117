"""Mixing sources to target weights by hash thresholds found from histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txnstar.llm.frames import only, packed, sized
from txnstar.operators.keys import assign_key, assign_key_in_ranges, in_ranges
from txnstar.sources.workdir import materialise

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SOURCES_IN_A_TASK = 1_000_000
# A document's place on the line of its source: 50 bits, refined 10 bits at a time.
POINT_BITS = 50
LEVEL_BITS = 10


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def point(doc: Column, text: Column) -> Column:
    """The first 50 bits of the MD5 of the id; of the text where there is no id."""
    key = F.coalesce(doc.cast("string"), text, F.lit(""))
    return F.shiftright(F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("bigint"), 2)


def _ranked(sizes: DataFrame, in_a_task: int) -> DataFrame:
    """``sizes``, written, with the place of each source among the names, NULL last."""
    if sizes.count() <= in_a_task:
        return assign_key(sizes, "source", "_rank")
    ranged = materialise(in_ranges(sizes, "source"), "ranges")
    return assign_key_in_ranges(ranged, "source", "_rank")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, in_a_task: int = SOURCES_IN_A_TASK
) -> DataFrame:
    """``(source, source_size, share, capped, rest, free)`` from ``(source, source_size)``.

    Sources in the order of their names, NULL last, take the ``weights`` in turn. Those whose
    share of the whole exceeds ``MAX_REPEATS`` times their size are capped there, and what
    is left is shared anew among the others until none exceeds. A source that is not capped
    has the target ``share * rest / free``; all numbers are whole. Only two sums per round
    reach the driver, and a round in which no source is newly capped is the last. ``sizes`` is a
    written table; more sources than ``in_a_task`` are numbered in ranges of names.
    """
    ranked = _ranked(sizes, in_a_task)
    turn = (F.pmod(F.col("_rank") - 1, F.lit(len(weights))) + 1).cast("int")
    share = F.element_at(F.array(*[F.lit(w) for w in weights]), turn).cast("bigint")
    ranked = materialise(ranked.select("source", "source_size", share.alias("share")), "sources")
    most = F.col("source_size") * MAX_REPEATS
    wide = "decimal(38,0)"
    first = ranked.agg(F.sum("source_size"), F.sum("share")).first()
    total, rest, free = first[0] or 0, first[0] or 0, first[1] or 0
    capped = F.lit(False)
    while free:
        wanted = F.col("share").cast(wide) * F.lit(rest).cast(wide)
        capped = wanted > most.cast(wide) * F.lit(free).cast(wide)
        taken, left = ranked.agg(
            F.sum(F.when(capped, most).otherwise(0)),
            F.sum(F.when(capped, 0).otherwise(F.col("share"))),
        ).first()
        if (total - taken, left) == (rest, free):
            break
        rest, free = total - taken, left
    return ranked.withColumns({"capped": capped, "rest": F.lit(rest), "free": F.lit(max(free, 1))})


def _budgets(targets: DataFrame) -> DataFrame:
    """Whole copies of every document of a source, and the words still due after them."""
    size = F.col("source_size")
    target = F.when(F.col("capped"), (size * MAX_REPEATS).cast("double")).otherwise(
        (F.col("share") * F.col("rest")).cast("double") / F.col("free").cast("double")
    )
    copies = F.when(size == 0, 0).when(F.col("capped"), MAX_REPEATS).otherwise(
        F.floor(F.col("target") / size)
    )
    return (
        targets.withColumn("target", target)
        .withColumn("copies", copies.cast("bigint"))
        .withColumn("budget", F.col("target") - (F.col("copies") * size).cast("double"))
        .select("source", "source_size", "target", "copies", "budget")
    )


def _boundary(pieces: DataFrame, open_sources: DataFrame, level: int) -> DataFrame:
    """Each source's bucket of this level in which its budget ends, and the words before it.

    ``pieces`` are the documents of the boundary buckets so far. A source whose documents
    all fit its budget has no such bucket.
    """
    shift = POINT_BITS - LEVEL_BITS * (level + 1)
    histogram = pieces.groupBy("source", F.shiftright("point", shift).alias("bucket")).agg(
        F.sum("size").alias("words")
    )
    along = Window.partitionBy("source").orderBy("bucket")
    through = F.col("before") + F.sum("words").over(along)
    open_sources = sized(open_sources.select("_source", "before", "budget"), 64)
    return (
        histogram.join(open_sources, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("_through", through)
        .filter("_through > budget")
        .groupBy(F.col("source").alias("_source"))
        .agg(
            F.min(F.struct("_through", "bucket", "words", "budget")).alias("_at"),
        )
        .select(
            "_source",
            (F.col("_at._through") - F.col("_at.words")).alias("before"),
            F.col("_at.budget").alias("budget"),
            F.col("_at.bucket").alias("bucket"),
            F.col("_at.words").alias("words"),
        )
    )


def mix_plan(pieces: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """What each source gives: ``(_source, source_size, target, copies, threshold)``.

    ``pieces`` are written ``(source, size, point)``. Every document of a source is taken
    ``copies`` times, and once more if its point is below the source's threshold.
    """
    sizes = materialise(pieces.groupBy("source").agg(F.sum("size").alias("source_size")), "sizes")
    plan = materialise(_budgets(source_targets(sizes, weights)), "plan")
    bounds = plan.select(
        F.col("source").alias("_source"), F.lit(0).cast("bigint").alias("before"), "budget"
    )
    bounds, inside = materialise(bounds, "bounds"), pieces
    for level in range(POINT_BITS // LEVEL_BITS):
        bounds = materialise(_boundary(inside, bounds, level), "bounds")
        shift = POINT_BITS - LEVEL_BITS * (level + 1)
        if shift:
            at = sized(bounds.select("_source", "bucket"), 64)
            here = inside["source"].eqNullSafe(at["_source"])
            here = here & (F.shiftright(inside["point"], shift) == at["bucket"])
            inside = materialise(inside.join(at, here).select(inside["*"]), "inside")
    take_it = (F.col("budget") - F.col("before")) * 2 >= F.col("words")
    ends = bounds.select("_source", (F.col("bucket") + take_it.cast("bigint")).alias("threshold"))
    plan = plan.join(ends, plan["source"].eqNullSafe(ends["_source"]), "left").select(
        F.col("source").alias("_source"),
        "source_size",
        "target",
        "copies",
        F.coalesce("threshold", F.lit(1 << POINT_BITS)).alias("threshold"),
    )
    return sized(materialise(plan, "plan"), 64)


def _times() -> Column:
    once_more = (F.col("point") < F.col("threshold")) & (F.col("copies") < MAX_REPEATS)
    return F.col("copies") + once_more.cast("bigint")


def _pieces(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    doc, text = F.col("doc"), F.col("text")
    return materialise(
        only(docs, doc=id_col, text=text_col, source=source_col).select(
            "doc", "source", word_count(text).alias("size"), point(doc, text).alias("point")
        ),
        "pieces",
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
) -> DataFrame:
    """``(doc_id, size, source_size, target, taken, times)`` for every row of ``docs``.

    Every document is taken ``floor(target / source_size)`` times, and those below their
    source's hash threshold once more, so that the words taken come as near to the target
    as whole documents in hash order allow: within half of the one at the threshold. Rows
    with the same id share their place and are taken alike; rows without an id have the
    place of their text.

    The threshold is found without sorting documents. Words are summed by source and by
    bucket of the hash; the running sum over a source's 1024 buckets shows the one where
    its budget ends; only that bucket's documents are kept, and summed by their next bits,
    until the bucket is one hash value. Each sum merges inside map tasks, so a hot source
    sends at most 1024 rows per task. NULL text has no words; blank ones have size 0 and
    are taken 0 words. Extra columns are ignored.
    """
    pieces = _pieces(docs, id_col, text_col, source_col)
    plan = mix_plan(pieces, weights)
    return pieces.join(plan, pieces["source"].eqNullSafe(plan["_source"])).select(
        F.col("doc").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("size") * _times()).alias("taken"),
        _times().alias("times"),
    )


def take_mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with all their columns.

    A row's own id, source and the plan of its source decide, so texts are not shuffled. A
    document without words adds nothing to any target; it stays once.
    """
    plan = mix_plan(_pieces(docs, id_col, text_col, source_col), weights)
    doc, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    rows = packed(
        docs, _of=F.col(f"`{source_col}`"), size=word_count(text), point=point(doc, text)
    )
    times = F.when(F.col("size") == 0, 1).otherwise(_times()).cast("int")
    rows = rows.join(plan, F.col("_of").eqNullSafe(F.col("_source")))
    return rows.select("row", F.explode(F.array_repeat(F.lit(0), times))).select("row.*")


ORACLE = r"""
    WITH d AS (
        SELECT doc_id, source,
            coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
            CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), text, '')), 1, 13)
                AS BIGINT) >> 2 AS point
        FROM documents),
    r AS (
        SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
            row_number() OVER (ORDER BY encode(source) NULLS LAST) AS nr
        FROM d GROUP BY source),
    s AS (
        SELECT source, source_size, nr, [5, 2, 1][(nr - 1) % 3 + 1] AS share FROM r),
    o AS (
        SELECT *, row_number() OVER (ORDER BY source_size / share, nr) AS place,
            (SELECT sum(source_size) FROM s) AS total FROM s),
    c AS (
        SELECT *,
            total - 3 * coalesce(sum(source_size) OVER (ORDER BY place
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
            sum(share) OVER (ORDER BY place
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
        FROM o),
    f AS (
        SELECT place, rest, free FROM c WHERE share * rest <= 3 * source_size * free
        ORDER BY place LIMIT 1),
    t AS (
        SELECT source, source_size,
            CASE WHEN c.place < coalesce((SELECT place FROM f), 9e18)
                THEN 3 * CAST(source_size AS DOUBLE)
                ELSE CAST(share * (SELECT rest FROM f) AS DOUBLE)
                    / CAST((SELECT free FROM f) AS DOUBLE) END AS target
        FROM c),
    b AS (
        SELECT *, CASE WHEN source_size = 0 THEN 0
            ELSE CAST(floor(target / source_size) AS BIGINT) END AS copies FROM t),
    u AS (
        SELECT d.doc_id, d.size, b.source_size, b.target, b.copies,
            b.target - CAST(b.copies * b.source_size AS DOUBLE) AS budget,
            sum(d.size) OVER (PARTITION BY d.source ORDER BY d.point) AS through,
            sum(d.size) OVER (PARTITION BY d.source, d.point) AS unit
        FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
    SELECT doc_id, size, source_size, target,
        CAST(size * (copies + CASE WHEN copies < 3 AND 2 * (budget - (through - unit)) >= unit
            THEN 1 ELSE 0 END) AS BIGINT) AS taken
    FROM u"""
