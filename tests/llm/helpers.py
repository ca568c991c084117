"""Small documents with the awkward cases, and plain versions of what operators compute."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SF = "/root/testdata/sf0.01"
SF_SMALL = "/root/testdata/sf0.001"


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Documents from ``(doc_id, text[, source])``."""
    full = [
        (r[0], r[1], "en", r[2] if len(r) > 2 else "a", None if r[1] is None else len(r[1]))
        for r in rows
    ]
    return spark.createDataFrame(full, DOCS)


def with_clashing_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` with extra columns that bear names the operators use for their own."""
    return df.withColumns({n: F.lit("extra") for n in names if n not in df.columns})


def rows_of(df: DataFrame, *columns: str) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def words(text: str | None) -> list[str]:
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def shingles(text: str | None, k: int) -> set[tuple]:
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute_components(rows: list[tuple], k: int, percent: int) -> dict[int, int]:
    """Least reachable id of every document, by comparing all pairs."""
    sets = {i: shingles(t, k) for i, t in rows}
    label = {i: i for i in sets}

    def root(x: int) -> int:
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                ra, rb = root(a), root(b)
                label[max(ra, rb)] = min(ra, rb)
    return {i: root(i) for i in ids}


def near_copies(seed: int, bases: int, copies: int, length: int) -> list[tuple[int, str]]:
    """Texts with edited copies at many rates, so that similarities lie about the bound."""
    rng = random.Random(seed)
    vocabulary = [f"w{n}" for n in range(400)]
    rows, doc = [], 0
    for _ in range(bases):
        base = [rng.choice(vocabulary) for _ in range(length)]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 5, 8])):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append((doc, " ".join(text)))
            doc += 1
    rng.shuffle(rows)
    return rows
