"""Cleaning rules on hand-written rows."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.helpers import SF, SF_SMALL, raw_rows, sorted_rows
from txnstar import (
    calendar_parts,
    cast_numbers,
    clean_transactions,
    drop_exact_duplicates,
    drop_unparsed,
    flag_suspicious,
    null_dates,
    parse_mixed_timestamps,
    read_raw,
    require_columns,
    standard_transactions,
)
from txnstar.functions import date_key, is_suspicious
from txnstar.functions.columns import _subsumes
from txnstar.plans.fixture import raw_transactions
from txnstar.schema import DATE_FORMATS, RAW_COLUMNS

DATES = {
    "4/11/2023 16:29": dt.datetime(2023, 4, 11, 16, 29),
    "04/11/2023 16:29": dt.datetime(2023, 4, 11, 16, 29),
    "4/1/2023 6:05": dt.datetime(2023, 4, 1, 6, 5),
    "4/11/2023": dt.datetime(2023, 4, 11),
    "04/01/2023": dt.datetime(2023, 4, 1),
    "2023-04-11 16:29:07": dt.datetime(2023, 4, 11, 16, 29, 7),
    "2023-04-11": dt.datetime(2023, 4, 11),
    "2/29/2024": dt.datetime(2024, 2, 29),
    "2/29/2023": None,
    "4/11/2023 16:29:59": None,
    "13/45/2023": None,
    "13/01/2023": None,
    "2023-13-01": None,
    "2023-04-11T16:29:07": None,
    "2023/04/11": None,
    "11-04-2023": None,
    "4/11/23": None,
    " 4/11/2023": None,
    "4/11/2023Z": None,
    "4/11/2023 24:00": None,
    "soon": None,
    "": None,
    # Inside the spring gap and the autumn overlap of New York.
    "3/12/2023 2:30": dt.datetime(2023, 3, 12, 2, 30),
    "2023-03-12 02:30:00": dt.datetime(2023, 3, 12, 2, 30),
    "11/5/2023 1:30": dt.datetime(2023, 11, 5, 1, 30),
}


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_dates(spark, conf, zone, ansi):
    conf("spark.sql.session.timeZone", zone)
    conf("spark.sql.ansi.enabled", ansi)
    rows = raw_rows(spark, *[{"TransactionID": d, "TransactionDate": d} for d in DATES])
    parsed = rows.transform(parse_mixed_timestamps)
    assert parsed.schema["TransactionDate"].dataType.typeName() == "timestamp_ntz"
    found = {r.TransactionID: r.TransactionDate for r in parsed.collect()}
    assert found == DATES


def _unguarded(spark, texts):
    """The same patterns tried on every text, in a UTC session."""
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    tries = [F.try_to_timestamp("t", F.lit(f)) for f in DATE_FORMATS]
    plain = df.select("t", F.coalesce(*tries).cast("timestamp_ntz").cast("string"))
    ours = df.select("t", F.col("t").alias("d")).transform(parse_mixed_timestamps, "d")
    return sorted_rows(plain), sorted_rows(ours.select("t", F.col("d").cast("string")))


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.one_of(
            st.text("0123456789/-: Z+T.", max_size=20),
            st.from_regex(r"\d{1,2}[/-]\d{1,2}[/-]\d{2,4}( \d{1,2}:\d{2}(:\d{2})?)?", fullmatch=True),
            st.from_regex(r"[+-]?\d{1,5}[/-]\d{1,3}[/-][+-]?\d{1,5}( \d{1,2}:\d{2})?", fullmatch=True),
            st.from_regex(r"\d{4}-\d{2}-\d{2}( \d{2}:\d{2}:\d{2})?", fullmatch=True),
        ),
        min_size=20,
        max_size=200,
    )
)
def test_separator_test_skips_no_readable_text(spark, texts):
    plain, ours = _unguarded(spark, texts)
    assert plain == ours


@pytest.mark.parametrize(
    ("text", "fmt", "expected"),
    [
        ("11 April 2023", "dd MMMM yyyy", dt.datetime(2023, 4, 11)),
        ("2023-04-11T10:00:05", "yyyy-MM-dd'T'HH:mm:ss", dt.datetime(2023, 4, 11, 10, 0, 5)),
        ("2023-04-11 10:00", "yyyy-MM-dd[ HH:mm]", dt.datetime(2023, 4, 11, 10)),
        ("2023-04-11", "yyyy-MM-dd[ HH:mm]", dt.datetime(2023, 4, 11)),
        ("2023-04-11 10:00+02:00", "yyyy-MM-dd HH:mmXXX", dt.datetime(2023, 4, 11, 8)),
        ("11.04.2023", "dd.MM.yyyy", dt.datetime(2023, 4, 11)),
        ("11:04:2023", "dd.MM.yyyy", None),
    ],
)
def test_other_formats(spark, text, fmt, expected):
    rows = raw_rows(spark, {"TransactionDate": text})
    out = rows.transform(parse_mixed_timestamps, formats=[fmt])
    assert out.first().TransactionDate == expected


def test_patterns_that_an_earlier_one_covers_are_left_out():
    covered = [
        [_subsumes(a, b) for b in DATE_FORMATS] for a in DATE_FORMATS
    ]
    pairs = {(DATE_FORMATS[i], DATE_FORMATS[j]) for i in range(6) for j in range(6) if i != j and covered[i][j]}
    assert pairs == {("M/d/yyyy H:mm", "MM/dd/yyyy HH:mm"), ("M/d/yyyy", "MM/dd/yyyy")}
    assert not _subsumes("MMM d", "MMM dd") and not _subsumes("y-M", "yyyy-M")
    assert not _subsumes("MM/d/yyyy", "M/dd/yyyy") and _subsumes("H:m", "HH:mm")


def test_inferred_dates_are_only_converted(spark):
    rows = raw_rows(spark, {}).withColumn("TransactionDate", F.lit(dt.date(2023, 4, 11)))
    out = rows.transform(parse_mixed_timestamps).first()
    assert out.TransactionDate == dt.datetime(2023, 4, 11)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_numbers(spark, conf, ansi):
    conf("spark.sql.ansi.enabled", ansi)
    rows = raw_rows(
        spark,
        {"TransactionID": "neg", "TransactionAmount": "-5.5"},
        {"TransactionID": "bad", "TransactionAmount": "abc", "LoginAttempts": "n/a"},
        {"TransactionID": "frac", "LoginAttempts": "3.7", "CustomerAge": "-3.7"},
        {"TransactionID": "big", "LoginAttempts": "99999999999", "AccountBalance": "-1e3"},
        {"TransactionID": "none", "LoginAttempts": None, "AccountBalance": ""},
    )
    out = {r.TransactionID: r for r in rows.transform(cast_numbers).collect()}
    assert out["neg"].TransactionAmount == 5.5
    assert (out["bad"].TransactionAmount, out["bad"].LoginAttempts) == (None, None)
    assert (out["frac"].LoginAttempts, out["frac"].CustomerAge) == (3, -3)
    assert (out["big"].LoginAttempts, out["big"].AccountBalance) == (None, -1000.0)
    assert (out["none"].LoginAttempts, out["none"].AccountBalance) == (None, None)


@pytest.mark.parametrize(
    ("amount", "logins", "flag"),
    [
        ("10000", "3", False),
        ("10000.01", "1", True),
        ("-10000.01", "1", True),
        ("1", "4", True),
        ("1", "n/a", False),
        ("abc", "4", True),
        ("abc", "3", False),
        ("abc", "n/a", False),
        ("20000", "n/a", True),
    ],
)
def test_suspicious(spark, amount, logins, flag):
    rows = raw_rows(spark, {"TransactionAmount": amount, "LoginAttempts": logins})
    out = rows.transform(cast_numbers).transform(flag_suspicious)
    assert out.first().is_suspicious is flag


def test_suspicious_thresholds(spark):
    df = spark.createDataFrame([(5.0, 1), (6.0, 1), (5.0, 2)], "a double, l int")
    flags = df.select(is_suspicious(F.col("a"), F.col("l"), 5, 1))
    assert [r[0] for r in flags.collect()] == [False, True, True]


def test_calendar(spark):
    rows = raw_rows(spark, {"TransactionDate": "2023-04-16 23:05:09"})
    out = rows.transform(parse_mixed_timestamps).transform(calendar_parts).first()
    parts = (out.txn_year, out.txn_month, out.txn_day, out.txn_hour, out.txn_date)
    assert parts == (2023, 4, 16, 23, dt.date(2023, 4, 16))


def test_date_key_is_unique_over_all_years(spark):
    days = spark.sql("SELECT explode(sequence(date'-0002-01-01', date'0003-12-31')) AS d")
    keys = days.select("d", date_key(F.col("d")).alias("k"))
    assert keys.select("k").distinct().count() == days.count()


def test_dedup_compares_raw_text(spark):
    rows = raw_rows(
        spark,
        {},
        {},
        {"TransactionDate": "4/11/2023"},
        {"TransactionDate": "04/11/2023"},
        {"TransactionAmount": "5"},
        {"TransactionAmount": "-5"},
        {"TransactionAmount": "5.0"},
        {"Channel": None},
        {"Channel": None},
    )
    assert rows.transform(drop_exact_duplicates).count() == 7


def test_dedup_ignores_where_a_row_came_from(spark):
    rows = raw_rows(spark, {}, {}).withColumn("ingest_date", F.monotonically_increasing_id())
    out = rows.transform(drop_exact_duplicates)
    assert out.columns == RAW_COLUMNS
    assert out.count() == 1


def test_dedup_counts_unknown_columns(spark):
    rows = raw_rows(spark, {}, {}).withColumn("note", F.monotonically_increasing_id())
    assert rows.transform(clean_transactions).count() == 2


@pytest.mark.parametrize(
    "column", ["TransactionID", "AccountID", "TransactionAmount", "TransactionDate"]
)
def test_required(spark, column):
    rows = raw_rows(spark, {column: None}, {"TransactionID": "kept", "Channel": None})
    assert [r.TransactionID for r in rows.transform(require_columns).collect()] == ["kept"]


def test_required_refuses_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "x double")
    assert require_columns(df, ["x"]).collect() == [(1.0,)]


@pytest.mark.parametrize("text", ["NaN", "nan", "NAN", " NaN "])
def test_required_refuses_nan_as_text(spark, text):
    raw = raw_rows(spark, {"TransactionAmount": text}, {"TransactionAmount": "Infinity"}, {"TransactionAmount": "x"})
    kept = [r.TransactionAmount for r in require_columns(raw).collect()]
    assert kept == ["Infinity", "x"]
    clean = clean_transactions(raw_rows(spark, {"TransactionAmount": "-Infinity"})).first()
    assert (clean.TransactionAmount, clean.is_suspicious) == (float("inf"), True)


def test_nan_goes_from_text_and_inferred_columns_alike(spark, tmp_path):
    rows = [{"TransactionID": f"TX{i}", "TransactionAmount": a} for i, a in enumerate(["NaN", "1.5", "Infinity"])]
    raw = raw_rows(spark, *rows)
    raw.write.option("header", True).csv(str(tmp_path / "raw" / "date=2025-01-01"))
    found = [
        sorted((r.TransactionID, r.TransactionAmount) for r in clean_transactions(read_raw(spark, str(tmp_path / "raw"), infer)).collect())
        for infer in (False, True)
    ]
    assert found[0] == found[1] == [("TX1", 1.5), ("TX2", float("inf"))]


def test_bad_amount_stays(spark):
    """Only a missing amount drops the row; an unreadable one becomes NULL."""
    out = raw_rows(spark, {"TransactionAmount": "abc"}).transform(clean_transactions)
    assert [r.TransactionAmount for r in out.collect()] == [None]


FUNNEL = {
    SF_SMALL: (1530, 1500, 1395, 74, 1321, 972, 16, 16519262.53),
    SF: (15300, 15000, 13944, 734, 13210, 9685, 159, 165412158.82),
}


@pytest.mark.parametrize("sf_dir", FUNNEL)
def test_funnel(spark, sf_dir):
    raw = raw_transactions(spark, sf_dir)
    standard = raw.transform(standard_transactions).persist()
    clean = standard.transform(drop_unparsed)
    totals = clean.select(
        F.count_if("is_suspicious"),
        F.count_if(F.col("LoginAttempts").isNull()),
        F.round(F.sum("TransactionAmount"), 2),
    ).first()
    found = (
        raw.count(),
        raw.transform(drop_exact_duplicates).count(),
        standard.count(),
        null_dates(standard).first().null_dates,
        clean.count(),
        *totals,
    )
    standard.unpersist()
    assert found == FUNNEL[sf_dir]


def test_step_by_step_equals_composite(spark):
    raw = raw_transactions(spark, SF_SMALL).persist()
    rows = [tuple(r) for r in raw.collect()]
    distinct = [r for r in set(rows) if None not in (r[0], r[1], r[2], r[3])]
    frame = spark.createDataFrame(distinct, raw.schema)
    steps = (
        frame.transform(parse_mixed_timestamps)
        .transform(cast_numbers)
        .transform(flag_suspicious)
        .transform(calendar_parts)
        .transform(drop_unparsed)
    )
    assert sorted_rows(steps) == sorted_rows(clean_transactions(raw))
    raw.unpersist()


def test_filters_reach_the_scan(spark, conf, capsys, tmp_path):
    conf("spark.sql.maxMetadataStringLength", "10000")
    raw_transactions(spark, SF_SMALL).write.parquet(str(tmp_path / "raw"))
    clean_transactions(spark.read.parquet(str(tmp_path / "raw"))).explain("formatted")
    plan = capsys.readouterr().out
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    for column in ["TransactionID", "AccountID", "TransactionAmount", "TransactionDate"]:
        assert f"IsNotNull({column})" in pushed
    assert plan.count(") Exchange") == 1
