from __future__ import annotations

import pytest

from tests.test_sources import write_csv
from txnstar.__main__ import _options, _parser, main
from txnstar.plans.sizing import GIB, MIB, session_conf, sized_for


def test_jobs_one_by_one(spark, tmp_path, capsys):
    landing = tmp_path / "landing"
    write_csv(landing / "a.csv", {}, {}, {"TransactionID": "T2", "TransactionDate": "never"})
    paths = {n: str(tmp_path / n) for n in ("raw", "staged", "checkpoint", "tables")}
    ingest = ["--raw", paths["raw"], "--checkpoint", paths["checkpoint"]]
    main(["ingest", "--landing", str(landing), *ingest, "--date", "2025-01-01"])
    main(["transform", "--raw", paths["raw"], "--staged", paths["staged"]])
    shown = capsys.readouterr().out
    assert "|null_dates          |1        |" in shown
    main(["create-warehouse", "--target", "warehouse_cli", "--location", f"file:{paths['tables']}"])
    main(["load", "--staged", paths["staged"], "--target", "warehouse_cli"])
    assert spark.table("warehouse_cli.FACT_TRANSACTIONS").count() == 1
    write_csv(landing / "b.csv", {"TransactionID": "T3"})
    everything = ["--landing", str(landing), *ingest, "--staged", paths["staged"]]
    main(["run", *everything, "--target", "warehouse_cli"])
    assert spark.table("warehouse_cli.FACT_TRANSACTIONS").count() == 2
    spark.sql("DROP DATABASE warehouse_cli CASCADE")


def test_arguments():
    args = _parser().parse_args(
        ["load", "--staged", "s", "--target", "t", "--format", "jdbc", "--option", "url=a=b"]
    )
    assert _options(args.option) == {"url": "a=b"}
    with pytest.raises(SystemExit):
        _parser().parse_args(["transform", "--raw", "r"])


def _sizes(raw_bytes):
    conf = session_conf(raw_bytes)
    reducers = int(conf["spark.sql.shuffle.partitions"])
    return raw_bytes / int(conf["spark.sql.files.maxPartitionBytes"]), reducers


def test_shuffle_grows_with_the_data():
    assert session_conf(1)["spark.sql.shuffle.partitions"] == "200"
    for raw_bytes in (10 * GIB, 1000 * GIB, 10_000 * GIB, 93_132 * GIB):  # the last is 100 TB
        maps, reducers = _sizes(raw_bytes)
        assert raw_bytes / reducers <= 4 * GIB
        assert raw_bytes / (maps * reducers) >= 40 * 1024
    assert 20_000 < reducers < 30_000


def test_session_is_sized_for_a_job_and_left_as_it_was(spark):
    keys = ["spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"]
    before = [spark.conf.get(k) for k in keys]
    with sized_for(spark, 10_000 * GIB):
        assert int(spark.conf.get(keys[0])) == 10_000
        assert spark.conf.get(keys[1]) == str(GIB)
    with sized_for(spark, 100 * MIB):
        assert [spark.conf.get(k) for k in keys] == before
    assert [spark.conf.get(k) for k in keys] == before


def test_typed_reading_of_csv(spark, tmp_path, capsys):
    write_csv(tmp_path / "raw" / "date=2025-01-01" / "a.csv", {"AccountBalance": "5"}, {"AccountBalance": "5.0"})
    job = ["transform", "--raw", str(tmp_path / "raw"), "--staged", str(tmp_path / "staged"), "--raw-format", "csv"]
    main(job)
    assert "|fact_transactions   |2        |" in capsys.readouterr().out
    main([*job, "--infer-schema"])
    assert "|fact_transactions   |1        |" in capsys.readouterr().out
