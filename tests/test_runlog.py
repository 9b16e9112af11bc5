"""Log writing and reading: explicit schema, schema evolution, legacy time column."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from slugmend.operators import report
from slugmend.plans.reporting import build_report
from slugmend.schemas import LOG_COLUMNS, LOG_SCHEMA
from slugmend.sources import runlog


def test_all_null_optional_columns_keep_their_types(spark):
    df = spark.createDataFrame(
        [("e1", dt.datetime(2024, 1, 1), "1")], "execution_id string, timestamp timestamp, sku_vtex string"
    )
    out = runlog.to_log_schema(df)
    assert [f.name for f in out.schema.fields] == list(LOG_COLUMNS)
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in LOG_SCHEMA.fields]


def test_missing_required_column_is_rejected(spark):
    df = spark.createDataFrame([("e1",)], "execution_id string")
    with pytest.raises(ValueError):
        runlog.to_log_schema(df)


def test_null_violations_counts_required_nulls(spark):
    df = runlog.to_log_schema(
        spark.createDataFrame(
            [("e1", None, "1"), (None, dt.datetime(2024, 1, 1), "2")],
            "execution_id string, timestamp timestamp, sku_vtex string",
        )
    )
    row = runlog.null_violations(df).first()
    assert (row["execution_id"], row["timestamp"], row["sku_vtex"]) == (1, 1, 0)


def test_append_evolves_schema_and_reader_merges(spark, scratch):
    path = os.path.join(scratch, "log")
    old = spark.createDataFrame(
        [("e1", dt.datetime(2024, 1, 1, 10), "1", "SUCESSO")],
        "execution_id string, timestamp timestamp, sku_vtex string, status string",
    )
    assert runlog.append_log(old, path)
    new = spark.createDataFrame(
        [("e2", dt.datetime(2024, 1, 2, 10), "2", "ERRO_PUT", "extra")],
        "execution_id string, timestamp timestamp, sku_vtex string, status string, origem string",
    )
    assert runlog.append_log(new, path)
    log = runlog.read_log(spark, path)
    assert "origem" in log.columns and set(LOG_COLUMNS) <= set(log.columns)
    assert log.count() == 2
    assert log.filter(F.col("origem").isNull()).count() == 1


def test_empty_batch_is_not_written(spark, scratch):
    path = os.path.join(scratch, "log")
    empty = spark.createDataFrame([], "execution_id string, timestamp timestamp, sku_vtex string")
    assert runlog.append_log(empty, path) is False
    assert not os.path.exists(path)


def _mixed_log(spark):
    legacy = spark.createDataFrame(
        [("old", dt.datetime(2024, 1, 5, 10), None, "1", "SUCESSO")],
        "execution_id string, data_execucao timestamp, timestamp timestamp, sku_vtex string, status string",
    )
    new = spark.createDataFrame(
        [("new", None, dt.datetime(2024, 1, 6, 10), "2", "ERRO_REDIRECT"),
         ("new", None, dt.datetime(2024, 1, 6, 11, 2, 3), "3", "SUCESSO")],
        "execution_id string, data_execucao timestamp, timestamp timestamp, sku_vtex string, status string",
    )
    return legacy.unionByName(new)


def test_effective_time_uses_legacy_column_only_when_present(spark):
    mixed = _mixed_log(spark)
    assert report.latest_run(mixed).first()["execution_id"] == "new"
    only_new = mixed.drop("data_execucao")
    assert report.latest_run(only_new).first()["execution_id"] == "new"
    only_old = mixed.filter(F.col("execution_id") == "old").drop("timestamp").withColumnRenamed(
        "data_execucao", "timestamp"
    )
    assert report.latest_run(only_old).first()["execution_id"] == "old"


def test_run_without_any_time_sorts_last(spark):
    log = spark.createDataFrame(
        [("a", None, "1", "SUCESSO"), ("b", dt.datetime(2024, 1, 1), "2", "SUCESSO")],
        "execution_id string, timestamp timestamp, sku_vtex string, status string",
    )
    assert report.latest_run(log).first()["execution_id"] == "b"


def test_build_report_for_latest_run(spark):
    rep = build_report(_mixed_log(spark))
    assert rep.execution_id == "new"
    s = rep.summary.first()
    assert (s["total"], s["sucesso"], s["erro_redirect"], s["elapsed_sec"]) == (2, 1, 1, 3723)
    assert rep.severity.first()["severity"] == "CRITICO"
    assert rep.header.first()["duracao"] == "01h 02m 03s"
    assert rep.metrics.count() == 9
    assert [r["sku_vtex"] for r in rep.critical.collect()] == ["2"]
    assert rep.alert.first()["skus_lista"] == "2"


def test_report_errors(spark):
    empty = spark.createDataFrame([], "execution_id string, timestamp timestamp, sku_vtex string, status string")
    with pytest.raises(ValueError):
        build_report(empty)
    with pytest.raises(ValueError):
        build_report(_mixed_log(spark), execution_id="nope")


def test_refresh_then_read_sees_new_files(spark, scratch):
    path = os.path.join(scratch, "log")
    one = spark.createDataFrame([("e1", dt.datetime(2024, 1, 1), "1")], "execution_id string, timestamp timestamp, sku_vtex string")
    runlog.append_log(one, path)
    assert runlog.read_log(spark, path).count() == 1
    runlog.append_log(one, path)
    assert runlog.read_log(spark, path).count() == 2


def test_a_run_is_appended_once(spark, scratch):
    path = os.path.join(scratch, "log")
    rows = spark.createDataFrame(
        [("e1", dt.datetime(2024, 1, 1), "1")], "execution_id string, timestamp timestamp, sku_vtex string"
    )
    assert runlog.append_log(rows, path, execution_id="e1")
    with pytest.raises(runlog.RunAlreadyLogged):
        runlog.append_log(rows, path, execution_id="e1")
    assert runlog.read_log(spark, path).count() == 1
    assert runlog.append_log(rows.withColumn("execution_id", F.lit("0123")), path, execution_id="0123")
    assert {r[0] for r in runlog.read_log(spark, path).select("execution_id").collect()} == {"e1", "0123"}


def test_nulls_in_required_columns_are_refused(spark, scratch):
    rows = spark.createDataFrame([("e1", None, "1")], "execution_id string, timestamp timestamp, sku_vtex string")
    with pytest.raises(ValueError, match="timestamp"):
        runlog.append_log(rows, os.path.join(scratch, "log"))


def test_only_a_missing_log_counts_as_no_log(spark, scratch):
    """A folder that is no log is an error, not an empty log."""
    path = os.path.join(scratch, "odd")
    spark.range(3).write.parquet(path)
    rows = spark.createDataFrame([("e1", dt.datetime(2024, 1, 1), "1")], "execution_id string, timestamp timestamp, sku_vtex string")
    with pytest.raises(AnalysisException):
        runlog.append_log(rows, path, execution_id="e1")


def test_correction_run_appends_to_the_log(spark, scratch):
    from data_dirs import SF_SMALL

    from slugmend.plans import correction
    from slugmend.sources import fixtures as fx

    path = os.path.join(scratch, "log")
    cat = fx.catalog(spark, SF_SMALL)
    out = correction.run_correction(
        fx.queue_src(spark, SF_SMALL), fx.run_log(spark, SF_SMALL), cat, "run-1",
        registry=fx.redirects(cat), batch_size=20, run_ts=dt.datetime(2024, 2, 1), log_path=path,
    )
    assert out.count() == 20
    log = runlog.read_log(spark, path)
    assert log.count() == 20 and log.filter(F.col("execution_id") != "run-1").count() == 0
    rep = build_report(log)
    assert rep.execution_id == "run-1" and rep.summary.first()["total"] == 20


def test_of_two_interleaved_appends_one_wins(spark, scratch, monkeypatch):
    """Both drivers find the run absent; the second to publish fails and leaves nothing behind."""
    import os

    import pytest

    from slugmend.sources import runlog

    path = f"{scratch}/race"
    rows = spark.createDataFrame([("r1", "1", "SUCESSO")], "execution_id string, sku_vtex string, status string")
    rows = runlog.to_log_schema(rows.selectExpr("*", "timestamp'2024-01-01' as timestamp", "false as houve_colisao", "false as precisou_redirect"))
    monkeypatch.setattr(runlog, "_has_run", lambda *_: False)
    assert runlog.append_log(rows, path, execution_id="r1")
    with pytest.raises(runlog.RunAlreadyLogged):
        runlog.append_log(rows, path, execution_id="r1")
    assert runlog.read_log(spark, path).count() == 1
    assert [f for f in os.listdir(path) if f.startswith("_staged")] == []
    with pytest.raises(ValueError, match="2 runs"):
        more = rows.unionByName(rows.selectExpr(*(c if c != "execution_id" else "'r2' as execution_id" for c in rows.columns)))
        runlog.append_log(more, path, execution_id="r2")
    assert runlog.read_log(spark, path).count() == 1
