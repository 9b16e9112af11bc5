"""Lists beside the log: its columns, and the facts of its runs."""

from __future__ import annotations

import datetime as dt
import os

import pytest

from slugmend.operators import report
from slugmend.plans.reporting import report_of_log
from slugmend.sources import logschema, runfacts, runlog

COLUMNS = "execution_id string, timestamp timestamp, sku_vtex string, status string"


def _run(spark, run, day, statuses=("SUCESSO", "ERRO_PUT"), **extra):
    rows = [(run, dt.datetime(2024, 1, day, 10, i), str(i), s, *extra.values()) for i, s in enumerate(statuses)]
    return spark.createDataFrame(rows, ", ".join([COLUMNS, *(f"{k} string" for k in extra)]))


def _footers(spark, path):
    return spark.read.option("mergeSchema", "true").parquet(path)


def _same(got, want):
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    assert sorted(map(str, got.select(cols).collect())) == sorted(map(str, want.select(cols).collect()))


def test_old_new_and_mixed_logs_read_as_by_their_footers(spark, scratch):
    path = os.path.join(scratch, "log")
    # A run that is older than the list, with a column of its own.
    old = runlog.to_log_schema(_run(spark, "e0", 1, canal="x"))
    old.write.partitionBy("execution_id").parquet(path)
    assert logschema.known_schema(spark, path) is None
    _same(runlog.read_log(spark, path), _footers(spark, path))
    runlog.append_log(_run(spark, "e1", 2), path, execution_id="e1")
    runlog.append_log(_run(spark, "e2", 3, origem="y"), path, execution_id="e2")
    known = logschema.known_schema(spark, path)
    assert {"canal", "origem"} <= set(known.fieldNames())
    log = runlog.read_log(spark, path)
    _same(log, _footers(spark, path))
    assert log.filter("canal = 'x'").count() == 2 and log.filter("origem = 'y'").count() == 2


def test_a_version_only_for_new_columns(spark, scratch):
    path = os.path.join(scratch, "log")
    for i, extra in enumerate([{}, {}, {"origem": "y"}, {}]):
        runlog.append_log(_run(spark, f"e{i}", i + 1, **extra), path, execution_id=f"e{i}")
    assert os.listdir(f"{path}/_manifest/schemas") != []
    assert logschema.children(spark, f"{path}/_manifest/schemas") == ["v-00000001.json", "v-00000002.json"]


def test_another_type_is_rejected_before_anything_is_written(spark, scratch):
    path = os.path.join(scratch, "log")
    runlog.append_log(_run(spark, "e1", 1, origem="y"), path, execution_id="e1")
    other = _run(spark, "e2", 2).selectExpr("*", "1L as origem")
    with pytest.raises(ValueError, match="origem"):
        runlog.append_log(other, path, execution_id="e2")
    assert runlog.read_log(spark, path).select("execution_id").distinct().count() == 1


def test_two_writers_of_a_version(spark, scratch, monkeypatch):
    """The second starts again from what the first wrote between its reading and its writing."""
    path = os.path.join(scratch, "log")
    a = _run(spark, "a", 1, x="1").schema
    b = _run(spark, "b", 1, y="1").schema
    move, raced = logschema.move_new, []

    def interleaved(session, source, target):
        if not raced:
            raced.append(True)
            logschema.record_schema(spark, path, a)
        return move(session, source, target)

    monkeypatch.setattr(logschema, "move_new", interleaved)
    assert {"x", "y"} <= set(logschema.record_schema(spark, path, b).fieldNames())
    assert {"x", "y"} <= set(logschema.known_schema(spark, path).fieldNames())


def test_facts_are_those_of_the_log_and_read_none_of_it(spark, scratch):
    path = os.path.join(scratch, "log")
    for i in range(3):
        runlog.append_log(_run(spark, f"run {i}/é", i + 1), path, execution_id=f"run {i}/é")
    want = runfacts.facts_of(runlog.read_log(spark, path))
    _same(runfacts.run_facts(spark, path), want)  # none recorded: all from the log
    assert runfacts.record_runs(spark, path) == 3 and runfacts.record_runs(spark, path) == 0
    facts = runfacts.run_facts(spark, path)
    _same(facts, want)
    assert facts.inputFiles() and all("/_manifest/runs/" in f for f in facts.inputFiles())
    log = runlog.read_log(spark, path)
    _same(report.latest_recorded_run(facts), report.latest_run(log))
    _same(report.recorded_status_frequency(facts), report.status_frequency(log))


def test_facts_that_a_lost_driver_left_out_come_from_the_log(spark, scratch):
    path = os.path.join(scratch, "log")
    runlog.append_log(_run(spark, "e1", 1), path, execution_id="e1")
    runfacts.record_runs(spark, path)
    runlog.append_log(_run(spark, "e2", 2), path, execution_id="e2")  # its facts were not written
    _same(runfacts.run_facts(spark, path), runfacts.facts_of(runlog.read_log(spark, path)))
    assert report.latest_recorded_run(runfacts.run_facts(spark, path)).first()["execution_id"] == "e2"
    # Recorded by two drivers: counted once.
    runfacts.record_runs(spark, path)
    spark.read.schema(runfacts.FACTS).parquet(f"{path}/_manifest/runs").select("execution_id", "status", "n", "min_t", "max_t") \
        .write.parquet(f"{path}/_manifest/runs/batch=again")
    _same(runfacts.run_facts(spark, path), runfacts.facts_of(runlog.read_log(spark, path)))


def test_no_log_has_no_facts(spark, scratch):
    assert runfacts.run_facts(spark, os.path.join(scratch, "none")).isEmpty()
    assert runfacts.record_runs(spark, os.path.join(scratch, "none")) == 0


def test_report_of_the_latest_run_reads_its_folder_only(spark, scratch):
    path = os.path.join(scratch, "log")
    for i in range(3):
        runlog.append_log(_run(spark, f"e{i}", i + 1), path, execution_id=f"e{i}")
        runfacts.record_runs(spark, path)
    got = report_of_log(spark, path)
    assert got.execution_id == "e2" and got.metrics.count() == 9
    assert report_of_log(spark, path, "e0").execution_id == "e0"
    with pytest.raises(ValueError):
        report_of_log(spark, os.path.join(scratch, "none"))
    with pytest.raises(ValueError):
        report_of_log(spark, path, "no such run")
