from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException

from changeledger.plans.audit import AuditJob, run_audit_job
from changeledger.session import configure, scratch_dir
from changeledger.sinks.documents import Target, write_all, write_json


@pytest.fixture
def frame(spark):
    return spark.createDataFrame([(1, "x"), (2, None)], "n int, s string")


def test_json_documents_omit_nulls(spark, tmp_path, frame):
    path = str(tmp_path / "out")
    write_json(frame, path)
    assert sorted(r.value for r in spark.read.text(path).collect()) == ['{"n":1,"s":"x"}', '{"n":2}']
    with pytest.raises(AnalysisException):
        write_json(frame, path)


def test_targets_are_optional(spark, tmp_path, frame):
    assert write_all(frame, [None, None]) is None
    assert write_all(frame, [None], count=True) == 2
    first, second = str(tmp_path / "a"), str(tmp_path / "b")
    assert write_all(frame, [Target(first), Target(second, "parquet")]) is None
    assert spark.read.parquet(second).count() == spark.read.text(first).count() == 2
    assert not frame.is_cached


def test_mode_and_options_are_passed_on(spark, tmp_path, frame):
    path = str(tmp_path / "out")
    for _ in range(2):
        write_all(frame, [Target(path, "csv", "append", {"header": "true", "sep": ";"})])
    assert spark.read.csv(path, header=True, sep=";").count() == 4


def test_audit_job(spark, tmp_path):
    event = '{"type":"SshAuditEvent","event":{"session_id":"s","what":"a.b","time_at_start":%d,"elapsed":1,"who":{"account_id":{"id":5},"access_path":"SSH_COMMAND"},"uuid":{"uuid":"u"},"result":"0"}}\n'
    log = tmp_path / "log"
    log.write_text(event % 1000 + event % 2000 + "junk\n")
    accounts = tmp_path / "accounts.json"
    accounts.write_text(")]}'\n" + '[{"_account_id": 5, "name": "Five"}]')
    projects = tmp_path / "projects.json"
    projects.write_text(")]}'\n" + '[{"name": "b"}]')
    users = tmp_path / "users.csv"
    users.write_text("id,type\n5,bot\n")
    target = Target(str(tmp_path / "index"), "parquet")
    run_audit_job(spark, AuditJob(str(log), target, str(projects), str(accounts), str(users)))
    row = spark.read.parquet(target.path).collect()[0].asDict()
    assert (row["user_identifier"], row["user_type"], row["project"], row["num_events"]) == ("Five", "bot", "b", 2)
    run_audit_job(spark, AuditJob(str(log), Target(str(tmp_path / "bare"), "parquet"), since="1970-01-02"))
    assert spark.read.parquet(str(tmp_path / "bare")).count() == 0


def test_scratch_space_follows_the_cluster_setting(spark):
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")
    settings = {"spark.checkpoint.dir": "hdfs:///shared/"}
    cluster = SimpleNamespace(conf=SimpleNamespace(get=settings.get))
    assert scratch_dir(cluster, "x").startswith("hdfs:///shared/changeledger-x-")


def test_configure_pins_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    assert configure(spark).conf.get("spark.sql.session.timeZone") == "UTC"
