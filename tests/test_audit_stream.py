"""The live audit job: closed buckets, late lines, restarts."""

from __future__ import annotations

import json

import pytest

from changeledger.plans.audit import AuditJob, build_audit_counts
from changeledger.sinks.documents import Target
from changeledger.streaming.audit import AuditStream, read_closed_counts, start_audit_stream

HOUR = 3_600_000
START = 1_625_140_800_000  # 2021-07-01T12:00Z


def line(hour, who=1, what="shop.ls.team/a", number=0):
    event = {
        "session_id": "s", "time_at_start": START + hour * HOUR + number, "what": what, "elapsed": 1, "uuid": {"uuid": f"{hour}-{who}-{number}"},
        "who": {"access_path": "SSH_COMMAND", "account_id": {"id": who}}, "result": "0",
    }
    return json.dumps({"type": "SshAuditEvent", "event": event})


@pytest.fixture
def live(spark, tmp_path):
    """A log directory, and a stream over it that is run until it has read what is there."""
    log = tmp_path / "log"
    log.mkdir()
    job = AuditJob(events_path=str(log), index=Target(str(tmp_path / "counts"), "parquet"))
    stream = AuditStream(job, str(tmp_path / "checkpoint"), delay="2 hours", max_files=1)

    def add(name, *lines):
        (log / name).write_text("".join(text + "\n" for text in lines))

    def run():
        query = start_audit_stream(spark, stream, available_now=True)
        query.awaitTermination()
        return query

    def counts():
        got = read_closed_counts(spark, stream).collect()
        return sorted(((row.events_time_bucket.hour - 12) % 24, row.user_identifier, row.num_events) for row in got)

    return add, run, counts, job


def test_only_closed_buckets_are_written(live):
    add, run, counts, _ = live
    add("1", line(0), line(0, number=1), line(1), "not an event")
    add("2", line(3))
    run()
    assert counts() == [(0, "1", 2), (1, "1", 1)]


def test_open_buckets_go_on_after_a_restart(live):
    add, run, counts, _ = live
    add("1", line(0), line(1))
    run()
    add("2", line(1, number=1), line(1, who=2))
    run()
    add("3", line(9))
    run()
    assert counts() == [(0, "1", 1), (1, "1", 2), (1, "2", 1)]
    run()  # nothing new, nothing twice
    assert counts() == [(0, "1", 1), (1, "1", 2), (1, "2", 1)]


def test_a_late_line_is_dropped_and_counted(live):
    add, run, counts, _ = live
    add("1", line(0))
    add("2", line(5))
    run()
    add("3", line(1), line(4))
    add("4", line(20))
    query = run()
    assert counts() == [(0, "1", 1), (4, "1", 1), (5, "1", 1)]
    dropped = [operator["numRowsDroppedByWatermark"] for progress in query.recentProgress for operator in progress["stateOperators"]]
    assert sum(dropped) >= 1


def test_a_batch_repeated_after_a_failure_counts_once(live, monkeypatch):
    from changeledger.streaming import audit as module

    add, run, counts, _ = live
    write, failing = module._write_buckets, [True]

    def fail_after_writing(batch, job):
        write(batch, job)
        if failing and not batch.isEmpty():
            failing.pop()
            raise RuntimeError("lost after the write")

    monkeypatch.setattr(module, "_write_buckets", fail_after_writing)
    add("1", line(0), line(0, number=1))
    add("2", line(9))
    with pytest.raises(Exception, match="lost after the write"):
        run()
    run()
    assert counts() == [(0, "1", 2)]


def test_a_finished_stream_has_the_rows_of_the_batch_job(spark, live, rows):
    add, run, _, job = live
    log = [line(hour, who, what, number) for hour in range(4) for who in (1, 2) for number, what in enumerate(["shop.ls.team/a", "LOGIN", "git-upload-pack./team/b"])]
    for number, start in enumerate(range(0, len(log), 5)):
        add(f"{number:02}", *log[start : start + 5])
    batch = build_audit_counts(spark, job)
    expected = rows(batch)
    add("99", line(1000))
    run()
    stream = AuditStream(job, "unused")
    assert rows(read_closed_counts(spark, stream).select(*batch.columns)) == expected


def test_a_quiet_bucket_is_one_file_and_a_busy_one_several(live, tmp_path):
    """Every bucket closed by one batch: files grow with buckets plus tasks, not with their product."""
    add, run, counts, _ = live
    busy = [line(0, who, "shop.ls.team/a", who) for who in range(400)]
    quiet = [line(hour, who, "shop.ls.team/a", who) for hour in range(1, 21) for who in range(12)]
    add("1", *busy, *quiet)
    add("2", line(1000))
    run()
    assert sum(number for *_, number in counts()) == 640
    files = {bucket.name: len(list(bucket.glob("*.parquet"))) for bucket in (tmp_path / "counts").glob("bucket=*")}
    assert len(files) == 21
    assert sum(files.values()) < 21 + 4
    assert files["bucket=20210701120000"] > 1
