from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from changeledger.operators.audit_events import (
    audit_documents,
    col_or_null,
    filter_time_range,
    parse_audit_lines,
    with_event_columns,
)
from changeledger.schemas import AUDIT_EVENT_COLUMNS


def line(record_type="HttpAuditEvent", drop=(), **fields):
    event = {
        "http_method": "POST",
        "http_status": 200,
        "session_id": "sess",
        "who": {
            "account_id": {"id": 77},
            "real_user": {"account_id": {"id": 78}, "access_path": "UNKNOWN"},
            "access_path": "GIT",
            "last_login_external_id_property_key": {},
        },
        "when": 1500000000123,
        "what": "https://review.example.org/team/tool/git-upload-pack",
        "params": {},
        "time_at_start": 1500000000123,
        "elapsed": 9,
        "uuid": {"uuid": "audit:1"},
    }
    if record_type == "SshAuditEvent":
        del event["http_method"], event["http_status"]
        event["result"] = "0"
    event.update(fields)
    for name in drop:
        event.pop(name, None)
    return json.dumps({"type": record_type, "event": event})


def parse(spark, *lines):
    return parse_audit_lines(spark.createDataFrame([(text,) for text in lines], "value string"))


@pytest.mark.parametrize(
    "record_type, audit_type, method, result",
    [
        ("HttpAuditEvent", "HTTP", "POST", "200"),
        ("ExtendedHttpAuditEvent", "EXTENDED_HTTP", "POST", "200"),
        ("SshAuditEvent", "SSH", None, "0"),
    ],
)
def test_each_record_type(spark, record_type, audit_type, method, result):
    event = parse(spark, line(record_type)).collect()[0].asDict()
    assert event == {
        "access_path": "GIT",
        "session_id": "sess",
        "who": 77,
        "time_at_start": 1500000000123,
        "what": "https://review.example.org/team/tool/git-upload-pack",
        "elapsed": 9,
        "uuid": "audit:1",
        "http_method": method,
        "result": result,
        "audit_type": audit_type,
    }


def test_failed_login_has_neither_user_nor_access_path(spark):
    event = parse(spark, line("SshAuditEvent", drop=["who"], what="AUTH", result="FAIL")).collect()[0]
    assert (event.who, event.access_path, event.what, event.result) == (None, None, "AUTH", "FAIL")


@pytest.mark.parametrize(
    "bad",
    [
        "no json here",
        '{"other": "json"}',
        "",
        "[" + line() + "]",
        line("LegacyAuditEvent"),
        line(drop=["session_id"]),
        line(drop=["time_at_start"]),
        line(drop=["what"]),
        line(drop=["elapsed"]),
        line(drop=["uuid"]),
        line(drop=["http_method"]),
        line(drop=["http_status"]),
        line("SshAuditEvent", drop=["result"]),
        line(elapsed="soon"),
        line(time_at_start="yesterday"),
        line()[:-5],
        line() + " and more",
        line().replace('"', "'"),
    ],
)
def test_incomplete_lines_are_dropped(spark, bad):
    assert parse(spark, bad, line()).count() == 1


def test_white_space_around_a_line_does_not_matter(spark):
    assert parse(spark, "  " + line() + " \t").count() == 1


def test_bad_user_id_keeps_the_event(spark):
    event = parse(spark, line(who={"account_id": {"id": "x"}, "access_path": "REST_API"})).collect()[0]
    assert (event.who, event.access_path) == (None, "REST_API")


def test_documents_leave_out_absent_values(spark):
    documents = audit_documents(parse(spark, line(drop=["who"]), line("SshAuditEvent"))).collect()
    http, ssh = sorted((json.loads(row.document) for row in documents), key=lambda d: d["audit_type"])
    assert set(http) == set(AUDIT_EVENT_COLUMNS) - {"who", "access_path"}
    assert set(ssh) == set(AUDIT_EVENT_COLUMNS) - {"http_method"}
    assert ssh["who"] == 77 and ssh["time_at_start"] == 1500000000123


def test_missing_columns_become_null(spark):
    df = spark.createDataFrame([("x",)], "what string")
    assert with_event_columns(df).collect()[0].asDict() == {"what": "x", "who": None, "access_path": None, "http_method": None}
    assert df.select(col_or_null(df, "what"), col_or_null(df, "who", "int")).collect()[0][:] == ("x", None)


DAY = 86_400_000
NOON = 17_532 * DAY + DAY // 2  # 2018-01-01T12:00Z


@pytest.mark.parametrize(
    "since, until, ms, kept",
    [
        (None, None, NOON, True),
        ("2017-12-31", None, NOON, True),
        ("2018-01-02", None, NOON, False),
        (None, "2018-01-02", NOON, True),
        (None, "2018-01-01", NOON, False),
        ("2017-12-31", "2018-01-02", NOON, True),
        # Both bounds include the first instant of their day, and only that one of the last day.
        ("2018-01-01", "2018-01-01", NOON - DAY // 2, True),
        ("2018-01-01", "2018-01-01", NOON - DAY // 2 + 1, False),
        ("2018-01-01", None, NOON - DAY // 2 - 1, False),
    ],
)
def test_time_range(spark, since, until, ms, kept):
    df = spark.range(1).select(F.lit(ms).alias("time_at_start"))
    assert filter_time_range(df, since, until).count() == int(kept)


@pytest.mark.parametrize("line, events", [("%s", 1), ("  %s\t", 1), ("%s%s", 0), ("%s,%s", 0), ("%s x", 0), ("%s]", 0), ("[%s]", 0), ("%s,", 0)])
def test_a_line_is_one_document(spark, line, events):
    event = '{"type":"SshAuditEvent","event":{"session_id":"s","what":"w","time_at_start":1,"elapsed":1,"uuid":{"uuid":"u"},"result":"0"}}'
    lines = spark.createDataFrame([(line.replace("%s", event),)], "value string")
    assert parse_audit_lines(lines).count() == events
