"""End to end: events to facet counts."""

from __future__ import annotations

import datetime as dt

import pytest

from changeledger.operators.users import with_user_columns, with_user_identifier, with_user_type
from changeledger.plans.audit import aggregate_events
from changeledger.schemas import FACETS

START = 1_625_140_991_000
HOUR = dt.datetime(2021, 7, 1, 12)
SCHEMA = (
    "audit_type string, access_path string, session_id string, who int, time_at_start bigint, what string, "
    "elapsed int, uuid string, http_method string, result string"
)
HTTP_WHAT = "https://code.invalid/fruit/plum/git-upload-pack"
SSH_ARGUMENTS = "find.-a.-n.project:fruit/plum"


def http(who=None, start=START):
    return ("HTTP", "GIT", "s", who, start, HTTP_WHAT, 12, "u", "GET", "200")


def ssh(who=123, start=START, what="shop." + SSH_ARGUMENTS):
    return ("SSH", "SSH_COMMAND", "s", who, start, what, 12, "u", None, "0")


@pytest.fixture
def run(spark):
    def aggregate(events, accounts=(), types=(), known=(), **options):
        df = aggregate_events(
            spark.createDataFrame(events, SCHEMA),
            accounts=spark.createDataFrame(list(accounts), "account_id int, identifier string"),
            user_types=spark.createDataFrame(list(types), "id int, type string"),
            known_projects=spark.createDataFrame([(k,) for k in known], "name string"),
            **options,
        )
        assert df.columns == [*FACETS, "num_events"]
        return sorted((tuple(row) for row in df.collect()), key=repr)

    return aggregate


def http_row(user=None, kind=None, project=None, n=1):
    return (HOUR, "HTTP", user, kind, "GIT", "git-upload-pack", HTTP_WHAT, None, project, "200", n)


def ssh_row(user="123", project=None, n=1, bucket=HOUR):
    return (bucket, "SSH", user, "human", "SSH_COMMAND", "shop", SSH_ARGUMENTS, "find", project, "0", n)


def test_anonymous_http(run):
    assert run([http()]) == [http_row()]


def test_unknown_account_keeps_its_id(run):
    assert run([http(who=123)]) == [http_row("123", "human")]


def test_known_account(run):
    assert run([http(who=123)], accounts=[(123, "Ada L")]) == [http_row("Ada L", "human")]


def test_ssh(run):
    assert run([ssh()]) == [ssh_row()]


def test_same_bucket_is_one_row(run):
    assert run([ssh(), ssh(start=START + 1000)]) == [ssh_row(n=2)]


def test_users_are_counted_separately(run):
    assert run([ssh(), ssh(who=124)]) == [ssh_row(), ssh_row("124")]


def test_audit_types_are_counted_separately(run):
    assert run([ssh(), http(who=123, start=START + 1000)]) == [http_row("123", "human"), ssh_row()]


def test_user_types(run):
    assert run([http(who=123)], types=[(123, "bot")]) == [http_row("123", "bot")]
    both = run([http(who=123)], accounts=[(123, "Ada L"), (9, "x")], types=[(123, "bot"), (8, "bot")])
    assert both == [http_row("Ada L", "bot")]


def test_projects(run):
    assert run([http()], known=["fruit/plum"]) == [http_row(project="fruit/plum")]
    assert run([ssh()], known=["fruit/plum"]) == [ssh_row(project="fruit/plum")]


def test_events_that_fold_to_the_same_facets_are_summed(run):
    """Two users with one identifier, and results of different texts without arguments."""
    got = run([ssh(who=1), ssh(who=2), ssh(who=2)], accounts=[(1, "Ada"), (2, "Ada")])
    assert got == [ssh_row("Ada", n=3)]


def test_sub_command(run):
    assert run([ssh(what="shop.peel.-v")])[0][7] == "peel"


def test_time_range_and_unit(run):
    events = [ssh(), ssh(start=START + 86_400_000 * 100)]
    assert run(events, until="2021-07-20") == [ssh_row()]
    got = run(events, unit="quarter")
    assert [(r[0], r[-1]) for r in got] == [(dt.datetime(2021, 10, 1), 1), (dt.datetime(2021, 7, 1), 1)]
    with pytest.raises(ValueError, match="unknown time unit"):
        run(events, unit="fortnight")


def test_a_time_that_is_too_large_has_no_bucket(run):
    got = run([ssh(), ssh(start=1_625_140_991_000_000_000)], unit="day")
    assert [(r[0], r[-1]) for r in got] == [(None, 1), (dt.datetime(2021, 7, 1), 1)]


def test_another_session_zone_is_an_error(spark, run):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError, match="Asia/Tokyo"):
            run([ssh()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_optional_columns_may_be_absent(spark):
    df = spark.createDataFrame([(START, "x.y", "0", "SSH")], "time_at_start bigint, what string, result string, audit_type string")
    row = aggregate_events(df).collect()[0]
    assert (row.user_identifier, row.user_type, row.access_path, row.command) == (None, None, None, "x.y")


def test_user_columns(spark, rows):
    events = spark.createDataFrame([(1,), (2,), (3,), (None,)], "who int")
    accounts = spark.createDataFrame([(1, "one"), (2, "")], "account_id int, identifier string")
    types = spark.createDataFrame([(1, "bot"), (3, "service")], "id int, type string")
    assert rows(with_user_identifier(events, accounts)) == [(1, "one"), (2, ""), (3, "3"), (None, None)]
    assert rows(with_user_type(events, types)) == [(1, "bot"), (2, "human"), (3, "service"), (None, None)]
    assert rows(with_user_identifier(events)) == [(1, "1"), (2, "2"), (3, "3"), (None, None)]
    expected = [(1, "one", "bot"), (2, "", "human"), (3, "3", "service"), (None, None, None)]
    assert rows(with_user_columns(events, accounts, types)) == expected
