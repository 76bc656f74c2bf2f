import pytest

from changeledger.operators.rollup import filter_commit_dates, roll_up_contributors
from changeledger.plans.reports import (
    git_command_split,
    git_traffic_over_time,
    git_transport_split,
    top_receive_pack_users,
)

HOUR = 3_600_000
T0 = 17_532 * 24 * HOUR  # 2018-01-01T00:00Z
SCHEMA = (
    "project string, author string, email string, sha1 string, date bigint, merge boolean, file string, "
    "added_lines bigint, deleted_lines bigint, branches array<string>"
)


@pytest.fixture
def changes(spark):
    return spark.createDataFrame(
        [
            ("p", "ada", "a@x", "c1", T0, False, "f1", 1, 10, ["main", "old"]),
            ("p", "ada", "a@x", "c1", T0, False, "f2", 2, 20, ["old", "main"]),
            ("p", "ada", "a@x", "c2", T0 + HOUR, True, "f1", 4, 40, ["dev"]),
            ("p", "ada", "a@x", "c3", T0 + 40 * 24 * HOUR, False, "f3", 8, 80, None),
            ("p", None, None, "c4", T0, False, "f1", 16, 0, ["odd", None]),
        ],
        SCHEMA,
    )


def test_whole_history(changes):
    got = {r.author: r for r in roll_up_contributors(changes, "email", extract_branches=True).collect()}
    ada = got["ada"]
    assert (ada.num_files, ada.num_distinct_files, ada.added_lines, ada.deleted_lines, ada.num_commits) == (4, 3, 15, 150, 3)
    assert (ada.last_commit_date, ada.is_merge, ada.branches, ada.year) == (T0 + 40 * 24 * HOUR, True, ["dev", "main", "old"], None)
    assert (got[None].num_commits, got[None].branches) == (1, ["odd"])


@pytest.mark.parametrize(
    "aggregate, parts",
    [
        ("email_year", {(2018, None, None, None)}),
        ("email_month", {(2018, 1, None, None), (2018, 2, None, None)}),
        ("email_day", {(2018, 1, 1, None), (2018, 2, 10, None)}),
        ("email_hour", {(2018, 1, 1, 0), (2018, 1, 1, 1), (2018, 2, 10, 0)}),
    ],
)
def test_grains(changes, aggregate, parts):
    got = roll_up_contributors(changes.where("author = 'ada'"), aggregate, extract_branches=True).collect()
    assert {(r.year, r.month, r.day, r.hour) for r in got} == parts
    assert sum(r.num_commits for r in got) == 3


def test_unknown_grain(changes):
    with pytest.raises(ValueError, match="unknown aggregation"):
        roll_up_contributors(changes, "email_week")


def test_commit_dates(changes):
    assert filter_commit_dates(changes, "2018-01-01", "2018-01-01").count() == 3
    assert filter_commit_dates(changes, since="2018-01-02").count() == 1
    assert filter_commit_dates(changes).count() == 5


@pytest.fixture
def counts(spark):
    return spark.createDataFrame(
        [
            ("b1", "SSH", "ada", "git-receive-pack", 3),
            ("b1", "HTTP", "bob", "git-receive-pack", 5),
            ("b2", "EXTENDED_HTTP", "cyd", "git-receive-pack", 3),
            ("b2", "SSH", None, "git-receive-pack", 50),
            ("b2", "HTTP", "bob", "git-upload-pack", 7),
            ("b2", "SSH", "bob", "review", 100),
        ],
        "events_time_bucket string, audit_type string, user_identifier string, command string, num_events bigint",
    )


def test_reports(counts, rows):
    assert rows(git_traffic_over_time(counts)) == [("b1", 8), ("b2", 60)]
    assert rows(git_transport_split(counts)) == [("HTTP", 15), ("SSH", 53)]
    assert rows(git_command_split(counts)) == [("git-receive-pack", 61), ("git-upload-pack", 7)]
    assert [tuple(r) for r in top_receive_pack_users(counts, 2).collect()] == [("bob", 5), ("ada", 3)]
