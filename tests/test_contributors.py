from __future__ import annotations

import json

import pytest

from changeledger.operators.contributors import (
    apply_aliases,
    commit_ids,
    drop_commits,
    filter_name_prefix,
    flatten_contributors,
    with_manifest_tags,
)
from changeledger.plans.commits import dashboard_stats

COLUMNS = [
    "project", "author", "email", "year", "month", "day", "hour", "num_files", "num_distinct_files", "added_lines",
    "deleted_lines", "num_commits", "last_commit_date", "is_merge", "commits", "branches", "is_bot_like", "hash_tags",
    "starting_revision",
]


def activity(**fields):
    line = {
        "name": "ada", "email": "ada@mail.com", "num_commits": 3, "num_files": 4, "num_distinct_files": 2,
        "added_lines": 5, "deleted_lines": 6, "last_commit_date": 1600000000000, "is_merge": True, "is_bot_like": False,
        "starting_revision": "HEAD",
        "commits": [
            {"sha1": "c1", "date": 0, "merge": True, "files": ["f1", "f2"]},
            {"sha1": "c2", "date": 1600000000000, "merge": False, "files": []},
        ],
    }
    return json.dumps({**line, **fields})


def flatten(spark, *lines, **options):
    df = spark.createDataFrame([(f"p{n}", text) for n, text in enumerate(lines)], "project string, json string")
    return flatten_contributors(df, **options)


def test_all_fields(spark, rows):
    df = flatten(spark, activity(year=2017, month=9, day=11, hour=23, branches=["main", "stable"], hash_tags=["t"]))
    assert df.columns == COLUMNS
    commits = (("c1", 0, True), ("c2", 1600000000000, False))
    assert rows(df) == [
        ("p0", "ada", "ada@mail.com", 2017, 9, 11, 23, 4, 2, 5, 6, 3, 1600000000000, True, commits, ("main", "stable"), False, ("t",), "HEAD")
    ]


def test_time_parts_and_lists_are_optional(spark):
    row = flatten(spark, activity()).collect()[0]
    assert (row.year, row.month, row.day, row.hour, row.branches, row.hash_tags) == (None,) * 6


def test_text_after_the_object_is_ignored(spark):
    row = flatten(spark, activity() + ', "branches":["x"]').collect()[0]
    assert (row.author, row.branches) == ("ada", None)


def test_bad_line_keeps_its_project(spark):
    row = flatten(spark, "nothing").collect()[0]
    assert row.project == "p0" and set(row[1:]) == {None}


@pytest.mark.parametrize("tags", [["one"], ["one", "two"], []])
def test_hash_tags(spark, tags):
    assert flatten(spark, json.dumps({"hash_tags": tags})).collect()[0].hash_tags == tags


def test_commit_list_can_be_left_out(spark):
    assert flatten(spark, activity(), with_commits=False).columns == [c for c in COLUMNS if c != "commits"]
    assert drop_commits(flatten(spark, activity())).columns == [c for c in COLUMNS if c != "commits"]


def test_commit_ids_are_distinct_over_projects(spark, rows):
    df = flatten(spark, activity(), activity(), activity(commits=[{"sha1": "c3"}]), activity(commits=[]), "bad")
    assert rows(commit_ids(df)) == [("c1",), ("c2",), ("c3",)]


STATS = "author string, email string, organization string"


def alias(spark, stats, aliases):
    return apply_aliases(spark.createDataFrame(stats, STATS), spark.createDataFrame(aliases, STATS))


def test_alias_author_and_organization(spark, rows):
    stats = [
        ("a", "plain@a.com", "a"),
        ("b", "full@b.com", "b"),
        ("c", "empty@c.com", "c"),
        ("d", "null@d.com", "d"),
        ("e", "nameless@e.com", "e"),
        ("f", "blank@f.com", "f"),
        ("g", None, "g"),
    ]
    aliases = [
        ("Bea", "full@b.com", "BigCo"),
        ("Cyd", "empty@c.com", ""),
        ("Dee", "null@d.com", None),
        (None, "nameless@e.com", "E-Corp"),
        ("", "blank@f.com", ""),
        ("Zoe", "PLAIN@a.com", "Zed"),
        ("Nil", None, "Nil"),
    ]
    df = alias(spark, stats, aliases)
    assert df.columns == ["author", "email", "organization"]
    assert rows(df) == sorted(
        [
            ("a", "plain@a.com", "a"),
            ("Bea", "full@b.com", "bigco"),
            ("Cyd", "empty@c.com", "c"),
            ("Dee", "null@d.com", "d"),
            ("e", "nameless@e.com", "e-corp"),
            ("", "blank@f.com", "f"),
            ("g", None, "g"),
        ],
        key=repr,
    )


def test_repeated_alias_repeats_the_row(spark, rows):
    got = rows(alias(spark, [("a", "x@y.z", "o")], [("one", "x@y.z", ""), ("two", "x@y.z", "T")]))
    assert got == [("one", "x@y.z", "o"), ("two", "x@y.z", "t")]


def test_no_aliases(spark):
    df = spark.createDataFrame([("a", "x@y.z", "o")], STATS)
    assert apply_aliases(df, None) is df


def test_dashboard_stats_let_the_alias_override_the_organization(spark):
    aliases = spark.createDataFrame([("Ada L", "ada@mail.com", "Analytical")], STATS)
    stats = flatten(spark, activity(), activity(email="bob@corp.co.uk", name="bob"))
    got = {r.author: r.organization for r in dashboard_stats(stats, aliases).collect()}
    assert got == {"Ada L": "analytical", "bob": "corp"}
    assert dashboard_stats(stats, aliases).columns == [c for c in COLUMNS if c != "commits"] + ["organization"]


def test_manifest_tags(spark):
    df = spark.createDataFrame([("v1",), ("v2",)], "input string")
    assert [tuple(r) for r in with_manifest_tags(df, "rel").collect()] == [("v1", "rel"), ("v2", "rel")]
    both = with_manifest_tags(df, "rel", "main")
    assert both.columns == ["input", "manifest_label", "manifest_branch"]
    assert [tuple(r) for r in both.collect()] == [("v1", "rel", "main"), ("v2", "rel", "main")]


def test_name_prefix(spark, rows):
    df = spark.createDataFrame([("abc",), ("Abc",), ("xab",)], "name string")
    assert rows(filter_name_prefix(df, "ab")) == [("abc",)]
    assert filter_name_prefix(df, None).count() == 3
