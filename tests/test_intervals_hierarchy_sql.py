"""Interval joins, project hierarchies, functions in SQL text, reasons of rejected lines."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from changeledger.functions import audit_fields, sql, times
from changeledger.functions.organization import organization_of
from changeledger.operators.audit_events import count_rejected_lines, parse_audit_lines
from changeledger.operators.hierarchy import resolve_hierarchy
from changeledger.operators.intervals import DAY_MS, summarize_within_intervals, within_intervals


def matches(times_, intervals):
    return sorted((t, k) for t in times_ for k, start, end in intervals if (start is None or start <= t) and (end is None or t <= end))


def test_random_intervals(spark):
    """Short, long, open, empty and border-to-border intervals against BETWEEN."""
    rng = random.Random(2)
    intervals = [(0, None, 5 * DAY_MS), (1, -7, None), (2, None, None), (3, 5, 4), (4, 0, 1024 * DAY_MS - 1), (5, 0, 1024 * DAY_MS), (6, 32 * DAY_MS, 64 * DAY_MS - 1), (7, 9, 9)]
    for k in range(8, 70):
        start = rng.randrange(-3000 * DAY_MS, 3000 * DAY_MS)
        intervals.append((k, start, start + rng.choice([0, 1, DAY_MS - 1, DAY_MS, rng.randrange(50 * DAY_MS), rng.randrange(4000 * DAY_MS)])))
    times_ = [rng.randrange(-3500 * DAY_MS, 4500 * DAY_MS) for _ in range(200)] + [0, 9, -1, -7, 32 * DAY_MS, 64 * DAY_MS - 1, 1024 * DAY_MS - 1, 1024 * DAY_MS]
    rows = spark.createDataFrame([(t,) for t in [*times_, None]], "t bigint")
    joined = within_intervals(rows, spark.createDataFrame(intervals, "k int, opens bigint, closes bigint"), "t", "opens", "closes")
    assert sorted((r.t, r.k) for r in joined.collect()) == matches(times_, intervals)
    assert "NestedLoop" not in joined._jdf.queryExecution().executedPlan().toString()


def test_a_day_with_a_third_of_the_rows_is_split(spark):
    """No broadcast: the blocks of intervals meet the rows by shuffle, and the busy day by several tasks."""
    options = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    }
    before = {name: spark.conf.get(name, None) for name in options}
    from changeledger.operators import intervals as module

    hinted = module.broadcast_if_small
    try:
        module.broadcast_if_small = lambda frame: frame
        for name, value in options.items():
            spark.conf.set(name, value)
        rows = spark.range(60_000).repartition(8).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.col("id") * 40_000_000).alias("t"))
        intervals = spark.range(300).select(F.col("id").alias("k"), (F.col("id") * 10 * DAY_MS).alias("opens"), (F.col("id") * 10 * DAY_MS + 3 * DAY_MS - 1).alias("closes"))
        joined = within_intervals(rows, intervals, "t", "opens", "closes")
        assert joined.count() == rows.where(f"t < {3000 * DAY_MS} AND t % {10 * DAY_MS} < {3 * DAY_MS}").count()
        joined.collect()
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in text[: text.index("== Initial Plan ==")]
    finally:
        module.broadcast_if_small = hinted
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_intervals_that_become_many_blocks_are_not_broadcast_on_an_estimate(spark, monkeypatch):
    """Spark takes an interval for one row, however many blocks it has; only a measured size may choose the broadcast."""
    from changeledger.operators import intervals as module

    monkeypatch.setattr(module, "broadcast_if_small", lambda frame: frame)
    rows = spark.range(1000).select((F.col("id") * DAY_MS).alias("t"))
    intervals = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * DAY_MS).alias("opens"), F.lit(None).cast("bigint").alias("closes"))
    joined = within_intervals(rows, intervals, "t", "opens", "closes")
    assert joined.count() == sum(1000 - k for k in range(50))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_an_interval_without_end_has_few_blocks(spark):
    from changeledger.operators.intervals import BLOCKS_MS, _bounds, _cover

    spans = spark.createDataFrame([(694_224_000_000 + 12_345, None)], "opens bigint, closes bigint")
    assert spans.select(F.size(_cover(*_bounds("opens", "closes"), BLOCKS_MS)).alias("n")).first().n < 300


def test_summed_up_intervals_are_the_pairs_grouped(spark, rows):
    """Ends at any millisecond, open, empty and equal intervals; times that repeat, lie at borders, before 1970 or are null."""
    rng = random.Random(3)
    minute, hour = 60_000, 3_600_000
    intervals = [(0, None, 5 * DAY_MS), (1, -7, None), (2, None, None), (3, 5, 4), (4, 0, 1024 * DAY_MS - 1), (5, 0, 1024 * DAY_MS), (6, 32 * DAY_MS, 64 * DAY_MS - 1), (7, 9, 9), (8, 10**17, None)]
    for k in range(9, 90):
        start = rng.randrange(-3000 * DAY_MS, 3000 * DAY_MS) // (unit := rng.choice([1, 1, minute, hour, DAY_MS])) * unit
        intervals.append((k, start, start + rng.choice([0, 1, minute - 1, minute, rng.randrange(3 * hour), DAY_MS - 1, DAY_MS, rng.randrange(50 * DAY_MS), rng.randrange(4000 * DAY_MS)])))
    intervals += intervals[4:20]
    ends = [end for _, *both in intervals for end in both if end is not None and abs(end) < 10**15]
    times_ = [rng.randrange(-3500 * DAY_MS, 4500 * DAY_MS) for _ in range(300)] + [end + step for end in ends for step in (-1, 0, 1)] * 2
    commits = spark.createDataFrame([(t,) for t in [*times_, None]], "t bigint")
    windows = spark.createDataFrame(intervals, "k int, opens bigint, closes bigint")
    pairs = within_intervals(commits, windows, "t", "opens", "closes").groupBy("k", "opens", "closes")
    expected = rows(pairs.agg(F.count(F.lit(1)), F.min("t"), F.max("t")))
    assert len(expected) > 60
    assert rows(summarize_within_intervals(commits, windows, "t", "opens", "closes")) == expected


def test_rows_are_summed_up_before_they_meet_the_intervals(spark, monkeypatch):
    """A thousand intervals over a hundred thousand times meet spans, not a hundred million pairs."""
    from changeledger.operators import intervals as module

    met = []

    def within(rows, intervals, *rest):
        met.append(within_intervals(rows, intervals, *rest))
        return met[-1]

    monkeypatch.setattr(module, "within_intervals", within)
    commits = spark.range(100_000).select((F.col("id") * 1_234_567).alias("t"))
    windows = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 777).alias("opens"), (F.lit(200_000_000_000) - F.col("id")).alias("closes"))
    found = summarize_within_intervals(commits, windows, "t", "opens", "closes").collect()
    assert {(row.k, row.num_rows) for row in found} == {(k, 100_000 - (k > 0)) for k in range(1000)}
    assert met[0].count() < 300 * 1000


def plain_hierarchy(parents, tags):
    found = []
    for name in parents:
        path = [name]
        while parents.get(path[-1]) in parents and parents[path[-1]] not in path:
            path.append(parents[path[-1]])
        if parents.get(path[-1]) in parents:
            found.append((name, None, None, None, True))
        else:
            found.append((name, path[-1], len(path) - 1, next((n for n in path if n in tags), None), False))
    return sorted(found)


def test_trees_chains_and_cycles(spark):
    parents = {f"p{k}": None if k == 0 else f"p{k // 3}" if k < 40 else f"p{k - 1}" for k in range(120)}
    parents |= {"a": "b", "b": "c", "c": "a", "below": "a", "self": "self", "orphan": "gone", "é": "p119"}
    tags = {"p0", "p50", "p3", "a", "orphan", "nobody"}
    frame = spark.createDataFrame([*parents.items(), (None, "p1")], "name string, parent string")
    got = resolve_hierarchy(frame, spark.createDataFrame([(t,) for t in tags], "name string"))
    assert sorted(tuple(r) for r in got.collect()) == plain_hierarchy(parents, tags)


def test_small_hierarchies(spark):
    empty = spark.createDataFrame([], "name string, parent string")
    assert resolve_hierarchy(empty).count() == 0
    one = spark.createDataFrame([("p", None), ("p", "q"), ("q", None)], "name string, parent string")
    assert sorted(tuple(r) for r in resolve_hierarchy(one).collect()) == [("p", "q", 1, None, False), ("q", "q", 0, None, False)]


def test_sql_functions_are_the_column_functions(spark):
    what = ["shop.ls.-a", "LOGIN", ".x", "a.", "git-upload-pack./p", "https://h/p/git-receive-pack", "/a/changes/1", "/config", "AUTH", "", None]
    rows = spark.createDataFrame([(w, p, m) for w in what for p in ("SSH_COMMAND", "GIT", "REST_API", "UNKNOWN", "OTHER", None) for m in ("GET", None)], "what string, access_path string, http_method string")
    assert sql.register_sql_functions(spark)[1] == "audit_command"
    columns = [F.col(name) for name in rows.columns]
    wanted = rows.select(audit_fields.command(*columns), audit_fields.command_arguments(*columns[:2]), audit_fields.sub_command(*columns[:2])).collect()
    got = spark.sql("SELECT audit_command(what, access_path, http_method), audit_command_arguments(what, access_path), audit_sub_command(what, access_path) FROM {rows}", rows=rows).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in wanted]
    emails = spark.createDataFrame([(e,) for e in ("A@Foo.Co.UK", "a@simple", "x", "a@b@c.org", "", None)], "email string")
    assert spark.sql("SELECT email_organization(email) FROM {emails}", emails=emails).collect() == emails.select(organization_of(F.col("email"))).collect()
    ms = spark.createDataFrame([(0,), (-1,), (1_625_140_991_123,), (2**62,), (None,)], "ms bigint")
    assert [r[0] for r in spark.sql("SELECT epoch_ms_bucket('week', ms) FROM {ms}", ms=ms).collect()] == [r[0] for r in ms.select(times.time_bucket(F.col("ms"), "week")).collect()]


GOOD = '{"type":"SshAuditEvent","event":{"session_id":"s","time_at_start":1,"what":"w","elapsed":1,"uuid":{"uuid":"u"},"result":"0"}}'


def test_every_line_is_an_event_or_has_a_reason(spark):
    lines = [
        (GOOD, None), ("", "no document"), (None, "no document"), ("{}", "unknown type"), (GOOD + GOOD, "no document"), (GOOD + " x", "no document"), (GOOD + ",", "no document"),
        (GOOD.replace("SshAuditEvent", "Other"), "unknown type"), (GOOD.replace('"elapsed":1', '"elapsed":1.5'), "elapsed"), (GOOD.replace('"what":"w",', ""), "what"),
        (GOOD.replace("SshAuditEvent", "HttpAuditEvent").replace('"result"', '"http_status"'), "http_method"), (GOOD.replace('"uuid":{"uuid":"u"},', ""), "uuid"),
    ]
    frame = spark.createDataFrame([(text,) for text, _ in lines], "value string")
    reasons = [reason for _, reason in lines if reason]
    got = {r.reason: r.num_lines for r in count_rejected_lines(frame).collect()}
    assert got == {reason: reasons.count(reason) for reason in reasons}
    assert parse_audit_lines(frame).count() == len(lines) - len(reasons)


@pytest.mark.parametrize("whole, kept", [(False, 1), (True, 3)])
def test_the_last_day_may_count_whole(spark, whole, kept):
    day = times.start_of_day_ms(times.parse_bound("2024-01-05"))
    frame = spark.createDataFrame([(day - 1,), (day,), (day + 1,), (day + DAY_MS - 1,), (day + DAY_MS,)], "ms bigint")
    assert frame.where(times.within_range(F.col("ms"), "2024-01-05", "2024-01-05", whole)).count() == kept
