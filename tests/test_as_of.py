"""Values that hold from a date on."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from changeledger.operators.as_of import apply_aliases_as_of, with_user_type_as_of, with_value_as_of

DAY = 86_400_000


def test_types_hold_from_their_millisecond_on(spark):
    events = spark.createDataFrame([(1, 999), (1, 1000), (1, 5 * DAY), (1, 9 * DAY), (2, 0), (None, 0), (1, None)], "who int, time_at_start bigint")
    history = spark.createDataFrame([(1, 1000, "bot"), (1, 7 * DAY, None), (3, 0, "bot"), (None, 0, "bot"), (1, None, "bot")], "id int, valid_from bigint, type string")
    got = {(r.who, r.time_at_start): r.user_type for r in with_user_type_as_of(events, history).collect()}
    assert got == {
        (1, 999): "human", (1, 1000): "bot", (1, 5 * DAY): "bot", (1, 9 * DAY): "human", (2, 0): "human", (None, 0): None, (1, None): "human",
    }


def test_random_histories(spark):
    """Against a plain loop, with slices much shorter than the histories, and equal times."""
    rng = random.Random(3)
    entries = [(rng.randrange(5), rng.randrange(-50, 300), rng.choice("abc")) for _ in range(60)]
    facts = [(n, rng.randrange(6), rng.randrange(-60, 320)) for n in range(400)]
    expected = {}
    for n, key, at in facts:
        known = [(start, value) for k, start, value in entries if k == key and start <= at]
        expected[n] = max(known)[1] if known else None
    history = spark.createDataFrame(entries, "key int, since bigint, value string")
    rows = spark.createDataFrame(facts, "n int, key int, at bigint")
    got = with_value_as_of(rows, history, "key", "at", "since", ["value"], slice_ms=25)
    assert {r.n: r.value for r in got.collect()} == expected


def test_a_dominant_user_is_spread_over_slices(spark):
    """One user and the missing user hold two thirds of the events; no task sorts more than a few of their slices."""
    who = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id") % 500).cast("int")
    events = spark.range(90_000).select(who.alias("who"), (F.col("id") * 60_000).alias("time_at_start"))
    history = spark.createDataFrame([(7, 30 * DAY, "bot")], "id int, valid_from bigint, type string")
    typed = with_user_type_as_of(events, history)
    assert typed.where("user_type = 'bot'").count() == events.where(f"who = 7 AND time_at_start >= {30 * DAY}").count()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in typed.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 2.5 * sum(sizes) / len(sizes)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert "NestedLoop" not in typed._jdf.queryExecution().executedPlan().toString()


def test_aliases_by_date(spark, rows):
    stats = spark.createDataFrame([("ada", "a@x", "x", 5 * DAY), ("ada", "a@x", "x", 50 * DAY), ("ada", "a@x", "x", 90 * DAY), ("bob", None, "", 50 * DAY)], "author string, email string, organization string, last_commit_date bigint")
    history = spark.createDataFrame([("a@x", 40 * DAY, "Ada L", "ACME"), ("a@x", 80 * DAY, None, "")], "email string, valid_from bigint, author string, organization string")
    assert rows(apply_aliases_as_of(stats, history)) == [
        ("Ada L", "a@x", "acme", 50 * DAY), ("ada", "a@x", "x", 5 * DAY), ("ada", "a@x", "x", 90 * DAY), ("bob", None, "", 50 * DAY),
    ]


def test_empty_sides(spark):
    events = spark.createDataFrame([(1, 5)], "who int, time_at_start bigint")
    history = spark.createDataFrame([], "id int, valid_from bigint, type string")
    assert with_user_type_as_of(events, history).collect()[0].user_type == "human"
    assert with_user_type_as_of(events.where("false"), history).count() == 0
