"""What the physical plans must look like to hold at scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from changeledger.operators.audit_events import filter_time_range, parse_audit_lines
from changeledger.operators.broadcasting import broadcast_if_small
from changeledger.operators.contributors import apply_aliases, flatten_contributors
from changeledger.operators.known_projects import with_project_of_distinct
from changeledger.operators.users import with_user_columns
from changeledger.plans.audit import aggregate_events
from changeledger.plans.commits import dashboard_stats
from changeledger.sources.contributors import landing_location, read_contributor_lines, with_source


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df):
    df.collect()
    text = plan(df)
    return text[: text.index("== Initial Plan ==")]


@pytest.fixture
def conf(spark):
    """Set options for one test."""
    changed = []

    def set_options(**options):
        for key, value in options.items():
            name = "spark.sql." + key.replace("__", ".")
            changed.append((name, spark.conf.get(name, None)))
            spark.conf.set(name, value)

    yield set_options
    for name, value in changed:
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_every_line_is_parsed_once(spark, tmp_path):
    (tmp_path / "log").write_text("x\n")
    lines = spark.read.text(str(tmp_path / "log"))
    events = filter_time_range(parse_audit_lines(lines), "2018-01-01", "2019-01-01")
    assert plan(events.where("audit_type = 'SSH' and who > 5 and access_path = 'GIT'")).count("from_json") == 1


def test_dropped_commit_lists_are_not_parsed(spark):
    lines = spark.createDataFrame([("p", "{}")], "project string, json string")
    text = plan(dashboard_stats(flatten_contributors(lines, with_commits=False)).where("num_commits > 1"))
    assert text.count("from_json") == 1 and "sha1" not in text


def write_dimensions(spark, path):
    spark.range(50).select(F.col("id").cast("int").alias("account_id"), F.col("id").cast("string").alias("identifier")).write.parquet(f"{path}/accounts")
    spark.range(50).select(F.col("id").cast("int"), F.lit("bot").alias("type")).write.parquet(f"{path}/types")
    spark.range(50).select(F.concat(F.lit("team/"), F.col("id").cast("string")).alias("name")).write.parquet(f"{path}/known")
    return [spark.read.parquet(f"{path}/{name}") for name in ("accounts", "types", "known")]


def events(spark, n=2000):
    return spark.range(n).select(
        F.lit("SSH").alias("audit_type"),
        F.lit("SSH_COMMAND").alias("access_path"),
        (F.col("id") % 40).cast("int").alias("who"),
        (F.col("id") * 60_000).alias("time_at_start"),
        F.concat(F.lit("review.ls.team/"), (F.col("id") % 60).cast("string")).alias("what"),
        F.lit("0").alias("result"),
    )


def test_audit_plan_shuffles_the_events_twice(spark, tmp_path):
    """Once to count identical events, once to count facets; lookups add none while they are small."""
    accounts, types, known = write_dimensions(spark, tmp_path)
    text = executed(aggregate_events(events(spark), accounts, types, known))
    fact_shuffles = re.findall(r"Exchange hashpartitioning\(events_time_bucket", text)
    assert len(fact_shuffles) == 2
    assert not re.search(r"Exchange hashpartitioning\((who|what|_candidate)", text)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_a_dominant_user_is_split_over_tasks(spark, conf, rows):
    """No broadcast: one user and the missing user hold most rows, and the join splits them."""
    conf(
        autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="4KB", adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="4KB", shuffle__partitions="16",
    )
    who = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id") % 5000).cast("int")
    rows_in = spark.range(60_000).repartition(8).select(who.alias("who"), F.col("id").alias("n"))
    directory = spark.range(5000).select(F.col("id").cast("int").alias("account_id"), F.concat(F.lit("u"), F.col("id").cast("string")).alias("identifier"))
    joined = with_user_columns(rows_in, directory)
    text = executed(joined)
    assert "skew=true" in text
    got = joined.agg(F.count("*"), F.count("user_identifier"), F.count_if(F.col("user_identifier") == "u7")).collect()[0]
    expected = rows_in.agg(F.count("*"), F.count("who"), F.count_if(F.col("who") == 7)).collect()[0]
    assert got[:] == expected[:]


def test_a_catalogue_too_large_to_broadcast_gives_the_same_projects(spark, tmp_path, conf, rows):
    known = write_dimensions(spark, tmp_path)[2]
    texts = events(spark).select("what", "access_path").distinct()
    small = rows(with_project_of_distinct(texts, known))
    conf(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    large = with_project_of_distinct(texts, known)
    assert rows(large) == small
    assert "SortMergeJoin" in executed(large) and "BroadcastHashJoin" not in executed(large)


def test_a_name_tried_by_every_text_is_split_over_tasks(spark, conf):
    """Catalogue too large to broadcast, and two candidate names common to all texts."""
    conf(
        autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="8KB", adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="8KB", adaptive__coalescePartitions__minPartitionSize="1KB",
        shuffle__partitions="16",
    )
    number = F.col("id").cast("string")
    texts = spark.range(50_000).select(F.concat(F.lit("review.ls.team/"), number).alias("what"), F.lit("SSH_COMMAND").alias("access_path"))
    known = spark.range(3000).select(F.concat(F.lit("team/"), number).alias("name"))
    resolved = with_project_of_distinct(texts.distinct(), known)
    assert "skew=true" in executed(resolved)
    assert resolved.where("project is not null").count() == 3000


def test_a_dominant_email_is_split_over_tasks(spark, conf):
    conf(
        autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="4KB", adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="4KB", shuffle__partitions="16",
    )
    email = F.when(F.col("id") % 2 == 0, "ci@x.org").otherwise(F.concat((F.col("id") % 900).cast("string"), F.lit("@x.org")))
    stats = spark.range(60_000).repartition(8).select(F.lit("a").alias("author"), email.alias("email"), F.lit("x").alias("organization"), "id")
    aliases = spark.range(900).select(F.lit("A").alias("author"), F.concat(F.col("id").cast("string"), F.lit("@x.org")).alias("email"), F.lit("Y").alias("organization"))
    joined = apply_aliases(stats, aliases)
    assert "skew=true" in executed(joined)
    assert joined.where("author = 'a'").count() == 30_000


def test_only_landed_directories_of_wanted_projects_are_read(spark, tmp_path):
    for name, ref in [("a", "main"), ("b", "main"), ("b", "v1"), ("c", "main")]:
        (tmp_path / f"project={name}" / f"ref={ref}").mkdir(parents=True)
        (tmp_path / f"project={name}" / f"ref={ref}" / "1.json").write_text(f'{{"name":"{name}"}}\n' * 2000)
    path = str(tmp_path / "_projects")
    spark.createDataFrame([("b", "b", "v1")], "id string, name string, ref_name string").write.parquet(path)
    projects = with_source(spark.read.parquet(path), landing_location("/x"))
    lines = read_contributor_lines(spark, str(tmp_path), projects)
    assert lines.groupBy("project").count().collect()[0][:] == ("b", 2000)
    read = executed(lines)
    assert "dynamicpruningexpression(project" in read


def test_broadcast_depends_on_the_measured_size(spark, conf, rows):
    conf(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    stats = spark.range(100).select(F.lit("a").alias("author"), F.col("id").cast("string").alias("email"), F.lit("x").alias("organization"))
    aliases = spark.range(50).select(F.lit("A").alias("author"), F.col("id").cast("string").alias("email"), F.lit("Y").alias("organization"))
    hinted = apply_aliases(stats, broadcast_if_small(aliases))
    unhinted = apply_aliases(stats, broadcast_if_small(aliases, limit_bytes=50))
    assert "BroadcastHashJoin" in plan(hinted) and "SortMergeJoin" in plan(unhinted)
    assert rows(hinted) == rows(unhinted)
    assert broadcast_if_small(aliases.where("false"), limit_bytes=0).count() == 0
