"""One query per operator, over whole tables. Names start with the operator's survey id."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeledger.functions import audit_fields, project_fields, text, times
from changeledger.functions.organization import organization_of
from changeledger.functions.sql import register_sql_functions
from changeledger.operators import as_of, audit_columns, audit_events, contributors, facet_cube, hierarchy, intervals, known_projects, project_order, rollup, sessions, sketches, users
from changeledger.plans import audit, commits, incremental, reports
from changeledger.session import configure, scratch_dir
from changeledger.sinks.documents import Target, write_all, write_documents, write_json
from changeledger.sources import audit_logs, csv_lists, manifest, server_pages
from changeledger.sources import contributors as landed
from changeledger.streaming import audit as live

from . import views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SINCE, UNTIL = "2024-01-05", "2024-01-20"
COMMITS_SINCE, COMMITS_UNTIL = "1996-03-01", "2000-06-15"


def query(function: Query) -> Query:
    """Register under the function's name, on a session configured for the package."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    QUERIES[function.__name__] = run
    return function


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_events.parse_audit_lines(views.audit_lines(spark, sf_dir))


def _untyped(df: DataFrame, *names: str) -> DataFrame:
    """Timestamps without a zone, the form the checking engine returns."""
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names})


def _counts(spark: SparkSession, sf_dir: str, unit: str = "hour", **bounds: str | bool) -> DataFrame:
    return audit.aggregate_events(
        _events(spark, sf_dir),
        accounts=views.accounts(spark, sf_dir),
        user_types=_user_types(spark, sf_dir),
        known_projects=views.known_projects(spark, sf_dir),
        unit=unit,
        **bounds,
    )


def _user_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.user_type_entries(spark, sf_dir)


# --- sources ---------------------------------------------------------------------------------


@query
def s1_audit_log_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "audit-log")
    views.audit_lines(spark, sf_dir).write.option("compression", "gzip").text(path)
    return audit_logs.read_audit_log(spark, path)


def _pinned_ref() -> Column:
    """Some projects are imported from a tag, the others from their default branch."""
    return F.when(F.col("project").endswith("machinery"), "refs/tags/v1")


def _land_contributors(spark: SparkSession, sf_dir: str, ref: Column) -> str:
    """Lines under the ref, blank ones among them, and the same lines again under a ref nobody wants."""
    root = scratch_dir(spark, "contributors")
    lines = views.contributor_lines(spark, sf_dir)
    padded = F.explode(F.array(F.col("json"), F.lit(""), F.lit(" \t ")))
    refs = lines.select(padded.alias("value"), "project", F.array(ref, F.lit("refs/heads/another")).alias("refs"))
    staged = refs.select("value", "project", F.explode("refs").alias("ref"))
    # Rebalancing gives few files per project and still splits a project that dominates.
    staged.hint("rebalance", F.col("project")).write.partitionBy("project", "ref").text(root)
    return root


def _wanted_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The projects of committers with a positive balance, and one that was never landed."""
    names = views.committers(spark, sf_dir).join(
        views.table(spark, sf_dir, "customer").where("c_mktsegment <> 'HOUSEHOLD'").select("c_custkey"), "c_custkey"
    )
    listed = names.select(F.explode(F.array("project", F.concat("project", F.lit("-new")))).alias("name")).distinct()
    return listed.select(
        project_fields.encode_project(F.col("name")).alias("id"),
        "name",
        F.when(F.col("name").endswith("machinery"), "refs/tags/v1").alias("ref_name"),
    )


@query
def s2_contributor_lines_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _land_contributors(spark, sf_dir, _pinned_ref())
    sources = landed.with_source(_wanted_projects(spark, sf_dir), landed.landing_location(root))
    lines = landed.read_contributor_lines(spark, root, sources)
    return lines.select("project", "ref", F.get_json_object("json", "$.email").alias("email"), F.length("json").cast("bigint").alias("line_length"))


@query
def s2b_project_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed.with_source(_wanted_projects(spark, sf_dir), landed.landing_location("/landing"))


def _write_pages(pages: DataFrame, path: str) -> str:
    pages.write.partitionBy("page").text(path)
    return path


@query
def s3_project_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Trailing commas occur in listings and must not matter.
    entry = """concat('"', s_name, '": {"id": "', url_encode(s_name), '",}')"""
    entries = views.table(spark, sf_dir, "supplier").selectExpr(f"{entry} AS entry", "s_suppkey")
    pages = views.as_pages(entries, F.col("s_suppkey"), "{", ",\n}")
    listed = server_pages.read_project_listing(spark, _write_pages(pages, scratch_dir(spark, "listing")))
    return listed.select("id", "name", F.col("ref_name").isNull().alias("without_ref"))


@query
def s4_known_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Every name is listed twice, and a project in another state must not appear at all.
    entries = views.known_project_entries(spark, sf_dir).selectExpr(
        """explode(array(
            to_json(named_struct('name', name, 'state', state)),
            to_json(named_struct('name', name, 'state', state)),
            to_json(named_struct('name', concat(name, '-hidden'), 'state', 'HIDDEN')))) AS entry""",
        "s_suppkey",
    )
    pages = views.as_pages(entries, F.col("s_suppkey"))
    return server_pages.read_known_projects(spark, _write_pages(pages, scratch_dir(spark, "known-projects")))


@query
def s5_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = views.account_entries(spark, sf_dir)
    pages = views.as_pages(
        entries.select(F.to_json(F.struct("*")).alias("entry"), F.col("_account_id")), F.col("_account_id")
    )
    return server_pages.read_accounts(spark, _write_pages(pages, scratch_dir(spark, "accounts")))


@query
def s6_alias_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "aliases")
    views.aliases(spark, sf_dir).select("organization", "email", "author").write.csv(path, header=True)
    return csv_lists.read_aliases(spark, path)


@query
def s7_user_type_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "user-types")
    views.user_type_entries(spark, sf_dir).write.csv(path, header=True)
    return csv_lists.read_user_types(spark, path)


@query
def s8_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = """concat(
        '<project name="nation', s_nationkey, '/', lower(replace(s_name, '#', '-')), '.git"',
        if(s_acctbal >= 0, concat(' revision="refs/tags/v', s_nationkey, '"'), ''),
        ' path="x"><linkfile src="a" dest="b"/></project>')"""
    entries = views.table(spark, sf_dir, "supplier").selectExpr(f"{entry} AS entry", "s_suppkey")
    opening = '<manifest>\n<remote name="r"/>\n<default revision=" main " remote="r"/>\n'
    documents = views.as_documents(entries, F.floor(F.col("s_suppkey") / views.PAGE_SIZE), opening, "\n", "\n</manifest>")
    return manifest.read_manifest(spark, _write_pages(documents, scratch_dir(spark, "manifest")))


# --- sinks -----------------------------------------------------------------------------------


@query
def k1_json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "json-sink")
    write_json(_events(spark, sf_dir), path)
    return spark.read.text(path).select(
        F.get_json_object("value", "$.uuid").alias("uuid"),
        F.get_json_object("value", "$.http_method").alias("http_method"),
        F.col("value").contains('"http_method"').alias("has_http_method"),
        F.col("value").contains('"who"').alias("has_who"),
    )


@query
def k2_index_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "index-sink")
    write_documents(_counts(spark, sf_dir), Target(path, "parquet"))
    return _untyped(spark.read.parquet(path), "events_time_bucket")


@query
def k3_written_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, index = scratch_dir(spark, "documents"), scratch_dir(spark, "index")
    stats = commits.dashboard_stats(contributors.flatten_contributors(views.contributor_lines(spark, sf_dir), False))
    write_all(stats, [Target(documents), Target(index, "parquet")], count=True)
    columns = ["project", "author", "email", "organization", "last_commit_date"]
    schema = "project string, author string, email string, organization string, last_commit_date bigint"
    written = spark.read.schema(schema).json(documents).select(F.lit("documents").alias("target"), *columns)
    return written.unionByName(spark.read.parquet(index).select(F.lit("index").alias("target"), *columns))


# --- parsing and projection ------------------------------------------------------------------


@query
def p1_drop_response_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = views.table(spark, sf_dir, "documents")
    prefixed = F.concat(F.lit(")]}'\n"), F.col("text"))
    return documents.select(
        "doc_id",
        text.drop_response_prefix(prefixed).alias("body"),
        text.drop_response_prefix(F.col("text")).alias("rest"),
    )


@query
def p2_flatten_contributors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contributors.flatten_contributors(views.contributor_lines(spark, sf_dir))
    # Nested values are compared as text.
    return rows.withColumns(
        {
            "commits": F.expr("array_join(transform(commits, c -> concat_ws(':', c.sha1, c.date, c.merge)), ';')"),
            "branches": F.array_join("branches", ";"),
            "hash_tags": F.array_join("hash_tags", ";"),
        }
    )


@query
def p3_parse_audit_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir)


@query
def p4_audit_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = audit_events.audit_documents(_events(spark, sf_dir))
    names = ["audit_type", "http_method", "result", "time_at_start", "uuid", "what", "who"]
    fields = F.json_object_keys("document")
    return documents.select(
        *[F.get_json_object("document", f"$.{name}").alias(name) for name in names],
        F.array_join(F.array_sort(fields), ",").alias("fields"),
    )


@query
def p5_missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    partial = _events(spark, sf_dir).drop("who", "http_method")
    completed = audit_events.with_event_columns(partial)
    return completed.select(
        "uuid",
        "access_path",
        F.col("who").isNull().alias("who_is_null"),
        F.col("http_method").isNull().alias("http_method_is_null"),
    )


@query
def p6_drop_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contributors.drop_commits(contributors.flatten_contributors(views.contributor_lines(spark, sf_dir)))
    return rows.select(F.array_join(F.lit(rows.columns), ",").alias("columns"), "email", "last_commit_date")


@query
def p7_manifest_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.committers(spark, sf_dir).select("email", "project")
    return contributors.with_manifest_tags(rows, "release-1", "main")


# --- filters ---------------------------------------------------------------------------------


@query
def f1_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_events.filter_time_range(_events(spark, sf_dir), SINCE, UNTIL).select("uuid", "time_at_start")


@query
def f2_blank_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = views.table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("value"))
    return landed.drop_blank_lines(lines).groupBy("doc_id").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.length("value")).alias("chars"))


@query
def f3_malformed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).groupBy("audit_type").agg(F.count(F.lit(1)).alias("events"))


@query
def f4_project_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contributors.filter_name_prefix(views.known_projects(spark, sf_dir), "nation1")


@query
def f5_commit_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = rollup.filter_commit_dates(views.commit_changes(spark, sf_dir), COMMITS_SINCE, COMMITS_UNTIL)
    return changes.groupBy("project").agg(F.count(F.lit(1)).alias("changes"), F.min("date").alias("first"), F.max("date").alias("last"))


@query
def f6_freeze_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commits made in each window."""
    commits_made = views.table(spark, sf_dir, "orders").select(F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("date"))
    found = intervals.summarize_within_intervals(commits_made, views.freeze_windows(spark, sf_dir), "date", "opens", "closes")
    return found.groupBy("window").agg(F.sum("num_rows").alias("num_commits"), F.min("first").alias("first"), F.max("last").alias("last"))


@query
def f7_rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_events.count_rejected_lines(views.audit_lines(spark, sf_dir))


# --- joins -----------------------------------------------------------------------------------


@query
def j1_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contributors.with_organization(views.committers(spark, sf_dir).select("project", "author", "email"))
    return contributors.apply_aliases(rows, views.aliases(spark, sf_dir))


@query
def j2_user_identifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _events(spark, sf_dir).select("uuid", "who")
    return users.with_user_identifier(rows, views.accounts(spark, sf_dir))


@query
def j3_user_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _events(spark, sf_dir).select("uuid", "who")
    return users.with_user_type(rows, _user_types(spark, sf_dir))


@query
def j4_leading_known_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _events(spark, sf_dir).select("uuid", "what")
    return known_projects.match_leading(rows, "what", views.known_projects(spark, sf_dir))


@query
def j5_trailing_known_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = views.known_projects(spark, sf_dir)
    rows = _events(spark, sf_dir).select("uuid", "what")
    dotted = known_projects.match_trailing(rows, "what", known, ".", "dotted")
    return known_projects.match_trailing(dotted, "what", known, "/", "slashed")


@query
def j6_project_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing restricted to a prefix, then joined with the landed lines of the default branches."""
    root = _land_contributors(spark, sf_dir, F.lit(None).cast("string"))
    path = scratch_dir(spark, "selection")
    entry = """concat('"nation', n_nationkey, '/building": {"id": "nation', n_nationkey, '%2Fbuilding"}')"""
    entries = views.table(spark, sf_dir, "nation").selectExpr(f"{entry} AS entry", "n_nationkey")
    _write_pages(views.as_pages(entries, F.col("n_nationkey"), "{", "}"), path)
    job = commits.CommitsJob(landing_root=root, listing_path=path, prefix="nation1")
    stats = commits.contributor_stats(spark, commits.select_projects(spark, job), root, with_commits=False)
    return stats.groupBy("project").agg(F.count(F.lit(1)).alias("rows"), F.sum("added_lines").alias("added_lines"))


@query
def j7_user_type_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _events(spark, sf_dir).select("uuid", "who", "time_at_start")
    return as_of.with_user_type_as_of(rows, views.user_type_history(spark, sf_dir))


@query
def j8_aliases_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = contributors.flatten_contributors(views.contributor_lines(spark, sf_dir), with_commits=False)
    rows = contributors.with_organization(stats.select("project", "author", "email", "last_commit_date", "added_lines"))
    return as_of.apply_aliases_as_of(rows, views.alias_history(spark, sf_dir))


@query
def j10_leading_known_project_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _events(spark, sf_dir).select("uuid", "what")
    return project_order.match_leading_in_order(rows, "what", views.known_projects(spark, sf_dir))


@query
def j9_project_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.resolve_hierarchy(views.project_parents(spark, sf_dir), views.tagged_projects(spark, sf_dir))


# --- extraction ------------------------------------------------------------------------------


@query
def x0_regex_helpers(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    host = r"https?://([^/]+)"
    page = r"[?&]page=([0-9]*)"
    return views.table(spark, sf_dir, "pages").select(
        "page_id",
        text.matches(url, "^https").alias("is_https"),
        text.capture(url, host).alias("host"),
        text.capture(url, page, may_be_empty=True).alias("page_number"),
        text.capture_or_else(url, r"#(\w+)$", F.lit("none")).alias("anchor"),
    )


@query
def x1_organization(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.committers(spark, sf_dir).select("email", organization_of(F.col("email")).alias("organization"))


@query
def x2_command(spark: SparkSession, sf_dir: str) -> DataFrame:
    column = audit_fields.command(F.col("what"), F.col("access_path"), F.col("http_method"))
    return _events(spark, sf_dir).select("uuid", column.alias("command"))


@query
def x3_command_arguments(spark: SparkSession, sf_dir: str) -> DataFrame:
    column = audit_fields.command_arguments(F.col("what"), F.col("access_path"))
    return _events(spark, sf_dir).select("uuid", column.alias("command_arguments"))


@query
def x4_sub_command(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_columns.with_sub_command(_events(spark, sf_dir)).select("uuid", "sub_command")


@query
def x5_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _events(spark, sf_dir).select("uuid", "what", "access_path")
    return known_projects.with_project(rows, views.known_projects(spark, sf_dir)).drop("what")


@query
def x6_decode_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.regexp_replace("url", "[?#]", "+%20")
    return views.table(spark, sf_dir, "pages").select(
        "page_id",
        project_fields.decode_project(url).alias("decoded"),
        project_fields.decode_project(F.concat("url", F.lit("%zz"))).isNull().alias("malformed_is_null"),
    )


@query
def x7_encode_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = views.known_projects(spark, sf_dir)
    return names.select("name", project_fields.encode_project(F.col("name")).alias("id"))


@query
def x8_alias_organization_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.committers(spark, sf_dir).select("author", "email", F.lit("Kept-As-Is").alias("organization"))
    return contributors.apply_aliases(rows, views.aliases(spark, sf_dir)).groupBy("organization").agg(F.count(F.lit(1)).alias("contributors"))


@query
def x9_sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 to X4 and a time bucket in SQL text."""
    register_sql_functions(spark)
    return spark.sql(
        """SELECT uuid, audit_command(what, access_path, http_method) AS command, audit_command_arguments(what, access_path) AS command_arguments,
             audit_sub_command(what, access_path) AS sub_command, CAST(epoch_ms_bucket('day', time_at_start) AS TIMESTAMP_NTZ) AS day,
             email_organization(concat(session_id, '@', what)) AS organization
           FROM {events}""",
        events=_events(spark, sf_dir),
    )


# --- time ------------------------------------------------------------------------------------


def _event_times(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Column]:
    events = views.table(spark, sf_dir, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    return events.withColumn("ms", F.unix_millis("ts")), F.col("ms")


@query
def t1_time_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, ms = _event_times(spark, sf_dir)
    buckets = {unit: times.time_bucket(ms, unit).cast("timestamp_ntz") for unit in times.BUCKET_UNITS}
    return rows.select("event_id", *[bucket.alias(f"by_{unit}") for unit, bucket in buckets.items()])


@query
def t2_iso_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, ms = _event_times(spark, sf_dir)
    return rows.select("event_id", times.epoch_ms_to_iso(ms).alias("iso"))


@query
def t3_compact_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, ms = _event_times(spark, sf_dir)
    return rows.select("event_id", *[times.epoch_ms_to_stamp(ms, p).alias(f"as_{p.lower()}") for p in times.STAMP_FORMATS])


@query
def t4_text_to_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = _event_times(spark, sf_dir)
    written = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("000"))
    return rows.select(
        "event_id",
        times.text_to_epoch_ms(written).alias("epoch_ms"),
        times.text_to_epoch_ms(written, times.DATE_FORMAT).isNull().alias("without_time_is_null"),
        times.text_to_epoch_ms(F.concat(F.lit("x"), written)).isNull().alias("malformed_is_null"),
    )


@query
def t5_text_to_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = _event_times(spark, sf_dir)
    written = F.date_format("ts", "yyyy-MM-dd")
    return rows.select(
        "event_id",
        times.text_to_date(written).cast("string").alias("day"),
        times.text_to_date(F.concat(written, F.lit(" 10:00:00"))).isNull().alias("malformed_is_null"),
    )


@query
def t6_local_to_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = views.table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", times.local_to_epoch_ms(F.col("o_orderdate")).alias("epoch_ms"))


@query
def t7_epoch_to_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, ms = _event_times(spark, sf_dir)
    seconds = F.call_function("div", ms, F.lit(1000))
    return rows.select(
        "event_id",
        times.epoch_ms_to_timestamp(ms).cast("timestamp_ntz").alias("from_ms"),
        times.epoch_seconds_to_timestamp(seconds).cast("timestamp_ntz").alias("from_seconds"),
    )


@query
def t8_zero_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = _event_times(spark, sf_dir)
    bound = F.when(F.col("event_type") == "error", F.timestamp_seconds(F.lit(0))).otherwise(F.col("ts"))
    return rows.select("event_id", times.bound_or_none(bound).cast("string").alias("bound"))


# --- aggregation -----------------------------------------------------------------------------


@query
def g1_facet_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facets without lookups: row-level columns, then the count."""
    events = audit_events.with_time_bucket(_events(spark, sf_dir), "day")
    columns = (
        events.transform(users.with_user_columns)
        .transform(audit_columns.with_command_columns)
        .transform(audit_columns.with_sub_command)
        .transform(known_projects.with_project, None)
    )
    return _untyped(audit_columns.count_facets(columns), "events_time_bucket")


@query
def g2_commit_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contributors.commit_ids(contributors.flatten_contributors(views.contributor_lines(spark, sf_dir)))


def _register_rollup(aggregate: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with_branches = aggregate in ("email", "email_year")
        stats = commits.contributor_stats_of_changes(views.commit_changes(spark, sf_dir), aggregate, extract_branches=with_branches)
        measures = ["num_files", "num_distinct_files", "added_lines", "deleted_lines", "num_commits", "last_commit_date", "is_merge"]
        branches = [F.array_join("branches", ";").alias("branches")] if with_branches else []
        return stats.select("project", "author", "email", *rollup.GRAINS[aggregate], *measures, *branches)

    run.__name__ = f"g3_rollup_{aggregate}"
    query(run)


for _aggregate in rollup.GRAINS:
    _register_rollup(_aggregate)


@query
def g4_git_traffic_over_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _untyped(reports.git_traffic_over_time(_counts(spark, sf_dir, "day")), "events_time_bucket")


@query
def g4_git_transport_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.git_transport_split(_counts(spark, sf_dir))


@query
def g4_git_command_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.git_command_split(_counts(spark, sf_dir))


@query
def g4_top_receive_pack_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_receive_pack_users(_counts(spark, sf_dir))


@query
def g5_facet_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _untyped(facet_cube.facet_cube(_counts(spark, sf_dir, "day")), "events_time_bucket")


@query
def g6_sketched_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly figures merged from hourly states, beside exact counts: the estimates must be within 2 %."""
    changes = views.commit_changes(spark, sf_dir)
    merged = sketches.estimates(sketches.merged_sketches(sketches.hourly_sketches(changes), "year"))
    since = F.date_trunc("year", times.epoch_ms_to_timestamp(F.col("date")))
    distinct = {"commits": "sha1", "files": "file", "emails": "email"}
    exact_name = {"commits": "num_commits", "files": "num_files_distinct", "emails": "num_emails"}
    exact = changes.groupBy("project", since.alias("since")).agg(*[F.count_distinct(column).alias(exact_name[name]) for name, column in distinct.items()])
    close = [(F.abs(F.col(f"num_{name}_about") - F.col(exact_name[name])) <= 0.02 * F.col(exact_name[name])).alias(f"{name}_close") for name in distinct]
    rows = merged.join(exact, ["project", "since"])
    return _untyped(rows.select("project", "since", *sketches.COUNTERS, *exact_name.values(), *close), "since")


#: A user's pause that ends a session.
SESSION_GAP_MS = 36 * 3_600_000


@query
def g7_user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.user_sessions(_events(spark, sf_dir), SESSION_GAP_MS)


# --- plans -----------------------------------------------------------------------------------


@query
def m1_contributor_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _land_contributors(spark, sf_dir, _pinned_ref())
    stats = commits.contributor_stats(spark, _wanted_projects(spark, sf_dir), root)
    return stats.select(
        "project", "author", "email", "year", "day", "num_files", "last_commit_date", "is_merge", F.size("commits").alias("commits")
    )


@query
def m2_dashboard_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = contributors.flatten_contributors(views.contributor_lines(spark, sf_dir), with_commits=False)
    rows = commits.dashboard_stats(stats, views.aliases(spark, sf_dir))
    return rows.withColumns({"branches": F.array_join("branches", ";"), "hash_tags": F.array_join("hash_tags", ";")})


@query
def m3_project_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole commits job up to its sinks, projects and refs taken from a manifest."""
    root = _land_contributors(spark, sf_dir, F.coalesce(_pinned_ref(), F.lit("main")))
    manifest_path, aliases_path = scratch_dir(spark, "manifest"), scratch_dir(spark, "aliases")
    entries = _wanted_projects(spark, sf_dir).selectExpr(
        """concat('<project name="', name, '"', if(ref_name IS NULL, '', concat(' revision="', ref_name, '"')), '/>') AS entry""",
        "regexp_extract(name, 'nation([0-9]+)/', 1) AS nation"
    )
    opening = '<manifest><default revision="main"/>'
    _write_pages(views.as_documents(entries, F.col("nation"), opening, "", "</manifest>"), manifest_path)
    views.aliases(spark, sf_dir).write.csv(aliases_path, header=True)
    job = commits.CommitsJob(
        landing_root=root, manifest=manifest_path, manifest_label="release-1", manifest_branch="main", email_aliases=aliases_path
    )
    rows = commits.build_project_stats(spark, job)
    return rows.select("project", "author", "email", "organization", "last_commit_date", "manifest_label", "manifest_branch")


@query
def m3_project_stats_of_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same job over raw commit changes of the projects in a listing."""
    changes_path, listing_path = scratch_dir(spark, "changes"), scratch_dir(spark, "listing")
    views.commit_changes(spark, sf_dir).write.parquet(changes_path)
    names = _wanted_projects(spark, sf_dir).selectExpr(
        """concat('"', name, '": {"id": "', id, '"}') AS entry""",
        "CAST(regexp_extract(name, 'nation([0-9]+)/', 1) AS INT) AS nation",
    )
    pages = views.as_documents(names, F.col("nation"), ")]}'\n{", ",", "}")
    _write_pages(pages, listing_path)
    job = commits.CommitsJob(
        changes_path=changes_path, listing_path=listing_path, prefix="nation1",
        aggregate="email_month", since=COMMITS_SINCE, until=COMMITS_UNTIL, extract_branches=True,
    )
    rows = commits.build_project_stats(spark, job)
    return rows.select(
        "project", "email", "organization", "year", "month", "num_files", "num_distinct_files", "num_commits",
        F.array_join("branches", ";").alias("branches"),
    )


def _register_audit(unit: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _untyped(_counts(spark, sf_dir, unit), "events_time_bucket")

    run.__name__ = f"m4_audit_counts_{unit}"
    query(run)


for _unit in ("hour", "week", "quarter"):
    _register_audit(_unit)


@query
def m4_audit_counts_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _untyped(_counts(spark, sf_dir, "hour", since=SINCE, until=UNTIL), "events_time_bucket")


@query
def m4_audit_counts_whole_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _untyped(_counts(spark, sf_dir, "day", since=SINCE, until=UNTIL, whole_last_day=True), "events_time_bucket")


def _staged_audit_job(spark: SparkSession, sf_dir: str, log: str, index: Target) -> audit.AuditJob:
    """The audit job over a log, with server pages and the user list staged."""
    projects, accounts, types = (scratch_dir(spark, label) for label in ("known-projects", "accounts", "user-types"))
    known = views.known_project_entries(spark, sf_dir).select(F.to_json(F.struct("name", "state")).alias("entry"), "s_suppkey")
    _write_pages(views.as_pages(known, F.col("s_suppkey")), projects)
    listed = views.account_entries(spark, sf_dir).select(F.to_json(F.struct("*")).alias("entry"), "_account_id")
    _write_pages(views.as_pages(listed, F.col("_account_id")), accounts)
    _user_types(spark, sf_dir).write.csv(types, header=True)
    return audit.AuditJob(
        events_path=log, index=index, known_projects_path=projects, accounts_path=accounts, additional_user_info_path=types
    )


@query
def m4_audit_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole audit job up to its sink: gzip log, server pages and user list are staged and read."""
    log = scratch_dir(spark, "audit-log")
    views.audit_lines(spark, sf_dir).write.option("compression", "gzip").text(log)
    job = _staged_audit_job(spark, sf_dir, log, Target("unused"))
    return _untyped(audit.build_audit_counts(spark, job), "events_time_bucket")


@query
def m4_audit_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same job on the log as a stream of files; a last line closes the buckets that are open."""
    log, index, checkpoint = (scratch_dir(spark, label) for label in ("live-log", "live-counts", "live-checkpoint"))
    views.audit_lines(spark, sf_dir).repartition(4).write.text(log)
    views.closing_audit_line(spark).write.mode("append").text(log)
    job = _staged_audit_job(spark, sf_dir, log, Target(index, "parquet"))
    # The files are cut at random, so a bucket stays open for as long as all of them span.
    stream = live.AuditStream(job, checkpoint, delay="400 days", max_files=2)
    live.start_audit_stream(spark, stream, available_now=True).awaitTermination()
    return _untyped(live.read_closed_counts(spark, stream), "events_time_bucket")


@query
def m4_audit_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of log that share days, and one of them run again."""
    table = scratch_dir(spark, "audit-table")
    lists = views.accounts(spark, sf_dir), _user_types(spark, sf_dir), views.known_projects(spark, sf_dir)
    of_users = {"even": F.coalesce(F.col("who") % 2 == 0, F.lit(True)), "odd": F.col("who") % 2 == 1}
    for batch in ("even", "odd", "even"):
        counts = audit.aggregate_events(_events(spark, sf_dir).where(of_users[batch]), *lists)
        incremental.merge_counts(counts, table, batch)
    return _untyped(incremental.read_counts(spark, table).drop("day"), "events_time_bucket")
