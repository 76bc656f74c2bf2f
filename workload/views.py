"""Code-review data derived from the supplied tables by Spark.

The tables hold no audit log, accounts or commits, so these are derived row by row: every event
becomes an audit record, every customer an account, every supplier a project, every line item a
file change. oracle.py states the same derivations in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeledger.sources.server_pages import account_identifier

HOST = "https://code.invalid/"
PAGE_SIZE = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(part) if isinstance(part, str) else part.cast("string") for part in parts])


RECORD_TYPE = """
    CASE WHEN kind IN (0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 16, 18) THEN 'SshAuditEvent'
         WHEN kind IN (9, 11, 14, 15) THEN 'HttpAuditEvent'
         WHEN kind = 19 THEN 'LegacyAuditEvent'
         ELSE 'ExtendedHttpAuditEvent' END"""

ACCESS_PATH = """
    CASE WHEN kind <= 8 OR kind >= 18 THEN 'SSH_COMMAND' WHEN kind <= 11 THEN 'GIT'
         WHEN kind <= 13 THEN 'REST_API' WHEN kind = 14 THEN 'UNKNOWN' WHEN kind = 15 THEN 'JSON_RPC'
         WHEN kind = 17 THEN 'PLUGIN' END"""

WHAT = f"""
    CASE kind
      WHEN 0 THEN concat('shop.find.-v.(project:', p, ') color:blue size:2')
      WHEN 1 THEN concat('shop.find.project:{{^', p, '}}.-n.5')
      WHEN 2 THEN concat('git-receive-pack./', p)
      WHEN 3 THEN concat('replication.start.', p, '.--url.x')
      WHEN 4 THEN concat('shop.find.-v.project:', p, '.plugins.io.ripe:yes')
      WHEN 5 THEN concat('shop.index.project.', p)
      WHEN 6 THEN concat(p, '.shop.-f...')
      WHEN 7 THEN concat('shop.ls.-a.', p)
      WHEN 8 THEN CASE event_type WHEN 'signup' THEN 'LOGIN' WHEN 'error' THEN 'LOGOUT' ELSE 'shop.version' END
      WHEN 9 THEN concat('{HOST}', p, '/info/refs?service=git-upload-pack')
      WHEN 10 THEN concat('git-upload-pack./', p)
      WHEN 11 THEN concat('{HOST}', p, '/git-receive-pack')
      WHEN 12 THEN concat('/changes/', url_encode(p), '~', event_id, '/revisions/5/actions')
      WHEN 13 THEN concat('/a/projects/', url_encode(p), '+x%20y/branches')
      WHEN 14 THEN concat('/config/server/', event_type)
      WHEN 15 THEN concat('ProjectAdminService.', event_type)
      WHEN 16 THEN 'AUTH'
      WHEN 17 THEN concat('/plugins/', event_type)
      ELSE concat('shop.find.project:', p) END"""


def audit_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relational form of the audit log; twenty kinds of record, by event id."""
    return (
        table(spark, sf_dir, "events")
        .selectExpr(
            "*",
            "CAST(event_id % 20 AS INT) AS kind",
            "concat('nation', user_id % 25, '/supplier-', user_id) AS p",
            "CASE WHEN event_type = 'error' THEN array('FAIL', '500') ELSE array('0', '200') END AS results",
        )
        .selectExpr("*", f"{RECORD_TYPE} AS type")
        .selectExpr(
            "kind",
            "type",
            f"{ACCESS_PATH} AS access_path",
            "CASE WHEN event_id % 10 <> 0 AND kind <> 16 THEN CAST(user_id AS INT) END AS who",
            "unix_millis(CAST(ts AS TIMESTAMP)) AS time_at_start",
            f"{WHAT} AS what",
            "CAST(floor(value) AS INT) AS elapsed",
            "concat('audit:', event_id) AS uuid",
            "concat('s', user_id) AS session_id",
            "CASE WHEN type <> 'SshAuditEvent' THEN if(event_type = 'purchase', 'POST', 'GET') END AS http_method",
            "if(type = 'SshAuditEvent', results[0], results[1]) AS result",
        )
    )


def audit_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as JSON lines; records of kind 18 are not JSON."""
    event = """named_struct(
        'http_method', http_method,
        'http_status', CASE WHEN type <> 'SshAuditEvent' THEN CAST(result AS INT) END,
        'session_id', session_id,
        'who', CASE WHEN kind <> 16 THEN named_struct(
            'access_path', access_path, 'account_id', CASE WHEN who IS NOT NULL THEN named_struct('id', who) END) END,
        'when', time_at_start,
        'what', what,
        'time_at_start', time_at_start,
        'elapsed', elapsed,
        'uuid', named_struct('uuid', uuid),
        'result', CASE WHEN type = 'SshAuditEvent' THEN result END)"""
    line = f"to_json(named_struct('type', type, 'event', {event}))"
    return audit_records(spark, sf_dir).selectExpr(f"concat(if(kind = 18, '#', ''), {line}) AS value")


def closing_audit_line(spark: SparkSession) -> DataFrame:
    """A line of the year 2100, later than any event by more than a stream waits."""
    event = '''{"type":"SshAuditEvent","event":{"session_id":"end","time_at_start":4102444800000,"what":"LOGOUT",'''
    rest = '''"elapsed":0,"uuid":{"uuid":"end"},"result":"0"}}'''
    return spark.range(1).select(F.lit(event + rest).alias("value"))


def known_project_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(`name`, `state`) per supplier: the project itself, and a plugins project where in credit."""
    base = _text("nation", F.col("s_suppkey") % 25, "/supplier-", F.col("s_suppkey"))
    plugins = F.when(F.col("s_acctbal") >= 0, _text(base, ".plugins.io"))
    state = F.when(F.col("s_acctbal") >= 0, "ACTIVE").otherwise("READ_ONLY")
    return (
        table(spark, sf_dir, "supplier")
        .select("s_suppkey", F.explode(F.array(base, plugins)).alias("name"), state.alias("state"))
        .where(F.col("name").isNotNull())
    )


def known_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return known_project_entries(spark, sf_dir).select("name")


def account_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An account per customer; which names it has depends on the market segment."""
    segment, key = F.col("c_mktsegment"), F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.cast("int").alias("_account_id"),
        F.when(segment.isin("AUTOMOBILE", "HOUSEHOLD"), F.col("c_name")).alias("name"),
        F.when(segment.isin("BUILDING", "HOUSEHOLD"), _text("user", key, "@example.org")).alias("email"),
        F.when(segment.isin("BUILDING", "FURNITURE"), _text("u", key)).alias("username"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    identifier = account_identifier(F.col("_account_id"), F.col("name"), F.col("email"), F.col("username"))
    return account_entries(spark, sf_dir).select(F.col("_account_id").alias("account_id"), identifier.alias("identifier"))


def freeze_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(`window`, `opens`, `closes`) per supplier, from a day to over a year; every seventh has no end."""
    key = F.col("s_suppkey")
    opens = F.lit(694_224_000_000) + (key * 37 % 2500) * 86_400_000
    closes = F.when(key % 7 != 0, opens + (key % 400) * 86_400_000)
    return table(spark, sf_dir, "supplier").select(key.alias("window"), opens.alias("opens"), closes.alias("closes"))


def project_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(`name`, `parent`): suppliers as a tree of three children each, pairs of every 40 a cycle; the first is a root."""
    key = F.col("s_suppkey")
    parent = F.when(key % 40 == 10, key + 1).when(key % 40 == 11, key - 1).otherwise(F.floor(key / 3))
    return table(spark, sf_dir, "supplier").select(_text("p", key).alias("name"), F.when(key > 2, _text("p", parent)).alias("parent"))


def tagged_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").where("s_suppkey % 5 = 2").select(_text("p", F.col("s_suppkey")).alias("name"))


def user_type_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed users: machinery customers are bots, furniture ones human, building ones unstated."""
    segment = F.col("c_mktsegment")
    kind = F.when(segment == "MACHINERY", "bot").when(segment == "FURNITURE", "human")
    return (
        table(spark, sf_dir, "customer")
        .where(segment.isin("MACHINERY", "FURNITURE", "BUILDING"))
        .select(F.col("c_custkey").cast("int").alias("id"), kind.alias("type"))
    )


def user_type_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(`id`, `valid_from`, `type`): listed users are bots or unstated from a day of January, machinery ones human a week later."""
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    start = F.lit(1_704_067_200_000) + (key % 20) * 86_400_000
    first = F.struct(start.alias("valid_from"), F.when(segment != "BUILDING", "bot").alias("type"))
    second = F.struct((start + 7 * 86_400_000).alias("valid_from"), F.lit("human").alias("type"))
    listed = table(spark, sf_dir, "customer").where(segment.isin("MACHINERY", "FURNITURE", "BUILDING"))
    entries = F.explode(F.when(segment == "MACHINERY", F.array(first, second)).otherwise(F.array(first)))
    return listed.select(key.cast("int").alias("id"), entries.alias("entry")).select("id", "entry.*")


def alias_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aliases that hold from a day between 1992 and 1997 on; those of machinery are withdrawn 500 days later."""
    start = F.lit(694_224_000_000) + (F.col("c_custkey") % 2000) * 86_400_000
    listed = committers(spark, sf_dir).where(F.col("c_mktsegment").isin("MACHINERY", "FURNITURE"))
    first = F.struct(start.alias("valid_from"), _text("Alias ", F.col("author")).alias("author"), _text("AcMe-", F.col("project")).alias("organization"))
    none = F.lit(None).cast("string")
    second = F.struct((start + 500 * 86_400_000).alias("valid_from"), none.alias("author"), none.alias("organization"))
    entries = F.when(F.col("c_mktsegment") == "MACHINERY", F.array(first, second)).otherwise(F.array(first))
    return listed.select("email", F.explode(entries).alias("entry")).select("email", "entry.*")


def committers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(`c_custkey`, `project`, `author`, `email`) per customer, over many shapes of domain."""
    key = F.col("c_custkey")
    domains = [
        "@simple", "@mail.com", "@Mail.Co.UK", "@dev.company.info", "@foo.museum", "@foo.company",
        "@sub.domain.example.org", "@x@y.io", "@1.2.3.4", " at nowhere",
    ]
    domain = F.get(F.array(*[F.lit(d) for d in domains]), (key % len(domains)).cast("int"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        _text("nation", F.col("c_nationkey"), "/", F.lower("c_mktsegment")).alias("project"),
        F.col("c_name").alias("author"),
        _text("user", key, domain).alias("email"),
        F.col("c_mktsegment"),
    )


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aliases of three segments: with an organisation, an empty one, and none."""
    segment = F.col("c_mktsegment")
    return (
        committers(spark, sf_dir)
        .where(segment.isin("MACHINERY", "FURNITURE", "BUILDING"))
        .select(
            F.when(segment == "MACHINERY", _text("Alias ", F.col("author")))
            .when(segment == "FURNITURE", F.lit(""))
            .alias("author"),
            "email",
            F.when(segment == "MACHINERY", _text("AcMe-", F.col("project")))
            .when(segment == "FURNITURE", F.lit(""))
            .alias("organization"),
        )
    )


def _commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.md5(F.col("o_orderkey").cast("string").cast("binary")).alias("sha1"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("date"),
        (F.col("o_orderstatus") == "F").alias("merge"),
        F.lower("o_orderpriority").alias("branch"),
        "o_totalprice",
        F.col("o_orderdate").cast("timestamp").alias("committed"),
    )


def commit_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per file touched by a commit: orders are commits, line items file changes."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_linenumber")
    changed = _commits(spark, sf_dir).join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    return changed.join(committers(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey")).select(
        "project",
        "author",
        "email",
        "sha1",
        "date",
        "merge",
        _text("src/file-", F.col("l_partkey")).alias("file"),
        F.col("l_quantity").cast("bigint").alias("added_lines"),
        F.col("l_linenumber").cast("bigint").alias("deleted_lines"),
        F.when(F.col("merge"), F.array("branch", F.lit("release"))).otherwise(F.array("branch")).alias("branches"),
    )


def contributor_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(`project`, `json`) activity lines, one per order; the time parts depend on its status."""
    commits = _commits(spark, sf_dir).join(committers(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
    status_open = ~F.col("merge")
    year, month = F.year("committed"), F.month("committed")
    line = F.struct(
        F.col("author").alias("name"),
        "email",
        year.alias("year"),
        month.alias("month"),
        F.when(status_open, F.dayofmonth("committed")).alias("day"),
        F.when(status_open, F.hour("committed")).alias("hour"),
        F.lit(1).alias("num_commits"),
        (F.col("o_orderkey") % 7 + 1).cast("int").alias("num_files"),
        (F.col("o_orderkey") % 3 + 1).cast("int").alias("num_distinct_files"),
        F.floor("o_totalprice").cast("int").alias("added_lines"),
        (F.col("o_orderkey") % 11).cast("int").alias("deleted_lines"),
        F.array(
            F.struct("sha1", "date", "merge", F.array(_text("src/file-", F.col("o_orderkey"))).alias("files"))
        ).alias("commits"),
        F.when(status_open, F.array("branch", F.lit("master"))).alias("branches"),
        F.col("date").alias("last_commit_date"),
        F.col("merge").alias("is_merge"),
        (F.col("c_mktsegment") == "MACHINERY").alias("is_bot_like"),
        F.when(F.col("merge"), F.array(F.lower("c_mktsegment"))).alias("hash_tags"),
        F.lit("HEAD").alias("starting_revision"),
        F.lit("ignored").alias("unknown_field"),
    )
    # Text after the closing brace is not part of the line's JSON.
    tail = F.when(F.col("merge"), F.lit(', "branches":[]')).otherwise(F.lit(""))
    return commits.select("project", F.concat(F.to_json(line), tail).alias("json"))


def as_documents(entries: DataFrame, page: Column, opening: str, separator: str, closing: str) -> DataFrame:
    """(`value`, `page`): entries gathered into one document per page. Pages must be bounded."""
    gathered = F.concat(F.lit(opening), F.array_join(F.collect_list("entry"), separator), F.lit(closing))
    return entries.select("entry", page.alias("page")).groupBy("page").agg(gathered.alias("value")).select("value", "page")


def as_pages(entries: DataFrame, key: Column, opening: str = "[", closing: str = "]") -> DataFrame:
    """Server responses of at most PAGE_SIZE numbered entries, with the prefix servers send."""
    return as_documents(entries, F.floor(key / PAGE_SIZE), ")]}'\n" + opening, ",", closing)
