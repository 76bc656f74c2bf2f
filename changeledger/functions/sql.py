"""The extraction functions for use in SQL text."""

from __future__ import annotations

from pyspark.sql import SparkSession

from . import audit_fields, organization, times


def _captured(column: str, pattern: str, may_be_empty: bool = False) -> str:
    """Group 1 of the first match, or null; see `text.capture`."""
    group = f"regexp_extract({column}, r'{pattern}', 1)"
    return f"CASE WHEN {column} RLIKE r'{pattern}' THEN {group} END" if may_be_empty else f"nullif({group}, '')"


_LAST_MS = times.LAST_SECOND * 1000 + 999
_REST = "access_path IN ('REST_API', 'UNKNOWN')"

#: Name and parameters -> body. The patterns are those of the column functions.
SQL_FUNCTIONS = {
    "email_organization(email STRING)": f"""CASE
        WHEN lower(email) RLIKE r'{organization.DOMAIN_WITHOUT_EXTENSION}' THEN regexp_extract(lower(email), r'{organization.DOMAIN_WITHOUT_EXTENSION}', 2)
        WHEN lower(email) RLIKE r'{organization.DOMAIN_WITH_EXTENSION}' THEN regexp_extract(lower(email), r'{organization.DOMAIN_WITH_EXTENSION}', 2)
        ELSE '' END""",
    "audit_command(what STRING, access_path STRING, http_method STRING)": f"""CASE
        WHEN access_path = 'SSH_COMMAND' THEN coalesce({_captured("what", audit_fields.SSH_COMMAND)}, what)
        WHEN access_path = 'GIT' THEN coalesce({_captured("what", audit_fields.GIT_COMMAND)}, what)
        WHEN {_REST} THEN coalesce(http_method, what)
        WHEN access_path IS NULL AND what = 'AUTH' THEN '{audit_fields.FAILED_SSH_AUTH}'
        ELSE what END""",
    "audit_command_arguments(what STRING, access_path STRING)": f"""CASE
        WHEN access_path = 'SSH_COMMAND' THEN {_captured("what", audit_fields.SSH_ARGUMENTS)}
        WHEN access_path = 'GIT' THEN coalesce({_captured("what", audit_fields.GIT_OVER_SSH_ARGUMENTS)}, {_captured("what", audit_fields.GIT_OVER_HTTP_ARGUMENTS)})
        WHEN {_REST} THEN what END""",
    "audit_sub_command(what STRING, access_path STRING)": f"""CASE
        WHEN access_path = 'SSH_COMMAND' THEN coalesce({_captured("what", audit_fields.SSH_SUB_COMMAND, True)}, what)
        WHEN {_REST} THEN coalesce({_captured("what", audit_fields.REST_SUB_COMMAND, True)}, what) END""",
    "epoch_ms_bucket(unit STRING, ms BIGINT)": f"""CASE
        WHEN ms BETWEEN {times.FIRST_SECOND * 1000} AND {_LAST_MS} THEN date_trunc(unit, timestamp_seconds(ms div 1000)) END""",
}

_RESULTS = {"epoch_ms_bucket": "TIMESTAMP"}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create the functions for this session and name them.

    Their bodies are SQL, so a query that calls them is planned like one that spells them out.
    """
    for signature, body in SQL_FUNCTIONS.items():
        result = _RESULTS.get(signature.split("(")[0], "STRING")
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {result} RETURN {body}")
    return [signature.split("(")[0] for signature in SQL_FUNCTIONS]
