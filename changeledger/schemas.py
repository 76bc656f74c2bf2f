"""Explicit schemas. Nothing in the package infers one."""

from __future__ import annotations

# One contributor-activity line, as produced per project. `files` inside a commit is not read.
COMMIT = "struct<sha1: string, date: bigint, merge: boolean>"
CONTRIBUTOR_FIELDS = {
    "name": "string",
    "email": "string",
    "year": "int",
    "month": "int",
    "day": "int",
    "hour": "int",
    "num_files": "int",
    "num_distinct_files": "int",
    "added_lines": "int",
    "deleted_lines": "int",
    "num_commits": "int",
    "last_commit_date": "bigint",
    "is_merge": "boolean",
    "commits": f"array<{COMMIT}>",
    "branches": "array<string>",
    "is_bot_like": "boolean",
    "hash_tags": "array<string>",
    "starting_revision": "string",
}

# One file touched by one commit; `date` is in epoch milliseconds, `branches` are all that have the commit.
COMMIT_CHANGE = """
    project string, author string, email string, sha1 string, date bigint, merge boolean,
    file string, added_lines bigint, deleted_lines bigint, branches array<string>
"""

# Superset of the HTTP, extended HTTP and SSH audit records.
AUDIT_LINE = """
    type string,
    event struct<
        session_id: string,
        time_at_start: bigint,
        what: string,
        elapsed: int,
        uuid: struct<uuid: string>,
        who: struct<access_path: string, account_id: struct<id: int>>,
        http_method: string,
        http_status: string,
        result: string>
"""

AUDIT_EVENT_COLUMNS = [
    "access_path",
    "session_id",
    "who",
    "time_at_start",
    "what",
    "elapsed",
    "uuid",
    "http_method",
    "result",
    "audit_type",
]

FACETS = [
    "events_time_bucket",
    "audit_type",
    "user_identifier",
    "user_type",
    "access_path",
    "command",
    "command_arguments",
    "sub_command",
    "project",
    "result",
]

PROJECT = "id string, name string, ref_name string"
PROJECT_LISTING = "map<string, struct<id: string>>"
KNOWN_PROJECT_PAGE = "array<struct<name: string, state: string>>"
ACCOUNT_PAGE = "array<struct<_account_id: int, name: string, email: string, username: string>>"
MANIFEST = """
    default array<struct<_revision: string>>,
    project array<struct<_name: string, _revision: string>>
"""
USER_TYPES = "id int, type string"
