"""Command, arguments and sub-command of an audit event."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import capture, capture_or_else

FAILED_SSH_AUTH = "FAILED_SSH_AUTH"

# One capture group each.
SSH_COMMAND = r"^(.+?)\."
GIT_COMMAND = r".*(git-upload-pack|git-receive-pack)"
SSH_ARGUMENTS = r"^.+?\.(.+)"
GIT_OVER_SSH_ARGUMENTS = r"git-(?:upload|receive)-pack\.(.+)"
GIT_OVER_HTTP_ARGUMENTS = r"(^http.*)"
SSH_SUB_COMMAND = r"^.*?\.(.*?)(?:\.|\s|$)"
REST_SUB_COMMAND = r"^\/(?:a\/)?(.*?)(?:\/|\s|$)"


def is_rest(access_path: Column) -> Column:
    return access_path.isin("REST_API", "UNKNOWN")


def command(what: Column, access_path: Column, http_method: Column) -> Column:
    return (
        F.when(access_path == "SSH_COMMAND", capture_or_else(what, SSH_COMMAND, what))
        .when(access_path == "GIT", capture_or_else(what, GIT_COMMAND, what))
        .when(is_rest(access_path), F.coalesce(http_method, what))
        .when(access_path.isNull() & (what == "AUTH"), F.lit(FAILED_SSH_AUTH))
        .otherwise(what)
    )


def command_arguments(what: Column, access_path: Column) -> Column:
    return (
        F.when(access_path == "SSH_COMMAND", capture(what, SSH_ARGUMENTS))
        .when(
            access_path == "GIT",
            F.coalesce(capture(what, GIT_OVER_SSH_ARGUMENTS), capture(what, GIT_OVER_HTTP_ARGUMENTS)),
        )
        .when(is_rest(access_path), what)
    )


def sub_command(what: Column, access_path: Column) -> Column:
    return F.when(
        access_path == "SSH_COMMAND", capture_or_else(what, SSH_SUB_COMMAND, what, may_be_empty=True)
    ).when(is_rest(access_path), capture_or_else(what, REST_SUB_COMMAND, what, may_be_empty=True))
