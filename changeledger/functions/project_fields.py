"""Project of an audit event: what the text says outright, and what must be looked up.

A project is either spelled out by the event text (`spelled_out_project`) or is the longest run
of leading / trailing tokens that names a known project. For the latter this module only lists
the runs worth looking up, best first; the lookup itself is a join (operators.known_projects).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .audit_fields import is_rest
from .text import capture

# One capture group each.
SSH_BEFORE_SPACE = r"project:(.+?)\)?\s"
SSH_IN_BRACES = r"project:\{\^?(.*)\}"
SSH_REST_OF_TEXT = r"project(?::|.)(.*)"
PACK_OVER_SSH = r"(?:git-receive-pack|git-upload-pack)\.\/(.+)"
REPLICATION_START = r"replication\.start\.([\.\/a-zA-Z0-9]+(?:-[a-zA-Z0-9\.]+)*)(?:\.|\s|$)"
REST_CHANGE = r"changes\/([^\/]+)~"
REST_PROJECT = r"projects\/([^\/]+)"
PACK_INFO_OVER_HTTP = r"https?:\/\/(.+)\/info\/refs\?service=(?:git-upload-pack|git-receive-pack)"
PACK_OVER_HTTP = r"https?:\/\/(.+)\/(?:git-upload-pack|git-receive-pack)"

# A text containing one of these concerns no project.
WITHOUT_PROJECT = ["LOGIN", "LOGOUT", "AUTH"]


def no_names() -> Column:
    return F.array().cast("array<string>")


def concerns_no_project(what: Column) -> Column:
    found = F.lit(False)
    for word in WITHOUT_PROJECT:
        found = found | what.contains(word)
    return found


def decode_project(encoded: Column) -> Column:
    """URL-decoded project name; null when the percent-encoding is malformed."""
    return F.try_url_decode(encoded)


def encode_project(name: Column) -> Column:
    return F.url_encode(name)


def spelled_out_project(what: Column, access_path: Column) -> Column:
    """Project that needs no check against the known ones, or null."""
    ssh = F.coalesce(
        capture(what, SSH_BEFORE_SPACE),
        capture(what, SSH_IN_BRACES, may_be_empty=True),
        capture(what, PACK_OVER_SSH),
        capture(what, REPLICATION_START),
    )
    rest = decode_project(F.coalesce(capture(what, REST_CHANGE), capture(what, REST_PROJECT)))
    return F.when(concerns_no_project(what), F.lit(None)).when(access_path == "SSH_COMMAND", ssh).when(
        is_rest(access_path), rest
    )


def leading_runs(text: Column, separator: str, longest: Column) -> Column:
    """Runs of leading tokens, longest first, at most `longest` tokens.

    `longest` is the token count of the longest known project, so nothing that could match is
    left out, and the work per text stays linear however many separators it holds.
    """
    return _runs(text, separator, longest, leading=True)


def trailing_runs(text: Column, separator: str, longest: Column) -> Column:
    """Runs of trailing tokens, longest first, at most `longest` tokens."""
    return _runs(text, separator, longest, leading=False)


def _runs(text: Column, separator: str, longest: Column, leading: bool) -> Column:
    # Empty tokens at the end of the text do not count.
    trimmed = F.rtrim(text, F.lit(separator))
    separators = F.length(trimmed) - F.length(F.replace(trimmed, F.lit(separator), F.lit("")))

    def run(size: Column) -> Column:
        return F.call_function("substring_index", trimmed, F.lit(separator), size if leading else -size)

    sizes = F.sequence(F.least(longest, separators + 1), F.lit(1), F.lit(-1))
    return F.when(trimmed.isNotNull() & (longest > 0), F.transform(sizes, run)).otherwise(no_names())


def projects_to_look_up(
    what: Column, access_path: Column, longest_dotted: Column, longest_slashed: Column
) -> Column:
    """Names to try against the known projects, best first; empty when none is needed."""
    ssh = F.concat(
        leading_runs(capture(what, SSH_REST_OF_TEXT), ".", longest_dotted),
        leading_runs(what, ".", longest_dotted),
        trailing_runs(what, ".", longest_dotted),
    )
    git_target = F.coalesce(
        capture(what, PACK_INFO_OVER_HTTP), capture(what, PACK_OVER_SSH), capture(what, PACK_OVER_HTTP)
    )
    return (
        F.when(concerns_no_project(what), no_names())
        .when(access_path == "SSH_COMMAND", F.array_distinct(ssh))
        .when(access_path == "GIT", trailing_runs(git_target, "/", longest_slashed))
        .otherwise(no_names())
    )
