import pytest
from pyspark.sql import functions as F

from changeledger.functions import audit_fields

FETCH = "https://code.invalid/kitchen/oven.git/git-upload-pack"
PUSH_REFS = "https://code.invalid/kitchen/info/refs?service=git-receive-pack"
BOTH = "http://code.invalid/git-upload-pack/git-receive-pack"
QUERY = "/plugins/menu/dishes"

# By rule: what, access_path, http_method -> command, arguments, sub-command
CASES = [
    # A session mark has neither arguments nor a method.
    ("LOGIN", "SSH_COMMAND", None, "LOGIN", None, "LOGIN"),
    ("LOGOUT", "SSH_COMMAND", None, "LOGOUT", None, "LOGOUT"),
    ("LOGOUT", "GIT", None, "LOGOUT", None, None),
    ("AUTH", None, None, "FAILED_SSH_AUTH", None, None),
    # Over SSH the first dot ends the command, the next one or a blank the sub-command.
    ("cook.soup.-t.9.with-salt", "SSH_COMMAND", None, "cook", "soup.-t.9.with-salt", "soup"),
    ("cook.all Dishes.*", "SSH_COMMAND", None, "cook", "all Dishes.*", "all"),
    ("cook.taste", "SSH_COMMAND", None, "cook", "taste", "taste"),
    ("cook.", "SSH_COMMAND", None, "cook", None, ""),
    ("cook..taste", "SSH_COMMAND", None, "cook", ".taste", ""),
    # One character is consumed before that first dot.
    (".secret.taste", "SSH_COMMAND", None, ".secret", "taste", "secret"),
    # Git over SSH names the command first; over HTTP the last command in the URL counts.
    ("git-receive-pack./kitchen/oven.d", "GIT", None, "git-receive-pack", "/kitchen/oven.d", None),
    ("git-upload-pack./sink", "GIT", None, "git-upload-pack", "/sink", None),
    (FETCH, "GIT", "POST", "git-upload-pack", FETCH, None),
    (PUSH_REFS, "GIT", "GET", "git-receive-pack", PUSH_REFS, None),
    (BOTH, "GIT", "GET", "git-receive-pack", BOTH, None),
    # A REST call is named by its method, else by its path; an optional /a/ is no sub-command.
    (QUERY, "REST_API", "DELETE", "DELETE", QUERY, "plugins"),
    (QUERY, "UNKNOWN", "HEAD", "HEAD", QUERY, "plugins"),
    (QUERY, "REST_API", None, QUERY, QUERY, "plugins"),
    ("/a/plugins/menu", "REST_API", "GET", "GET", "/a/plugins/menu", "plugins"),
    ("/", "REST_API", "GET", "GET", "/", ""),
    ("menu", "REST_API", "GET", "GET", "menu", "menu"),
    # Other ways in have only a command, and the names of the ways are exact.
    ("Cook.serve", "JSON_RPC", "POST", "Cook.serve", None, None),
    ("Cook.serve", None, None, "Cook.serve", None, None),
    ("Cook.serve", "elsewhere", "GET", "Cook.serve", None, None),
    ("cook.soup", "ssh_command", None, "cook.soup", None, None),
]


@pytest.fixture(scope="module")
def extracted(spark):
    schema = "n int, what string, access_path string, http_method string"
    df = spark.createDataFrame([(n, *case[:3]) for n, case in enumerate(CASES)], schema)
    what, path, method = F.col("what"), F.col("access_path"), F.col("http_method")
    columns = df.select(
        "n",
        audit_fields.command(what, path, method),
        audit_fields.command_arguments(what, path),
        audit_fields.sub_command(what, path),
    )
    return {row[0]: row[1:] for row in columns.collect()}


@pytest.mark.parametrize("n", range(len(CASES)), ids=[f"{c[1]}-{c[0]}" for c in CASES])
def test_command_columns(extracted, n):
    assert extracted[n] == CASES[n][3:]
