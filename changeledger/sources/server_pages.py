"""Responses of the code-review server landed as files: projects and accounts.

Each file is one response and starts with the five-character prefix that servers send before
JSON. A response is a bounded page, so it is read whole; the pages spread over tasks. Several
pages are read by naming their directory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import drop_response_prefix, drop_trailing_commas
from ..schemas import ACCOUNT_PAGE, KNOWN_PROJECT_PAGE, PROJECT_LISTING
from .whole_files import read_whole_files

# A response that is not the expected JSON fails the load.
STRICT = {"mode": "FAILFAST"}
ACTIVE_STATES = ["ACTIVE", "READ_ONLY"]


def _pages(spark: SparkSession, path: str | list[str], bracket: str) -> DataFrame:
    """Bodies and files of the pages; a body that does not start with the bracket fails the load."""
    body = F.btrim(drop_trailing_commas(drop_response_prefix(F.col("value"))), F.lit(" \t\r\n"))
    page = F.col("_metadata.file_path")
    wrong = F.concat(F.lit(f"malformed response, '{bracket}' expected: "), page)
    checked = F.when(F.startswith(body, F.lit(bracket)), body).otherwise(F.raise_error(wrong).cast("string"))
    return read_whole_files(spark, path).select(checked.alias("body"), page.alias("page"))


def _present(value: Column, what: str) -> Column:
    """The value; a null one fails the load."""
    return F.when(value.isNotNull(), value).otherwise(F.raise_error(F.lit(f"malformed response, {what} without a value")))


def read_project_listing(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A `name -> {id}` listing as projects without a ref."""
    listed = _pages(spark, path, "{").select(F.explode(F.from_json("body", PROJECT_LISTING, STRICT)).alias("name", "entry"))
    return listed.select(_present(F.col("entry.id"), "id").alias("id"), "name", F.lit(None).cast("string").alias("ref_name"))


def read_known_projects(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Distinct project names over all pages.

    Pages normally hold only active and read-only projects; where they state a project's state,
    other ones are left out.
    """
    listed = _pages(spark, path, "[").select(F.inline(F.from_json("body", KNOWN_PROJECT_PAGE, STRICT)))
    wanted = F.col("state").isNull() | F.col("state").isin(*ACTIVE_STATES)
    return listed.where(wanted).select(_present(F.col("name"), "name").alias("name")).distinct()


def page_number(path: Column) -> Column:
    """The number of a page from its path: that of a `page=<n>` folder, else the last in the file's name."""
    folder = F.regexp_extract(path, r"/page=(\d{1,18})/[^/]*$", 1)
    file = F.regexp_extract(path, r"(\d{1,18})[^0-9/]*$", 1)
    return F.coalesce(F.nullif(folder, F.lit("")), F.nullif(file, F.lit(""))).cast("bigint")


def account_identifier(account_id: Column, name: Column, email: Column, username: Column) -> Column:
    """Name, else email, else user name, else the id; an empty name counts as a name."""
    return F.coalesce(name, email, username, account_id.cast("string"))


def read_accounts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One identifier per account; of several entries the last one of the last page counts.

    Pages are in the order of the last number in their file's name, or of the folder's for files
    that Spark wrote; files without a number come first, and paths decide between equal numbers.
    """
    entries = _pages(spark, path, "[").select(
        "page", F.posexplode(F.from_json("body", ACCOUNT_PAGE, STRICT)).alias("position", "account")
    )
    identifier = account_identifier(
        F.col("account._account_id"), F.col("account.name"), F.col("account.email"), F.col("account.username")
    )
    number = F.coalesce(page_number(F.col("page")), F.lit(-1))
    return entries.groupBy(_present(F.col("account._account_id"), "_account_id").alias("account_id")).agg(
        F.max_by(identifier, F.struct(number, "page", "position")).alias("identifier")
    )
