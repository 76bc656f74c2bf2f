"""Boilerplate lines by how large a share of a site's pages has them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeledger.operators.broadcasting import broadcast_if_small

from .batches import stored, with_row

#: A line on more than this share of a site's pages is boilerplate.
MAX_RATIO = 0.05
#: One page repeats nothing; from two pages on the ratio alone decides.
MIN_PAGES = 2


def host_of(url: Column) -> Column:
    """The host of a URL in lower case; null if it has none."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.lower(F.nullif(host, F.lit("")))


def _line_key(line: Column) -> Column:
    """Sixteen bytes that stand for a line without its surrounding blanks."""
    return F.unhex(F.md5(F.trim(line)))


def _one_page_per_text(pages: DataFrame) -> DataFrame:
    """(site, keys) with one row for all pages of a site whose non-blank lines are the same."""
    same = F.unhex(F.md5(F.array_join(F.transform("_lines", _line_key), "")))
    return pages.groupBy("_site", same.alias("_same")).agg(F.first("_keys").alias("_keys")).select("_site", "_keys")


def boilerplate_lines(pages: DataFrame, site_column: str, text_column: str, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, distinct_texts: bool = False) -> DataFrame:
    """(site, line keys) of the lines that exceed the ratio, one row per site that has any.

    A page counts once for a line, however often it has it. With `distinct_texts` copies of one page
    count as one page, for the line and for the site: else enough copies make boilerplate of all
    their lines. A site has at most its mean number of
    lines per page, divided by the ratio, of such lines, so the array of one site stays short. Lines
    are hashed before the shuffle and counted map-side, so a site with most of the pages is spread
    over the keys of its lines. Lines and pages are counted in one reading; counts of lines on
    `min_pages` pages or more are kept in the shared folder.
    """
    lines = F.filter(F.split(F.col(text_column), "\n"), lambda line: F.trim(line) != "")
    keys = F.array_distinct(F.transform(lines, _line_key)).alias("_keys")
    site = F.col(site_column).alias("_site")
    counting = _one_page_per_text(pages.select(site, lines.alias("_lines"), keys)) if distinct_texts else pages.select(site, keys)
    every_page = F.lit(b"")  # no line has this key: it counts the pages of the site
    listed = F.explode(F.concat(F.coalesce("_keys", F.array().cast("array<binary>")), F.array(every_page)))
    counted = counting.select("_site", listed.alias("_key")).groupBy("_site", "_key").agg(F.count("*").alias("_pages"))
    counted = stored(counted.filter((F.col("_pages") >= min_pages) | (F.col("_key") == every_page)), "line-counts")
    totals = counted.filter(F.col("_key") == every_page).select(F.col("_site").alias("_of"), F.col("_pages").alias("_total"))
    frequent = counted.filter((F.col("_key") != every_page) & (F.col("_pages") >= min_pages)).join(totals, F.col("_site").eqNullSafe(F.col("_of")))
    above = frequent.filter(F.col("_pages") > F.lit(max_ratio) * F.col("_total"))
    return above.groupBy("_site").agg(F.collect_set("_key").alias("_keys"))


def drop_boilerplate(pages: DataFrame, site_column: str = "source", text_column: str = "text", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, distinct_texts: bool = False) -> DataFrame:
    """Remove the boilerplate lines of each page's own site; adds `n_lines` and `n_dropped`.

    Every page stays, with what is left of its text: an empty text if all lines went. Blank lines
    are never dropped. A null text stays null with 0 lines; pages without a site are one site of
    their own. With `distinct_texts` a line counts once for all copies of a page. Columns already named
    `n_lines` or `n_dropped` are replaced.
    """
    site_keys = broadcast_if_small(boilerplate_lines(pages, site_column, text_column, max_ratio, min_pages, distinct_texts))
    lines = F.split("text", "\n")
    joined = with_row(pages, site=F.col(site_column), text=F.col(text_column)).join(site_keys, F.col("site").eqNullSafe(F.col("_site")), "left")
    kept = F.when(F.col("_keys").isNull(), lines).otherwise(F.filter(lines, lambda line: ~F.array_contains("_keys", _line_key(line)) | (F.trim(line) == "")))
    arrays = joined.select("row", "text", lines.alias("lines"), kept.alias("kept"))
    count = F.when(F.col("text").isNull(), 0).otherwise(F.size("lines")).cast("bigint")
    left = F.when(F.col("text").isNull(), 0).otherwise(F.size("kept")).cast("bigint")
    columns = [F.array_join("kept", "\n").alias(c) if c == text_column else F.col(f"row.`{c}`") for c in pages.columns if c not in ("n_lines", "n_dropped")]
    return arrays.select(*columns, count.alias("n_lines"), (count - left).alias("n_dropped"))
