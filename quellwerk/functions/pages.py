"""Fields of search and detail pages: expressions on HTML strings, no parser outside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quellwerk.functions.text import html_to_text, strip

# Patterns of case ids in links, and of dates, courts and case numbers in cells.
CASE_IDS = ["/hanrei/(\\d+)/detail", "[?&]id=(\\d+)", "detail(\\d+)"]
JP_DATES = ["^(?:令和|平成|昭和)?\\d{1,4}年\\d{1,2}月\\d{1,2}日", "^\\d{4}/\\d{1,2}/\\d{1,2}"]
JP_COURTS = "裁判所|最高裁|高裁|地裁|簡裁|家裁"
JP_NUMBER = "^(?:令和|平成|昭和)?\\d{1,4}[（(].+[）)]\\d+"
DE_COURT = "(BGH|BVerfG|OLG|LG|AG|BAG|BVerwG|BSG|BFH)\\s+[\\w\\-]+"
DE_DATE = "\\d{2}\\.\\d{2}\\.\\d{4}"
DE_NUMBER = "(?:Az\\.?:?\\s*)?((?:I+V?|VI+|XI+|XI?I?)\\s+Z[RB]\\s+\\d+/\\d+|\\d+\\s+[A-Z]\\s+\\d+/\\d+)"


def case_id(href: Column) -> Column:
    """First of the id patterns that fits, else the link itself."""
    return F.coalesce(*[F.nullif(F.regexp_extract(href, p, 1), F.lit("")) for p in CASE_IDS], href)


def classify_cells(cells: Column) -> Column:
    """SRC18: date, court and case number of a row's cells; patterns in order, the last fitting cell wins."""
    def last(keep) -> Column:
        return F.try_element_at(F.filter(cells, keep), F.lit(-1))

    is_date = lambda c: c.rlike(JP_DATES[0]) | c.rlike(JP_DATES[1])
    is_court = lambda c: ~is_date(c) & c.rlike(JP_COURTS)
    return F.struct(last(is_date).alias("decision_date"), last(is_court).alias("court"), last(lambda c: ~is_date(c) & ~is_court(c) & c.rlike(JP_NUMBER)).alias("case_number"))


def search_rows(pages: DataFrame, base: str) -> DataFrame:
    """SRC18 on pages(html): one row a result: id, full url, title and the classified cells."""
    row = F.explode(F.regexp_extract_all("html", F.lit("(?is)<(tr|li)[^>]*>.*?</\\1>"), F.lit(0))).alias("row")
    x = pages.select(row).withColumn("href", F.regexp_extract("row", "(?is)<a[^>]*href=[\"']([^\"']*)[\"']", 1)).where("href != ''")
    cells = F.filter(F.transform(F.regexp_extract_all("row", F.lit("(?is)<(?:td|span|div)[^>]*>(.*?)</(?:td|span|div)>"), F.lit(1)), lambda c: strip(F.regexp_replace(c, "<[^>]+>", ""))), lambda c: c != "")
    url = F.when(F.col("href").startswith("http"), F.col("href")).when(F.col("href").startswith("/"), F.concat(F.lit(base), "href")).otherwise(F.concat(F.lit(base + "/"), "href"))
    title = strip(F.regexp_replace(F.regexp_extract("row", "(?is)<a[^>]*>(.*?)</a>", 1), "<[^>]+>", ""))
    return x.select(case_id(F.col("href")).alias("case_id"), url.alias("url"), F.when(F.length(title) > 3, title).alias("case_title"), classify_cells(cells).alias("c")).select("case_id", "url", "case_title", "c.*")


def german_result(text: Column) -> Column:
    """SRC17: court, date and file number of a result's text."""
    return F.struct(F.regexp_extract(text, DE_COURT, 0).alias("court"), F.regexp_extract(text, DE_DATE, 0).alias("decision_date"), F.regexp_extract(text, DE_NUMBER, 1).alias("aktenzeichen"))


def definition_list(html: Column) -> Column:
    """SRC19: labels and values of a definition list as entries; a later label overwrites an earlier one.

    The pairs are folded from the end, so the session's policy on double keys doesn't matter.
    """
    keys = F.transform(F.regexp_extract_all(html, F.lit("(?is)<dt[^>]*>(.*?)</dt>"), F.lit(1)), html_to_text)
    values = F.transform(F.regexp_extract_all(html, F.lit("(?is)<dd[^>]*>(.*?)</dd>"), F.lit(1)), html_to_text)
    pairs = F.filter(F.arrays_zip(keys.alias("key"), values.alias("value")), lambda p: p["key"].isNotNull() & p["value"].isNotNull())
    latest = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(latest)


def first_full_text(candidates: list[Column], page: Column) -> Column:
    """SRC16: the first candidate of more than 200 characters, else the longest start of 100 or more, else the page."""
    long = F.coalesce(*[F.when(F.length(c) > 200, c) for c in candidates])
    some = F.coalesce(*[F.when(F.length(c) >= 100, c) for c in candidates])
    return F.coalesce(long, some, page)


def query_parameter(url: Column, name: str) -> Column:
    """SRC15."""
    return F.try_parse_url(url, F.lit("QUERY"), F.lit(name))


def fill_empty(own: Column, other: Column) -> Column:
    """TXT14, TXT15: a field from another place only where it is null or ""."""
    return F.coalesce(F.nullif(own, F.lit("")), other)
