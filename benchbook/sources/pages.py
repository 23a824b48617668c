"""Page texts: assembling documents and finding pages that look scanned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchbook.functions import fixed_values as V
from benchbook.functions.normalize import clean_text
from benchbook.functions.regex import strip


def assemble_pages(pages: DataFrame) -> DataFrame:
    """``key, page_no, page_text`` to one cleaned ``full_text`` per key.

    This is the one step that moves text: pages are shuffled by key once, and everything keyed
    by document afterwards can use that partitioning. A page that could not be read (NULL)
    makes the whole document unreadable (NULL), which the load records as an error. Where a column
    ``recognised`` holds, the text is taken as recognition gave it, with its outer blanks.
    """
    text = strip(F.col("page_text"))
    if "recognised" in pages.columns:
        text = F.when(F.col("recognised"), F.col("page_text")).otherwise(text)
    page = F.struct("page_no", text.alias("text"))
    grouped = pages.groupBy("key").agg(
        F.array_sort(F.collect_list(page)).alias("pages"),
        F.bool_or(F.col("page_text").isNull()).alias("unreadable"),
    )
    raw = F.array_join(F.transform("pages", lambda p: p["text"]), "\n")
    return grouped.select("key", clean_text(F.when(~F.col("unreadable"), raw)).alias("full_text"))


def scanned_pages(pages: DataFrame) -> DataFrame:
    """Pages with too little text to be a text page: candidates for recognition elsewhere."""
    length = F.length(strip(F.col("page_text")))
    return pages.filter(length < V.SCANNED_PAGE_CHARS).select(
        "key", "page_no", length.alias("n_chars")
    )


def _is_scanned(text: str) -> Column:
    """A page without readable text: too little of it, or none."""
    return F.coalesce(F.length(strip(F.col(text))), F.lit(0)) < V.SCANNED_PAGE_CHARS


def newest_recognised(recognised: DataFrame) -> DataFrame:
    """One row per page of what was ever recognised: the newest, of equal times the largest load
    name, then text. Pages whose recognition failed (NULL) are left out."""
    made = recognised.filter(F.col("page_text").isNotNull())
    newest = F.max(F.struct("recognised_at", "batch_id", "page_text"))["page_text"]
    return made.groupBy("key", "page_no").agg(newest.alias("page_text"))


def keys_to_read_again(pages: DataFrame, recognised: DataFrame) -> DataFrame:
    """Keys with a scanned page that a text was recognised for; other pages stay as they were."""
    scanned = pages.filter(_is_scanned("page_text")).select("key", "page_no")
    new = recognised.filter(F.col("page_text").isNotNull()).select("key", "page_no")
    return scanned.join(new, ["key", "page_no"], "left_semi").select("key").distinct()


def with_recognised(pages: DataFrame, recognised: DataFrame) -> DataFrame:
    """``key, page_no, page_text, recognised``: scanned pages with their newest recognised text."""
    newest = newest_recognised(recognised).withColumnRenamed("page_text", "_found")
    both = pages.join(newest, ["key", "page_no"], "left")
    taken = _is_scanned("page_text") & F.col("_found").isNotNull()
    return both.select(
        "key", "page_no", F.when(taken, F.col("_found")).otherwise(F.col("page_text")).alias("page_text"),
        taken.alias("recognised"),
    )


def scanned_share(pages: DataFrame) -> DataFrame:
    """Per key: pages, scanned pages and their share."""
    scanned = F.length(strip(F.col("page_text"))) < V.SCANNED_PAGE_CHARS
    return pages.groupBy("key").agg(
        F.count("*").alias("pages"),
        F.count_if(scanned).alias("scanned_pages"),
        (F.count_if(scanned) / F.count("*")).alias("scanned_share"),
    )
