"""Listing-page frontier: the page URLs a paged source is crawled through."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Paging modes of the sources: 1-based page numbers, 0-based, an item offset
# of page_size per page, and 2..n when page 1 is the landing page.
MODES = ("one_based", "zero_based", "offset", "from_two")


def frontier(n_pages: DataFrame, url_prefix: str, page_size: int) -> DataFrame:
    """(source, mode, page_no, url) for every page of every source.

    ``n_pages`` has one row per source with its page count ``n`` and its paging
    ``mode``; ``url_prefix`` may contain ``{source}``. One generator per row, no
    join; a source of an unknown mode gives no pages."""
    n = F.col("n").cast("long")
    seqs = {
        "one_based": F.sequence(F.lit(1).cast("long"), n),
        "zero_based": F.sequence(F.lit(0).cast("long"), n - 1),
        "offset": F.sequence(F.lit(0).cast("long"), (n - 1) * page_size, F.lit(page_size).cast("long")),
        "from_two": F.when(n >= 2, F.sequence(F.lit(2).cast("long"), n)).otherwise(F.array().cast("array<long>")),
    }
    pages = F.coalesce(*[F.when(F.col("mode") == m, seqs[m]) for m in MODES])
    rows = n_pages.select("source", "mode", F.explode(pages).alias("page_no"))
    prefix = F.replace(F.lit(url_prefix), F.lit("{source}"), F.col("source"))
    key = F.when(F.col("mode") == "offset", F.lit("start=")).otherwise(F.lit("page="))
    return rows.withColumn("url", F.concat(prefix, key, F.col("page_no").cast("string")))
