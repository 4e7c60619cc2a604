"""Line dedup by site-relative frequency.

For each host (site), the pages that contain a line are divided by the host's
page total; lines over the boilerplate ratio are dropped from that host's pages. On a
host of few pages the share must be over the ratio by more than chance: ``SIGNIFICANCE``
standard deviations of the pages that a line of exactly that ratio would be on. On large
hosts the ratio alone decides.

Lines are counted by their 64-bit hash after a per-page distinct, so the shuffle
carries (host, hash, count) rows that were summed on the map side: a host or a
line that holds a third of all rows is reduced before it moves. The dropped
lines of a host are bounded: lines over ratio r number at most (average distinct
lines of its pages) / r, so they travel as one array per host, and pages are
cleaned inside their own row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipforge.llm.common import broadcast_if_small, stored, unused

#: Share of a host's pages above which a line is boilerplate.
RATIO = 0.02
#: Standard deviations by which the number of a line's pages must pass the ratio's.
SIGNIFICANCE = 2.58

HAS_WORD = r"[^\x20\x09-\x0D]"


def boilerplate(pages: DataFrame, host: str = "source", text: str = "text",
                ratio: float = RATIO, significance: float = SIGNIFICANCE) -> DataFrame:
    """(host, line_hash, n_pages, total) of the lines over the ratio.

    A line is the exact text between newlines; lines without a word are never
    counted, pages with a null host belong to no site, and what stands on one page only is no
    boilerplate, however small the host. Null text is a page
    without lines, which still counts in its host's total."""
    p = pages.select(F.col(host).alias("_host"), F.col(text).alias("_text")).where("_host is not null")
    lines = F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(HAS_WORD))
    # explode_outer: for the plain form the optimiser splits every text twice, to test for lines
    counts = (p.select("_host", F.explode_outer(F.array_distinct(F.transform(lines, lambda x: F.xxhash64(x)))).alias("line_hash"))
              .where("line_hash is not null").groupBy("_host", "line_hash").agg(F.count(F.lit(1)).alias("n_pages"))
              .where("n_pages > 1"))
    totals = p.groupBy("_host").agg(F.count(F.lit(1)).alias("total"))
    over = F.col("n_pages") - F.lit(ratio) * F.col("total")
    return counts.join(totals, "_host").where((over > 0) & (over * over > F.lit(significance ** 2 * ratio * (1 - ratio)) * F.col("total")))


def drop_boilerplate(pages: DataFrame, host: str = "source", text: str = "text",
                     ratio: float = RATIO, significance: float = SIGNIFICANCE) -> DataFrame:
    """``pages`` with the boilerplate lines of its host taken out of ``text``, and
    columns ``n_lines`` and ``n_dropped`` (long). Other columns pass through; a
    column of the input named like a new one is replaced.

    Null text stays null (0 lines). A page of boilerplate only keeps its row with an
    empty text. Repeated rows count as pages of their own."""
    found = stored(boilerplate(pages, host, text, ratio, significance), "boilerplate")
    names = [c for c in pages.columns if c not in ("n_lines", "n_dropped")]
    own_host, drop, kept_lines = unused(pages, "_host", "_drop", "_kept")
    by_host = found.groupBy("_host").agg(F.collect_list("line_hash").alias(drop)).withColumnRenamed("_host", own_host)
    widest = found.groupBy("_host").count().agg(F.max("count")).first()[0] or 0
    side = broadcast_if_small(by_host, 64 + 8 * widest)
    lines = F.split(F.col(text), "\n", -1)
    kept = F.when(F.col(drop).isNull(), lines).otherwise(
        F.filter(lines, lambda x: ~(x.rlike(HAS_WORD) & F.array_contains(drop, F.xxhash64(x)))))
    out = pages.select(*names).join(side, F.col(host) == F.col(own_host), "left").withColumn(kept_lines, kept)
    n = F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long")
    n_kept = F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.size(kept_lines)).cast("long")
    cleaned = F.when(F.col(text).isNotNull(), F.concat_ws("\n", kept_lines)).alias(text)
    return out.select(*[cleaned if c == text else F.col(c) for c in names],
                      n.alias("n_lines"), (n - n_kept).alias("n_dropped"))
