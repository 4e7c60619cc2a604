"""Block lists and keep-first dedup over the documents table.

Stand-in: an article is a document, its title the first line of the text, its
source ``documents.source``. Blocked sources: ``src1`` and ``src3``. Blocked
title words: every word of eight or more letters in the ``benchmark`` texts.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from clipforge.operators.blocklists import drop_blocked_sources, drop_blocked_titles
from clipforge.operators.duplicates import item_by_id, keep_first
from clipforge.plans.registry import register
from clipforge.sources.tables import Tables

BLOCKED_SOURCES = ["src1", "src3"]


def first_line(c):
    return F.substring_index(F.col(c), "\n", 1)


def _docs(spark, data_dir):
    d = Tables(spark, data_dir).spread("documents", "doc_id", "source", "text")
    return d.select("doc_id", "source", first_line("text").alias("title"))


@register("source_blocklist", sql=r"""
SELECT doc_id, source FROM documents
WHERE source NOT IN (SELECT * FROM (VALUES ('src1'), ('src3')) v(s))
""")
def q_source_blocklist(spark, data_dir):
    docs = Tables(spark, data_dir).documents.select("doc_id", "source")
    blocked = spark.createDataFrame([(s,) for s in BLOCKED_SOURCES], "source string")
    return drop_blocked_sources(docs, blocked)


@register("title_blocklist", sql=r"""
WITH d AS (SELECT doc_id, split_part(text, chr(10), 1) AS title FROM documents),
w AS (SELECT DISTINCT unnest(regexp_extract_all(text, '\p{L}{8,}')) AS word FROM benchmark)
SELECT doc_id, title FROM d WHERE NOT EXISTS (SELECT 1 FROM w WHERE contains(d.title, w.word))
""")
def q_title_blocklist(spark, data_dir):
    t = Tables(spark, data_dir)
    docs = _docs(spark, data_dir).select("doc_id", "title")
    words = t.benchmark.select(F.explode(F.regexp_extract_all("text", F.lit(r"\p{L}{8,}"), 0)).alias("word"))
    return drop_blocked_titles(docs, words, title_col="title", key_col="doc_id")


@register("dedup_first", sql=r"""
SELECT min(doc_id) AS doc_id, source, split_part(text, chr(10), 1) AS title
FROM documents GROUP BY 2, 3
""")
def q_dedup_first(spark, data_dir):
    return keep_first(_docs(spark, data_dir), key_cols=["title", "source"], order_col="doc_id")


@register("item_by_id", sql="""
SELECT doc_id, source, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
""")
def q_item_by_id(spark, data_dir):
    t = Tables(spark, data_dir)
    return item_by_id(t.documents.select("doc_id", "source", "n_chars"), t.labels, "doc_id")
