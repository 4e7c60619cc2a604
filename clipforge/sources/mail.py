"""News-alert mails (``*.eml``) and web pages -> rows.

The scan is Spark's ``binaryFile`` source (recursive, glob-filtered); MIME and
HTML are parsed inside ``mapInArrow`` and ``mapInPandas`` tasks with the standard library, one
output row per article block, so the work is spread over the file partitions.
"""

from __future__ import annotations

from email import policy
from email.parser import BytesParser
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipforge.functions import constants as C
from clipforge.functions.text import col_
from clipforge.sources import html_doc

BLOCK_SCHEMA = ("path string, block_no int, title string, url string, date_text string, source string, "
                "block_text string, labelled_text array<string>, highlighted array<string>, error string")
PAGE_TEXT_SCHEMA = "page_id long, text string"


def read_mails(spark: SparkSession, folder: str, glob: str = "*.eml") -> DataFrame:
    """(path, content) of every mail file below ``folder``."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", glob).load(folder).select("path", "content"))


#: Mails in a file of a mailbox folder: a task reads whole files.
MAILS_PER_FILE = 500
_ENVELOPE = "From "


def write_mailboxes(mails: DataFrame, folder: str, path="path", content="content") -> None:
    """(path, content text) as files of up to ``MAILS_PER_FILE`` mails in the mbox form: before
    each mail a line ``From <path> <date>`` (the path without spaces), lines of a mail that
    begin so are quoted with ``>``. Files per mail would cost more than what is in them."""
    line = F.concat(F.lit(_ENVELOPE), col_(path), F.lit(" Thu Jan  1 00:00:00 1970\n"))
    quoted = F.regexp_replace(col_(content), rf"(?md)^(>*{_ENVELOPE})", ">$1")
    rows = mails.where(col_(path).isNotNull() & col_(content).isNotNull()).select(F.concat(line, quoted, F.lit("\n")).alias("value"))
    rows.write.option("maxRecordsPerFile", MAILS_PER_FILE).text(folder)


def split_mailboxes(mails: DataFrame) -> DataFrame:
    """(path, content) of files -> one row per mail. The mails of an mbox file get the path
    ``<file>#<path of the envelope line>``; a file without such a line is one mail, as it is."""
    text = F.decode("content", "ISO-8859-1")  # one character per byte, whatever the mails' charsets
    parts = mails.select("path", text.alias("_text")).withColumn("_parts", F.split("_text", rf"(?md)^{_ENVELOPE}"))
    box = (F.size("_parts") > 1) & (F.col("_parts")[0] == "")
    one = parts.select("path", box.alias("_box"), F.explode(F.when(box, F.slice("_parts", 2, F.size("_parts"))).otherwise(F.array("_text"))).alias("_mail"))
    mail = F.col("_mail")
    body = F.substring(mail, F.instr(mail, F.lit("\n")) + F.lit(1), F.length(mail))
    body = F.when(F.col("_box"), F.regexp_replace(body, rf"(?md)^>(>*{_ENVELOPE})", "$1")).otherwise(mail)
    path = F.when(F.col("_box"), F.concat("path", F.lit("#"), F.regexp_extract(mail, r"^(\S*)", 1))).otherwise(F.col("path"))
    return one.select(path.alias("path"), F.encode(body, "ISO-8859-1").alias("content"))


#: A part's headers are looked up many times, each time parsed anew; parsed headers do not change.
_POLICY = policy.default.clone(header_factory=lru_cache(maxsize=256)(policy.default.header_factory))


def html_of_mail(raw: bytes) -> str | None:
    """Content of the first ``text/html`` part, or None."""
    msg = BytesParser(policy=_POLICY).parsebytes(raw)
    for part in msg.walk():
        if part.get_content_type() == "text/html":
            return part.get_content()
    return None


def _blocks_of(html: str) -> list[dict]:
    return html_doc.article_blocks(
        html, block_class=C.ARTICLE_BLOCK_CLASS, headline_class=C.HEADLINE_CLASS,
        date_class=C.HARVEST_DATE_CLASS, source_class=C.SOURCE_NAME_CLASS,
        persons_label=C.PERSONS_LABEL, highlight_pattern=C.HIGHLIGHT_STYLE_PATTERN)


#: Documents parsed before their rows are handed on.
PARSED_AT_ONCE = 64
_BLOCK_ROWS = pa.schema([(c, {"int": pa.int32(), "string": pa.string()}.get(t, pa.list_(pa.string())))
                         for c, t in (f.split() for f in BLOCK_SCHEMA.split(", "))])


def _in_pieces(batches, rows_of):
    """The rows of a few documents at a time: a worker never holds the rows of a whole batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, PARSED_AT_ONCE):
            yield pa.RecordBatch.from_pylist([r for doc in batch.slice(at, PARSED_AT_ONCE).to_pylist() for r in rows_of(**doc)],
                                             schema=_BLOCK_ROWS)


def _rows_of_mail(path, content) -> list[dict]:
    try:
        html = html_of_mail(content)
    except (LookupError, ValueError, AttributeError) as e:  # unknown charset, broken part
        return [{"path": path, "block_no": -1, "error": f"{type(e).__name__}: {e}"}]
    return [] if html is None else [{"path": path, **b} for b in _blocks_of(html)]  # no HTML part: no rows


def _rows_of_html(path, html) -> list[dict]:
    return [{"path": path, **b} for b in _blocks_of(html or "")]


def extract_blocks(mails: DataFrame) -> DataFrame:
    """Mail files -> one row per article block that has a headline. A mail that cannot be
    read gives one row with ``error`` and no title; the others are not affected."""
    return mails.select("path", "content").mapInArrow(lambda batches: _in_pieces(batches, _rows_of_mail), BLOCK_SCHEMA)


def extract_blocks_from_html(df: DataFrame, path_col: str, html_col: str) -> DataFrame:
    """Same as :func:`extract_blocks` for HTML already held in a column."""
    return df.select(F.col(path_col).alias("path"), F.col(html_col).alias("html")).mapInArrow(
        lambda batches: _in_pieces(batches, _rows_of_html), BLOCK_SCHEMA)


def _page_texts(batches):
    for pdf in batches:
        yield pd.DataFrame({"page_id": pdf["page_id"].astype("int64"),
                            "text": [html_doc.visible_text(h or "") for h in pdf["html"]]})


def page_visible_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Visible text of each page (all entities decoded), newline separated."""
    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).alias("html")) \
        .mapInPandas(_page_texts, PAGE_TEXT_SCHEMA)
