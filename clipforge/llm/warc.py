"""WARC archives: writing, and reading back with boundary-chain verification.

Writing is a text sink whose rows are whole records (Spark ends each row with the
newline that a record ends with). Pages whose payload another page also has are
written as revisits of the one with the smallest id.

Reading splits the files at the record magic, so a file of any size is read by many
tasks. A magic may also stand inside a payload: every split is a candidate record
whose header gives the offset of its successor, and only records reached from the
start of the file are real. The chain is followed by pointer jumping: the jumps
double each round, so a file of n candidates takes log2(n) rounds of joins on small
(file, offset, successor) rows. Payloads stay where they are read; only records that
a magic had split are put together again, from the splits that make them up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clipforge.llm.common import broadcast_if_small, stored

MAGIC = "WARC/1.0\r\n"
RECORDS_PER_FILE = 4096
#: Bytes of a file whose candidates one task orders.
STRETCH = 1 << 26
DATE = "2024-01-01T00:00:00Z"

_HEX = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of a SHA-1: five hexadecimal digits make four base32 digits."""
    h = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(h, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), _HEX, _BASE32)


def _urn(page_id: Column) -> Column:
    """A record id that holds the page's id in its first 16 hexadecimal digits."""
    h = F.lpad(F.lower(F.hex(page_id)), 16, "0")
    return F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-"), F.substring(h, 13, 4), F.lit("-8000-000000000000>"))


def _page_of(urn: Column) -> Column:
    return F.conv(F.regexp_replace(F.substring(urn, 11, 18), "-", ""), 16, -10).cast("long")


def records(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0) -> DataFrame:
    """(page_id, record): the whole record of each page but its last newline.

    Of pages with equal payloads of at least ``least_bytes`` bytes, the smallest id is a
    response and the others are revisits. A page without an id can't be referred to: it is
    a response, with record id zero and the header ``X-No-Id``. Rows that repeat an id and a
    payload: all but one of them are revisits of that id."""
    p = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("url"),
                     F.coalesce(F.col(html), F.lit("")).alias("payload"))
    p = p.withColumn("digest", base32_sha1(F.col("payload"))).withColumn("n", F.octet_length("payload").cast("long"))
    shared = (p.where(F.col("page_id").isNotNull() & (F.col("n") >= least_bytes)).groupBy("digest", "n")
              .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("pages")).where("pages > 1"))
    shared = stored(shared.select(F.col("digest").alias("_d"), F.col("n").alias("_n"), "first"), "shared_payloads")
    p = p.join(broadcast_if_small(shared, 64), (F.col("digest") == F.col("_d")) & (F.col("n") == F.col("_n")), "left")
    # Of several rows with the first id itself, one is the response.
    p = p.withColumn("rank", F.when(F.col("page_id") == F.col("first"), F.monotonically_increasing_id()))
    return p


def _framed(p: DataFrame) -> DataFrame:
    revisit = F.col("first").isNotNull() & F.col("page_id").isNotNull() & ~F.col("is_first")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    uri = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    head = F.concat(
        F.lit(MAGIC + "WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), _urn(F.coalesce("page_id", F.lit(0).cast("long"))),
        F.when(F.col("page_id").isNull(), F.lit("\r\nX-No-Id: 1")).otherwise(""),
        F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), uri,
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "), _urn(F.col("first")))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"))
    return p.select(F.concat(head, block, F.lit("\r\n\r")).alias("value"))


def write(pages: DataFrame, path: str, least_bytes: int = 0, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write ``pages`` (page_id, url, html) as .warc text files under ``path``."""
    p = records(pages, least_bytes=least_bytes)
    firsts = p.where(F.col("page_id") == F.col("first")).groupBy("digest", "n").agg(F.count(F.lit(1)).alias("same")).where("same > 1")
    if firsts.isEmpty():
        p = p.withColumn("is_first", F.coalesce(F.col("page_id") == F.col("first"), F.lit(True)))
    else:  # the first id itself repeats with its payload: number the rows once, on disk
        p = stored(p, "numbered_pages")
        one = p.where("rank is not null").groupBy("digest", "n").agg(F.min("rank").alias("one")).withColumnsRenamed({"digest": "_d2", "n": "_n2"})
        p = p.join(one, (F.col("digest") == F.col("_d2")) & (F.col("n") == F.col("_n2")), "left")
        p = p.withColumn("is_first", F.coalesce(F.col("rank") == F.col("one"), F.lit(False)) | F.col("first").isNull())
    _framed(p).write.option("maxRecordsPerFile", records_per_file).text(path)


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, seq, value): the text between magics, in the order of each split."""
    return (spark.read.option("lineSep", MAGIC).text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("seq"), "value"))


def _header(head: Column, name: str) -> Column:
    found = F.regexp_extract(head, rf"(?i)(?:^|\r\n){name}:\s*([^\r\n]*)", 1)
    return F.when(found != "", found)


def candidates(s: DataFrame) -> DataFrame:
    """One row per split at the magic, without payloads: its order in the file, header fields,
    and for records that one split holds whole, size and digest of their payload."""
    cut = F.instr("value", "\r\n\r\n")
    head = F.substring_index("value", "\r\n\r\n", 1)
    s = s.withColumn("size", F.octet_length("value").cast("long")).withColumn("head", F.when(cut > 0, head))
    s = s.withColumn("length", _header(F.col("head"), "Content-Length").cast("long"))
    s = s.withColumn("head_size", (F.octet_length("head") + 4).cast("long"))
    body = _block("value")
    whole = F.col("length").isNotNull() & (F.col("size") >= F.col("head_size") + F.col("length"))
    s = s.withColumn("body", F.when(whole, body))
    return s.select("file", "block", "seq", "size", "head", "length", "head_size", *_payload(F.col("body")))


def _with_offsets(s: DataFrame) -> DataFrame:
    """``off``, the place of the magic before each split: splits cover a file without gaps, so
    it is the size of all blocks before (a row per block) plus that of what precedes in its own."""
    in_block = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    blocks = s.groupBy("file", "block").agg(F.sum(F.col("size") + len(MAGIC)).alias("bytes"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("bytes").over(earlier), F.lit(0))).drop("bytes")
    within = F.coalesce(F.sum(F.col("size") + len(MAGIC)).over(in_block), F.lit(0))
    return (s.withColumn("within", within).join(blocks, ["file", "block"])
            .withColumn("off", F.col("before") + F.col("within") - len(MAGIC)).drop("before", "within"))


def _block(value: str) -> Column:
    """The bytes of a record's block."""
    return F.substring(F.col(value).cast("binary"), (F.col("head_size") + 1).cast("int"), F.col("length").cast("int"))


def _payload(body: Column) -> list[Column]:
    """Size and digest of the HTTP payload of a record's block."""
    text = body.cast("string")
    http = F.octet_length(F.substring_index(text, "\r\n\r\n", 1)) + 4
    html = F.substring(body, http + 1, F.greatest(F.octet_length(body) - http, F.lit(0)))
    return [F.octet_length(html).cast("long").alias("html_size"), base32_sha1(html).alias("html_digest"),
            F.regexp_extract(text, r"(?i)\r\nContent-Length:\s*(\d+)", 1).alias("http_length")]


def read(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record in the
    archives under ``path``. Records that are not on the chain from their file's start
    (text inside payloads) are no records. A revisit's size is that of the payload it refers to,
    from its stored HTTP header."""
    segments = _segments(spark, path)  # read twice, but listed and so numbered once
    c = _with_offsets(stored(candidates(segments), "warc_candidates")).where("off >= 0")
    c = c.withColumn("next", F.col("off") + len(MAGIC) + F.col("head_size") + F.col("length") + 4).drop("block", "seq")
    c = stored(c, "warc_chain")
    real = reachable(c.select("file", "off", "next"))
    chain = stored(c.join(real, ["file", "off"], "left_semi"), "warc_records")
    whole = chain.where("html_size is not null").select("head", "html_size", "html_digest", "http_length")
    split = chain.where("html_size is null and length is not null")
    if not split.isEmpty():
        whole = whole.unionByName(_joined(segments, c, split))
    head = F.col("head")
    revisit = _header(head, "WARC-Type") == "revisit"
    return whole.select(
        F.when(_header(head, "X-No-Id").isNull(), _page_of(_header(head, "WARC-Record-ID"))).alias("page_id"),
        F.when(revisit, F.col("http_length").cast("long")).otherwise(F.col("html_size")).alias("payload_bytes"),
        F.when(revisit, F.substring_index(_header(head, "WARC-Payload-Digest"), ":", -1)).otherwise(F.col("html_digest")).alias("payload_digest"),
        _header(head, "WARC-Type").alias("record_type"),
        F.when(revisit, _page_of(_header(head, "WARC-Refers-To"))).alias("refers_to"))


def reachable(edges: DataFrame) -> DataFrame:
    """(file, off) of the candidates on the chain from offset 0 of their file.

    Round k adds what is 2^k jumps from a record found so far and doubles every jump; a
    successor that is no candidate ends a chain. Ends when a round finds nothing."""
    jump = stored(edges.where("next > off").select("file", "off", "next"), "jumps")
    found = stored(edges.where("off = 0").select("file", "off"), "found")
    n = found.count()
    while True:
        step = found.join(jump, ["file", "off"]).select("file", F.col("next").alias("off"))
        step = step.join(edges.select("file", "off"), ["file", "off"], "left_semi")
        found = stored(found.unionByName(step).distinct(), "found")
        now = found.count()
        if now == n:
            return found
        n = now
        ahead = jump.select("file", F.col("off").alias("next"), F.col("next").alias("far"))
        jump = stored(jump.join(ahead, ["file", "next"]).select("file", "off", F.col("far").alias("next")), "jumps")


def owners(places: DataFrame, split: DataFrame) -> DataFrame:
    """(file, off, owner) of the places that lie in a split record (file, off, next).

    Real records don't overlap, so it is the last split record that begins at or before a
    place, if it reaches that far. Places meet it by a running maximum in their stretch of the
    file and, where the record begins in an earlier stretch, by one row per stretch."""
    mark = F.when(F.col("next").isNotNull(), F.struct(F.col("off").alias("owner"), F.col("next").alias("until")))
    begun = split.select("file", "off", "next")
    at = (places.select("file", "off").join(begun, ["file", "off"], "left")
          .select("file", "off", F.expr(f"off div {STRETCH}").alias("stretch"), mark.alias("mark")))
    so_far = Window.partitionBy("file", "stretch").orderBy("off").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("file").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    last = at.groupBy("file", "stretch").agg(F.max("mark").alias("last"))
    last = last.select("file", "stretch", F.max("last").over(earlier).alias("before"))
    of = at.withColumn("own", F.max("mark").over(so_far)).join(last, ["file", "stretch"])
    of = of.select("file", "off", F.coalesce("own", "before").alias("of"))
    return of.where(F.col("off") < F.col("of.until")).select("file", "off", F.col("of.owner").alias("owner"))


def _joined(s: DataFrame, c: DataFrame, split: DataFrame) -> DataFrame:
    """The records that a magic inside their payload had split, put together again."""
    parts = owners(c, split)
    places = _with_offsets(s.select("file", "block", "seq", F.octet_length("value").cast("long").alias("size")))
    wanted = places.join(parts, ["file", "off"]).select("file", "block", "seq", "off", "owner")
    text = (s.join(wanted, ["file", "block", "seq"]).groupBy("file", "owner")
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("off", "value"))), lambda x: x["value"]), MAGIC).alias("value")))
    text = text.join(split.select("file", F.col("off").alias("owner"), "head", "length", "head_size"), ["file", "owner"])
    return text.withColumn("body", _block("value")).select("head", *_payload(F.col("body")))
