"""Incremental mail intake with Structured Streaming.

New ``*.eml`` files under a folder become article rows: file source ->
block extraction (``mapInPandas``, same code as the batch path) -> cleaning -> repeats on
(title, URL) dropped by the stream's own state -> per micro-batch: title block list ->
one parquet folder per micro-batch, written idempotently by batch id so a retried batch
overwrites its own output.

The state holds a 128-bit key per article ever seen and nothing else. A batch looks its
own keys up, so its cost follows the batch, not the history; what earlier batches wrote is
never read. The state is versioned with the stream's checkpoint, so a retried batch meets
the state that its first attempt met. It is kept in RocksDB unless the session names
another provider: on the executors' disks, with changes in the checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipforge.functions import constants as C
from clipforge.functions.text import clean_text, clean_title, parse_dutch_datetime
from clipforge.operators.blocklists import drop_blocked_sources, drop_blocked_titles
from clipforge.operators.lookups import faculty_code
from clipforge.sources.mail import extract_blocks

BINARY_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def mail_stream(spark: SparkSession, folder: str, glob: str = "*.eml", max_files: int | None = None) -> DataFrame:
    r = (spark.readStream.format("binaryFile").schema(BINARY_SCHEMA)
         .option("pathGlobFilter", glob).option("recursiveFileLookup", True))
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(folder)


def articles_from_blocks(blocks: DataFrame) -> DataFrame:
    """Article rows from extracted blocks (batch or stream): cleaned title, URL
    capped, harvest time parsed (rows without one dropped), source defaulted,
    faculty code from the file name."""
    return (blocks
            .select(F.col("path"), F.col("block_no"), clean_title("title").alias("title"),
                    F.substring(F.coalesce("url", F.lit("")), 1, C.URL_MAX_CHARS).alias("url"),
                    parse_dutch_datetime("date_text").alias("ts"),
                    F.coalesce(clean_text("source"), F.lit("Unknown")).alias("source"),
                    faculty_code("path").alias("faculty"),
                    "labelled_text", "block_text", "highlighted")
            .where(F.col("title").isNotNull() & F.col("ts").isNotNull()))


STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def first_seen(articles: DataFrame) -> DataFrame:
    """The first row of each (title, URL) that the stream ever brings; a null is a value."""
    mark = F.concat_ws("\n", *[F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-")) for c in ("title", "url")])
    return articles.withColumn("_key", F.unhex(F.md5(mark))).dropDuplicates(["_key"]).drop("_key")


def start_intake(spark: SparkSession, folder: str, out_path: str, checkpoint_path: str,
                 blocked_sources: DataFrame | None = None, blocked_words: DataFrame | None = None,
                 available_now: bool = True):
    """Start the stream; returns the ``StreamingQuery``."""
    if spark.conf.get(STATE_PROVIDER, None) in (None, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"):
        spark.conf.set(STATE_PROVIDER, ROCKSDB)
    arts = articles_from_blocks(extract_blocks(mail_stream(spark, folder)))
    if blocked_sources is not None:
        arts = drop_blocked_sources(arts, blocked_sources)
    arts = first_seen(arts)
    out = out_path.rstrip("/")

    def write_batch(df: DataFrame, batch_id: int) -> None:
        if blocked_words is not None:  # by title alone, so repeats may be dropped before
            keyed = df.withColumn("_row", F.concat_ws("#", "path", F.col("block_no").cast("string")))
            df = drop_blocked_titles(keyed, blocked_words, title_col="title", key_col="_row").drop("_row")
        df.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    w = arts.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_path)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
