"""Spark session helpers.

Cluster settings (shuffle partitions, checkpoint folder, memory) belong to the
cluster; the builder here only fills in what is unset, which is what tests and
local benchmarks need.
"""

from __future__ import annotations

import os
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Runtime-checked broadcast: AQE turns a join into a broadcast only when the
    # materialised side is measured below this size.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "clipforge", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a scratch one only when the
    session names none (local tests); on a cluster ``spark.checkpoint.dir`` is set."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="clipforge-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint directory for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the tables written meanwhile go when each is written, not when the driver's
    garbage collector finds them: what follows reads the tables."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder and read back: cuts
    the lineage, is computed once however often it is read, and survives lost executors."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class RunMetrics:
    """Rows and seconds of the phases of a run. The rows are counted while a phase is written
    (``DataFrame.observe``), so they cost no job of their own."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.phases: list[tuple[int, str, int, float]] = []

    def written(self, df: DataFrame, phase: str) -> DataFrame:
        """:func:`written`, with an entry for the phase."""
        seen, start = Observation(phase), time.monotonic()
        out = written(df.observe(seen, F.count(F.lit(1)).alias("rows")), phase)
        self.phases.append((len(self.phases) + 1, phase, seen.get["rows"], time.monotonic() - start))
        return out

    def table(self) -> DataFrame:
        """(step, phase, rows, seconds) of the phases so far."""
        return self.spark.createDataFrame(self.phases, "step int, phase string, rows long, seconds double")
