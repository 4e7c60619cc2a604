"""Parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan that has fewer partitions than the cluster has task slots (a table
    held in one row group) before CPU-heavy text work; a table of many splits arrives
    spread already and is left alone. Lazy: nothing runs while a query is built.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < slots else df


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy accessor: ``Tables(spark, dir).orders``."""

    def __init__(self, spark: SparkSession, data_dir: str):
        self.spark = spark
        self.data_dir = data_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = table(self.spark, self.data_dir, name)
        return self._cache[name]

    def spread(self, name: str, *cols: str) -> DataFrame:
        """The named columns of a table, spread out before CPU-heavy text work
        (see :func:`spread`); column pruning happens before any copy."""
        key = f"{name}:{','.join(cols)}"
        if key not in self._cache:
            df = getattr(self, name)
            self._cache[key] = spread(df.select(*cols) if cols else df)
        return self._cache[key]
