"""Row positions without funnelling a group (or the whole table) into one task.

``row_number() OVER (PARTITION BY g ORDER BY o)`` sends every row of a group to
one task, and without PARTITION BY the whole table goes to one task. Here rows
are range-partitioned on (group, order) instead, so a hot group is spread over
many tasks; each task numbers its rows locally, and a small table of
per-(task, group) counts -- at most one row per task boundary plus one per group
-- gives each task its starting offset.

The numbered rows are read twice (for the counts and for the final join), and
both reads must see the same partitions: a second range exchange would sample
its own bounds. So the locally numbered rows are checkpointed (reliably, to
the session's checkpoint folder), which also cuts the lineage against executor
loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipforge.session import ensure_checkpoint_dir


def positions(df: DataFrame, order_cols: list, group_cols: list | None = None,
              out_col: str = "pos", num_partitions: int | None = None) -> DataFrame:
    """Add a 1-based position within each group (or over all rows).

    ``order_cols`` must make the order total within a group (end with a unique
    key); ties would otherwise be numbered in arbitrary order.
    """
    group_cols = list(group_cols or [])
    keys = group_cols + list(order_cols)
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    local = (ranged
             .withColumn("_pid", F.spark_partition_id())
             .withColumn("_li", F.monotonically_increasing_id()
                         - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    ensure_checkpoint_dir(df.sparkSession)
    local = local.checkpoint(eager=True)
    stats = local.groupBy("_pid", *group_cols).agg(F.min("_li").alias("_first"),
                                                   F.count(F.lit(1)).alias("_n"))
    w = (Window.partitionBy(*group_cols) if group_cols else Window.partitionBy(F.lit(0))) \
        .orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    offs = stats.select(F.col("_pid").alias("_opid"), *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group_cols)], "_first", "_off")
    same = F.col("_pid") == F.col("_opid")
    for i, c in enumerate(group_cols):  # a null group is a group like any other
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    joined = local.join(offs, same, "inner")
    return (joined.withColumn(out_col, F.col("_li") - F.col("_first") + F.col("_off") + 1)
            .drop("_pid", "_li", "_opid", "_first", "_off", *[f"_g{i}" for i in range(len(group_cols))]))
