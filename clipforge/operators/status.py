"""Per-article decision and run counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipforge.functions import constants as C


def article_status(df: DataFrame, resolved_col: str, duplicate_col: str,
                   malformed_col: str | None = None) -> DataFrame:
    """``error`` for malformed rows, else no resolved person -> ``no_persons``,
    published duplicate -> ``duplicate``, else ``ok``.

    (A duplicate needs a shared resolved person, so with none resolved the
    duplicate test is always false and the reference's order reduces to this.)
    """
    st = (F.when(F.size(F.coalesce(F.col(resolved_col), F.array())) == 0, F.lit("no_persons"))
          .when(F.col(duplicate_col), F.lit("duplicate"))
          .otherwise(F.lit("ok")))
    if malformed_col:
        st = F.when(F.col(malformed_col), F.lit("error")).otherwise(st)
    return df.withColumn("status", st)


def status_counts(df: DataFrame, status_col: str = "status", statuses=C.RUN_STATUSES) -> DataFrame:
    """Count per status; every listed status appears, with 0 when absent."""
    spark = df.sparkSession
    names = spark.createDataFrame([(s, i) for i, s in enumerate(statuses)], "status string, ord int")
    counts = df.groupBy(F.col(status_col).alias("status")).agg(F.count(F.lit(1)).alias("n"))
    return (names.join(counts, "status", "left")
            .select("status", F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def outcome_counts(df: DataFrame, code_col: str) -> DataFrame:
    """Upload outcomes: HTTP 200/201 is a success, anything else a failure."""
    ok = F.col(code_col).isin(200, 201)
    return df.agg(F.count_if(ok).cast("long").alias("success"),
                  F.count_if(~ok | F.col(code_col).isNull()).cast("long").alias("fail"))
