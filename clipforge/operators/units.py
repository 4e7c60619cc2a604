"""Persons export -> faculty members -> chunked proximity query texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipforge.functions import constants as C
from clipforge.functions.text import unit_faculties
from clipforge.operators.ordering import positions


def unit_members(export: DataFrame, unit_col: str = "org_unit", name_col: str = "name_variant",
                 pos_col: str = "row_pos") -> DataFrame:
    """One row per (faculty part of the unit path, name); rows without either are dropped."""
    return (export
            .select(F.explode(unit_faculties(unit_col)).alias("faculty"),
                    F.col(name_col).alias("name_variant"), F.col(pos_col).alias("row_pos"))
            .where(F.col("faculty").isNotNull() & F.col("name_variant").isNotNull()))


def org_phrase(name_en: str = C.INSTITUTION_NAME_ENGLISH, name_nl: str = C.INSTITUTION_NAME_DUTCH) -> str:
    return f'("{name_en.title()}" OR "{name_nl.title()}")'


def numbered_names(members: DataFrame, limit: int = C.NAMES_PER_QUERY) -> DataFrame:
    """Distinct (faculty, name_variant) with ``pos`` (from 1) in first-appearance order and the ``chunk``
    of ``limit`` names it falls in.

    Distinct names: a hash aggregate (map-side combined). Positions: range
    partitioned, so a faculty holding most names is still spread over tasks.
    """
    firsts = members.groupBy("faculty", "name_variant").agg(F.min("row_pos").alias("first_pos"))
    numbered = positions(firsts, order_cols=["first_pos", "name_variant"], group_cols=["faculty"])
    return numbered.withColumn("chunk", F.floor((F.col("pos") - 1) / F.lit(limit)).cast("long"))


def unit_queries(members: DataFrame, limit: int = C.NAMES_PER_QUERY,
                 name_en: str = C.INSTITUTION_NAME_ENGLISH,
                 name_nl: str = C.INSTITUTION_NAME_DUTCH,
                 near: int = C.NEAR_DISTANCE) -> DataFrame:
    """Distinct names per faculty in first-appearance order, cut into runs of
    ``limit``, each written as ``(<org>) NEAR/50 ("n1" OR "n2" ...)``.

    Each output group holds at most ``limit`` names.
    """
    chunked = numbered_names(members, limit)
    grouped = chunked.groupBy("faculty", "chunk").agg(
        F.array_sort(F.collect_list(F.struct("pos", "name_variant"))).alias("names"))
    quoted = F.transform("names", lambda x: F.concat(F.lit('"'), x["name_variant"], F.lit('"')))
    query = F.concat(F.lit(f"{org_phrase(name_en, name_nl)} NEAR/{near} ("),
                     F.array_join(quoted, " OR "), F.lit(")"))
    return grouped.select("faculty", "chunk", F.size("names").cast("long").alias("n_names"),
                          query.alias("query"))


def query_file_text(queries: DataFrame) -> DataFrame:
    """Lines of the query file, sorted by faculty then chunk: ``faculty: <unit>\\n<query>\\n``."""
    return (queries.orderBy("faculty", "chunk")
            .select(F.concat(F.lit("faculty: "), F.col("faculty"), F.lit("\n"), F.col("query"),
                             F.lit("\n")).alias("value")))


def write_query_file(queries: DataFrame, path: str) -> None:
    """Sink: one text file of query blocks, in faculty order (range-sorted output parts)."""
    query_file_text(queries).write.mode("overwrite").text(path)
