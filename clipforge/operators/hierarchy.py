"""Organisation hierarchy: ascendant closure and the persons-by-unit reports.

Edges are (child, parent). The closure doubles its reach each round (joins of
DataFrames, log2(depth) rounds); everything else is equi-joins and small
per-person aggregates bounded by the number of units.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipforge.functions import constants as C
from clipforge.session import written


def unit_closure(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(unit, ancestor, depth) for every ancestor at depth >= 1, with the smallest depth.

    Any depth, any number of rows, and cycles (a unit in a cycle is its own
    ancestor). After round k all pairs up to depth 2^k are known; a shortest path of
    up to twice that length is one of exactly 2^k followed by a known one, so
    joining those alone with the known pairs doubles the reach. No pair of depth
    2^k: done.
    """
    known = written(edges.select(F.col("child").cast("string").alias("unit"), F.col("parent").cast("string").alias("ancestor"))
                    .where(F.col("unit").isNotNull() & F.col("ancestor").isNotNull()).distinct()
                    .withColumn("depth", F.lit(1)), "closure")
    reach = 1
    while True:
        far = known.where(F.col("depth") == reach).select("unit", F.col("ancestor").alias("via"))
        if far.isEmpty():
            return known
        up = known.select(F.col("unit").alias("via"), "ancestor", F.col("depth").alias("more"))
        longer = far.join(up, "via").select("unit", "ancestor", (F.lit(reach) + F.col("more")).alias("depth"))
        known = written(known.unionByName(longer).groupBy("unit", "ancestor").agg(F.min("depth").alias("depth")), "closure")
        reach *= 2


def units_below(closure: DataFrame, roots: list, include_roots: bool = True) -> DataFrame:
    """Units at or below any root (``includeUnitsBelow``)."""
    below = closure.where(F.col("ancestor").isin([str(r) for r in roots])).select("unit")
    if include_roots:
        below = below.unionByName(closure.sparkSession.createDataFrame([(str(r),) for r in roots], "unit string"))
    return below.distinct()


def active_memberships(memberships: DataFrame, start, end) -> DataFrame:
    """Memberships whose period overlaps the report period (``active``)."""
    m = memberships
    s = F.lit(start).cast("timestamp_ntz")
    e = F.lit(end).cast("timestamp_ntz")
    return m.where((F.col("start_ts") <= e) & (F.coalesce(F.col("end_ts"), F.lit(C.OPEN_END_DATE).cast("timestamp_ntz")) >= s))


def capped_join(col, cap: int | None, delim: str):
    """Distinct values of a group, sorted, the first ``cap`` of them (all if None), joined."""
    values = F.array_sort(F.collect_set(col))
    return F.array_join(values if cap is None else F.slice(values, 1, cap), delim)


def unit_report(persons: DataFrame, memberships: DataFrame, units: DataFrame, closure: DataFrame,
                roots: list, ascendant_types: list, unit_types: list | None = None,
                cap: int = C.REPORT_VALUES_PER_CELL, delim: str = C.REPORT_DELIMITER) -> DataFrame:
    """Persons with an active membership at a root or below; per person their
    current units' names and the names of those units' ascendants of the given
    types, each sorted, capped and joined. An empty type list means no
    restriction; persons with no matching ascendant are dropped
    (``ELIMINATE_ROWS``).

    persons (person_id, name); memberships (person_id, unit_id) already active;
    units (unit_id, unit_name, type_uri); closure from :func:`unit_closure`.
    """
    below = units_below(closure, roots)
    eligible = memberships.join(below, memberships.unit_id == below.unit, "left_semi").select("person_id").distinct()
    m = memberships.join(eligible, "person_id", "left_semi").join(units, "unit_id")
    if unit_types:
        m = m.where(F.col("type_uri").isin(unit_types))
    anc_units = units.select(F.col("unit_id").alias("ancestor"), F.col("unit_name").alias("anc_name"),
                             F.col("type_uri").alias("anc_type"))
    if ascendant_types:
        anc_units = anc_units.where(F.col("anc_type").isin(ascendant_types))
    anc = m.select("person_id", "unit_id").join(closure, F.col("unit_id") == closure.unit) \
        .join(anc_units, "ancestor").select("person_id", "anc_name")
    cur = m.groupBy("person_id").agg(capped_join(F.col("unit_name"), cap, delim).alias("units"))
    asc = anc.groupBy("person_id").agg(capped_join(F.col("anc_name"), cap, delim).alias("ascendants"))
    return persons.join(cur, "person_id").join(asc, "person_id")


def unit_roster(persons: DataFrame, memberships: DataFrame, units: DataFrame, closure: DataFrame,
                roots: list, last_name_col: str = "last_name") -> DataFrame:
    """INNER grouping of persons by the units of their memberships (roots and
    below), ordered by unit then last name."""
    below = units_below(closure, roots)
    m = memberships.join(below, memberships.unit_id == below.unit, "left_semi").select("person_id", "unit_id") \
        .distinct()
    return (m.join(units, "unit_id").join(persons, "person_id")
            .orderBy("unit_name", last_name_col, "person_id"))
