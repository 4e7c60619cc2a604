"""Unit queries over the customer table (persons export stand-in).

Stand-in: a person is a customer; the unit path is
``Universiteit // Faculteit <region> // Faculteit <nation>``; customers with a
negative balance have ``Dept <segment>`` (no faculty, dropped) and those with a
balance under 100 have ``Faculteit // <nation>`` (kept whole). Name = c_name,
row order = c_custkey. Names per query: 20 here (the default is 1300).
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from clipforge.operators.entities import directory_spellings
from clipforge.operators.units import unit_members, unit_queries, write_query_file
from clipforge.plans.registry import register
from clipforge.session import scratch_path
from clipforge.sources.tables import Tables

STANDIN_LIMIT = 20


def _export(spark, data_dir):
    t = Tables(spark, data_dir)
    c = t.customer
    n = t.nation
    r = t.region
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    unit = (F.when(F.col("c_acctbal") < 0, F.concat(F.lit("Dept "), "c_mktsegment"))
            .when(F.col("c_acctbal") < 100, F.concat(F.lit("Faculteit // "), "n_name"))
            .otherwise(F.concat(F.lit("Universiteit // Faculteit "), "r_name",
                                F.lit(" // Faculteit "), "n_name")))
    return j.select(unit.alias("org_unit"), F.col("c_name").alias("name_variant"),
                    F.col("c_custkey").alias("row_pos"))


_EXPORT_SQL = """
export AS (
  SELECT c.c_custkey AS row_pos, c.c_name AS name_variant,
         CASE WHEN c.c_acctbal < 0 THEN 'Dept ' || c.c_mktsegment
              WHEN c.c_acctbal < 100 THEN 'Faculteit // ' || n.n_name
              ELSE 'Universiteit // Faculteit ' || r.r_name || ' // Faculteit ' || n.n_name END AS org_unit
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey),
parts AS (
  SELECT row_pos, name_variant, org_unit,
         list_filter(list_transform(string_split(org_unit, '//'), lambda x: trim(x)),
                     lambda x: starts_with(x, 'Faculteit ')) AS facs
  FROM export),
members AS (
  SELECT unnest(CASE WHEN len(facs) > 0 THEN facs
                     WHEN starts_with(org_unit, 'Faculteit ') THEN [org_unit]
                     ELSE [] END) AS faculty, name_variant, row_pos
  FROM parts)
"""


@register("unit_members", sql=f"WITH {_EXPORT_SQL} SELECT faculty, name_variant, row_pos FROM members")
def q_unit_members(spark, data_dir):
    return unit_members(_export(spark, data_dir))


_QUERIES_SQL = f"""
WITH {_EXPORT_SQL},
firsts AS (SELECT faculty, name_variant, min(row_pos) AS first_pos FROM members GROUP BY 1, 2),
numbered AS (SELECT *, row_number() OVER (PARTITION BY faculty ORDER BY first_pos, name_variant) AS pos
             FROM firsts)
SELECT faculty, CAST((pos - 1) // {STANDIN_LIMIT} AS BIGINT) AS chunk, CAST(count(*) AS BIGINT) AS n_names,
       '("Utrecht University" OR "Universiteit Utrecht") NEAR/50 ('
         || string_agg('"' || name_variant || '"', ' OR ' ORDER BY pos) || ')' AS query
FROM numbered GROUP BY 1, 2
"""


@register("unit_queries", sql=_QUERIES_SQL)
def q_unit_queries(spark, data_dir):
    return unit_queries(unit_members(_export(spark, data_dir)), limit=STANDIN_LIMIT)


@register("query_file", sql=f"""WITH q AS ({_QUERIES_SQL})
SELECT unnest(['faculty: ' || faculty, query, '']) AS value FROM q""")
def q_query_file(spark, data_dir):
    path = scratch_path(spark, f"query_file/{uuid.uuid4().hex}")
    write_query_file(unit_queries(unit_members(_export(spark, data_dir)), limit=STANDIN_LIMIT), path)
    return spark.read.text(path)


@register("name_spellings", sql="""
SELECT DISTINCT 's' || s_suppkey AS uuid, s_suppkey AS pos, unnest(['Dr ' || s_name, s_name, n_name || ' ' || s_name]) AS spelling
FROM supplier JOIN nation ON n_nationkey = s_nationkey""")
def q_name_spellings(spark, data_dir):
    """Suppliers as a directory: main name ``Dr <name>``; alternatives without a first name, the
    main one again, one of blanks, one with the nation as first name."""
    t = Tables(spark, data_dir)
    s = t.supplier.join(t.nation, t.supplier.s_nationkey == t.nation.n_nationkey)
    name = lambda first, last: F.struct(F.struct(first.cast("string").alias("firstName"), last.cast("string").alias("lastName")).alias("name"))
    none = F.lit(None)
    d = s.select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("uuid"), F.col("s_suppkey").alias("pos"),
                 name(F.lit("Dr"), F.col("s_name"))["name"].alias("name"),
                 F.array(name(none, F.col("s_name")), name(F.lit(" Dr"), F.col("s_name")), name(F.lit("  "), none), name(F.col("n_name"), F.col("s_name"))).alias("names"))
    return directory_spellings(d)
