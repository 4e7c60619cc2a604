"""Hierarchy reports over customers, nations and regions; proximity search over documents.

Stand-in hierarchy: nations ``N<k>`` (type .../004) below regions ``R<k>``
(type .../003 for Africa, America and Asia, .../005 otherwise) below ``ALL``
(.../001). A person is a customer; their memberships are the nations of the
suppliers on their orders, active when the order falls in 1996. The persons
report is for ``R1`` and units below, with ascendants of type .../003; the
roster covers ``R0``, ``R1``, ``R2``. ``report_defined`` and ``roster_defined`` are the same
reports from definitions in the two exported formats.

Proximity stand-in: a phrase table of many queries. Query ``q<i>`` for each benchmark
item i: side a ``the`` and ``on the``; side b the item's first two words as a phrase, and
its last word. ``query_search`` writes the texts of unit queries first (faculty: the item's
number modulo 7; names: the same phrases of its items, 20 a text; institution ``the`` and
``on the``), reads them back and runs them.
"""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from clipforge.functions.text import words_of
from clipforge.operators.hierarchy import active_memberships, unit_closure, unit_report, unit_roster
from clipforge.operators.proximity import proximity_hits, search_texts
from clipforge.operators.report_definition import grouped_persons, parse_definition, related_units
from clipforge.operators.units import unit_queries
from clipforge.plans.registry import ORACLES, register
from clipforge.sources.tables import Tables

TYPE = "/dk/atira/pure/organisation/organisationtypes/organisation/"
REPORT_ROOTS = ["R1"]
ROSTER_ROOTS = ["R0", "R1", "R2"]
PERIOD = ("1996-01-01 00:00:00", "1996-12-31 00:00:00")
NEAR_A = ["the", "on the"]


def _units(spark, t):
    r = t.region.select(F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("unit_id"),
                        F.col("r_name").alias("unit_name"),
                        F.concat(F.lit(TYPE), F.when(F.col("r_name").isin("AFRICA", "AMERICA", "ASIA"), "003")
                                 .otherwise("005")).alias("type_uri"))
    n = t.nation.select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("unit_id"),
                        F.col("n_name").alias("unit_name"), F.lit(TYPE + "004").alias("type_uri"))
    root = spark.createDataFrame([("ALL", "WORLD", TYPE + "001")], "unit_id string, unit_name string, type_uri string")
    return r.unionByName(n).unionByName(root)


def _edges(t):
    n = t.nation.select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("child"),
                        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("parent"))
    r = t.region.select(F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("child"),
                        F.lit("ALL").alias("parent"))
    return n.unionByName(r)


def _member_periods(t):
    li = t.lineitem.select("l_orderkey", "l_suppkey")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(t.supplier, li.l_suppkey == t.supplier.s_suppkey)
    return j.select(F.col("o_custkey").alias("person_id"),
                    F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("unit_id"),
                    F.col("o_orderdate").alias("start_ts"), F.col("o_orderdate").alias("end_ts"))


def _memberships(t):
    return active_memberships(_member_periods(t), *PERIOD).select("person_id", "unit_id").distinct()


def _persons(t):
    return t.customer.select(F.col("c_custkey").alias("person_id"), F.col("c_name").alias("name"),
                             F.col("c_name").alias("last_name"))


_H_SQL = f"""
WITH RECURSIVE
units AS (SELECT 'R' || r_regionkey AS unit_id, r_name AS unit_name,
                 '{TYPE}' || CASE WHEN r_name IN ('AFRICA', 'AMERICA', 'ASIA') THEN '003' ELSE '005' END AS type_uri
          FROM region
          UNION ALL SELECT 'N' || n_nationkey, n_name, '{TYPE}004' FROM nation
          UNION ALL SELECT 'ALL', 'WORLD', '{TYPE}001'),
edges AS (SELECT 'N' || n_nationkey AS child, 'R' || n_regionkey AS parent FROM nation
          UNION ALL SELECT 'R' || r_regionkey, 'ALL' FROM region),
up(unit, ancestor, depth) AS (SELECT child, parent, 1 FROM edges
                              UNION ALL SELECT up.unit, e.parent, up.depth + 1 FROM up JOIN edges e ON up.ancestor = e.child),
mem AS (SELECT DISTINCT o.o_custkey AS person_id, 'N' || s.s_nationkey AS unit_id
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN supplier s ON s.s_suppkey = l.l_suppkey
        WHERE o.o_orderdate <= TIMESTAMP '{PERIOD[1]}' AND o.o_orderdate >= TIMESTAMP '{PERIOD[0]}')
"""


@register("unit_closure", sql=_H_SQL + " SELECT unit, ancestor, CAST(depth AS INTEGER) AS depth FROM up")
def q_unit_closure(spark, data_dir):
    return unit_closure(spark, _edges(Tables(spark, data_dir))).withColumn("depth", F.col("depth").cast("int"))


@register("unit_report", sql=_H_SQL + """,
below AS (SELECT unit FROM up WHERE ancestor IN ('R1') UNION SELECT 'R1'),
elig AS (SELECT DISTINCT person_id FROM mem WHERE unit_id IN (SELECT unit FROM below)),
m AS (SELECT mem.person_id, mem.unit_id, u.unit_name FROM mem JOIN units u USING (unit_id)
      WHERE mem.person_id IN (SELECT person_id FROM elig)),
cur AS (SELECT person_id, array_to_string(list_slice(list_sort(list_distinct(list(unit_name))), 1, 100), ' // ') AS units
        FROM m GROUP BY 1),
anc AS (SELECT m.person_id, a.unit_name AS anc_name FROM m JOIN up ON up.unit = m.unit_id
        JOIN units a ON a.unit_id = up.ancestor WHERE a.type_uri IN ('""" + TYPE + """003')),
asc_ AS (SELECT person_id, array_to_string(list_slice(list_sort(list_distinct(list(anc_name))), 1, 100), ' // ')
           AS ascendants FROM anc GROUP BY 1)
SELECT c.c_custkey AS person_id, c.c_name AS name, c.c_name AS last_name, cur.units, asc_.ascendants
FROM customer c JOIN cur ON cur.person_id = c.c_custkey JOIN asc_ ON asc_.person_id = c.c_custkey
""")
def q_unit_report(spark, data_dir):
    t = Tables(spark, data_dir)
    closure = unit_closure(spark, _edges(t))
    return unit_report(_persons(t), _memberships(t), _units(spark, t), closure, REPORT_ROOTS, [TYPE + "003"])


@register("unit_roster", sql=_H_SQL + """,
below AS (SELECT unit FROM up WHERE ancestor IN ('R0', 'R1', 'R2') UNION SELECT * FROM (VALUES ('R0'), ('R1'), ('R2')))
SELECT DISTINCT m.unit_id, m.person_id, u.unit_name, u.type_uri, c.c_name AS name, c.c_name AS last_name
FROM mem m JOIN units u USING (unit_id) JOIN customer c ON c.c_custkey = m.person_id
WHERE m.unit_id IN (SELECT unit FROM below)
""")
def q_unit_roster(spark, data_dir):
    t = Tables(spark, data_dir)
    closure = unit_closure(spark, _edges(t))
    return unit_roster(_persons(t), _memberships(t), _units(spark, t), closure, ROSTER_ROOTS)


def _unit_series(number, parent, relation, label, types):
    return {"id": f"s{number}", "systemName": "Organisation",
            "driverRelation": {"driverSeriesId": parent, "semanticRelationshipId": relation},
            "functions": [{"functionId": "Organisation.project(name)", "customLabel": label,
                           "emission": {"sampleSize": 2, "delimiter": " // "}}],
            "filters": [{"filterId": "Organisation.filter(type)",
                         "selectMany": {"limitationType": "MATCH", "mode": "ELIMINATE_ROWS", "values": types}}]}


#: Persons at R1 and below; the names of their nations (two at most) and of the regions above.
REPORT_JSON = json.dumps({"title": "Persons at R1", "serializedReport": {"dataSets": [{"series": [
    {"id": "s0", "systemName": "Person", "functions": [{"functionId": "Person.project(name)"}],
     "filters": [{"filterId": "Person.filter(activeAcademicStaffAtOrganisation)",
                  "hierarchicalContent": {"ids": REPORT_ROOTS, "limitationType": "MATCH", "includeUnitsBelow": True}}]},
    _unit_series(1, "s0", "Person.currentlyAffiliatedWith(Organisation)", "units", []),
    _unit_series(2, "s1", "Organisation.ascendants(Organisation)", "ascendants", [TYPE + "003"])]}]}})

#: Persons by nation below R0, R1 and R2, active, by last name from the end of the alphabet.
ROSTER_XML = f"""<exportedReportDefinition><basicTitle>Persons by unit</basicTitle>
<groupings><group recPropertyRoot="Person" recPropertyPath="organisationAssociations.organisation">
<joinBehavior>INNER</joinBehavior></group></groupings>
<applyOrderbyConfigurationAsDescending>true</applyOrderbyConfigurationAsDescending>
<orderByConfiguration id="personOrderByLastName"/>
<reportFilters><reportFilter type="reportFilter" id="organisationalUnitReportFilter">
<property name="organisationIds"><collection>{"".join(f"<value>{r}</value>" for r in ROSTER_ROOTS)}</collection></property>
<property name="organisationValueAggregator"><value>RecursiveContentValueAggregator</value></property></reportFilter>
<reportFilter type="contentPropertyReportFilter" id="period"><property name="limit"><value>active</value></property></reportFilter>
</reportFilters></exportedReportDefinition>"""


def _defined(build, text, spark, data_dir):
    t = Tables(spark, data_dir)
    return build(parse_definition(text), _persons(t), _member_periods(t), _units(spark, t), unit_closure(spark, _edges(t)), PERIOD)


@register("report_defined", sql=ORACLES["unit_report"].replace("1, 100)", "1, 2)"))
def q_report_defined(spark, data_dir):
    return _defined(related_units, REPORT_JSON, spark, data_dir)


@register("roster_defined", sql=ORACLES["unit_roster"])
def q_roster_defined(spark, data_dir):
    return _defined(grouped_persons, ROSTER_XML, spark, data_dir)


def _query_table(spark, data_dir):
    b = Tables(spark, data_dir).benchmark
    ws = words_of(F.lower("text"))
    q = b.select(F.concat(F.lit("q"), F.col("item_id").cast("string")).alias("query"), ws.alias("ws")).where(F.size("ws") >= 2)
    a = q.select("query", F.lit("a").alias("side"), F.explode(F.array(*[F.lit(x) for x in NEAR_A])).alias("phrase"))
    near = F.array(F.concat_ws(" ", F.col("ws")[0], F.col("ws")[1]), F.element_at("ws", -1))
    return a.unionByName(q.select("query", F.lit("b").alias("side"), F.explode(near).alias("phrase")))


@register("proximity_search", sql=r"""
WITH t AS (SELECT doc_id, unnest(toks) AS tok, unnest(range(0, len(toks))) AS pos
           FROM (SELECT doc_id, regexp_extract_all(lower(text), '\p{L}+') AS toks FROM documents)),
l AS (SELECT *, lead(tok, 1) OVER (PARTITION BY doc_id ORDER BY pos) AS t1 FROM t),
a AS (SELECT DISTINCT doc_id, pos FROM l WHERE tok = 'the' OR (tok = 'on' AND t1 = 'the')),
q AS (SELECT 'q' || item_id AS query, ws FROM
      (SELECT item_id, regexp_extract_all(lower(text), '\p{L}+') AS ws FROM benchmark) WHERE len(ws) >= 2),
b AS (SELECT query, doc_id, pos FROM q JOIN l ON l.tok = ws[1] AND l.t1 = ws[2]
      UNION SELECT query, doc_id, pos FROM q JOIN l ON l.tok = ws[len(ws)])
SELECT query, doc_id, count(*) AS hits FROM
  (SELECT DISTINCT b.query, a.doc_id, a.pos FROM a JOIN b ON a.doc_id = b.doc_id AND a.pos <> b.pos
   AND b.pos BETWEEN a.pos - 50 AND a.pos + 50) GROUP BY 1, 2
""")
def q_proximity_search(spark, data_dir):
    docs = Tables(spark, data_dir).spread("documents", "doc_id", "text")
    return proximity_hits(docs, "doc_id", "text", _query_table(spark, data_dir), 50)


_ITEM_NAMES_SQL = r"""
item AS (SELECT item_id, regexp_extract_all(lower(text), '\p{L}+') AS ws FROM benchmark),
names AS (SELECT 'Faculteit ' || item_id % 7 AS faculty, ws[1] || ' ' || ws[2] AS name, 2 * item_id AS row_pos FROM item WHERE len(ws) >= 2
          UNION ALL SELECT 'Faculteit ' || item_id % 7, ws[len(ws)], 2 * item_id + 1 FROM item WHERE len(ws) >= 2),
firsts AS (SELECT faculty, name, min(row_pos) AS first_pos FROM names GROUP BY ALL),
chunked AS (SELECT faculty || '#' || (row_number() OVER (PARTITION BY faculty ORDER BY first_pos, name) - 1) // 20 AS query,
                   string_split(name, ' ') AS ws FROM firsts)
"""


@register("query_search", sql=rf"""
WITH t AS (SELECT doc_id, unnest(toks) AS tok, unnest(range(0, len(toks))) AS pos
           FROM (SELECT doc_id, regexp_extract_all(lower(text), '\p{{L}}+') AS toks FROM documents)),
l AS (SELECT *, lead(tok, 1) OVER (PARTITION BY doc_id ORDER BY pos) AS t1 FROM t),
a AS (SELECT DISTINCT doc_id, pos FROM l WHERE tok = 'the' OR (tok = 'on' AND t1 = 'the')), {_ITEM_NAMES_SQL},
b AS (SELECT query, doc_id, pos FROM chunked JOIN l ON l.tok = ws[1] AND (len(ws) = 1 OR l.t1 = ws[2]))
SELECT query, doc_id, count(*) AS hits FROM
  (SELECT DISTINCT b.query, a.doc_id, a.pos FROM a JOIN b ON a.doc_id = b.doc_id AND a.pos <> b.pos
   AND b.pos BETWEEN a.pos - 50 AND a.pos + 50) GROUP BY 1, 2
""")
def q_query_search(spark, data_dir):
    t = Tables(spark, data_dir)
    item = t.benchmark.select("item_id", words_of(F.lower("text")).alias("ws")).where(F.size("ws") >= 2)
    name = lambda c, n: item.select(F.concat(F.lit("Faculteit "), (F.col("item_id") % 7).cast("string")).alias("faculty"),
                                    c.alias("name_variant"), (2 * F.col("item_id") + n).alias("row_pos"))
    members = name(F.concat_ws(" ", F.col("ws")[0], F.col("ws")[1]), 0).unionByName(name(F.element_at("ws", -1), 1))
    texts = unit_queries(members, limit=20, name_en="the", name_nl="on the", near=50)
    texts = texts.select(F.concat_ws("#", "faculty", F.col("chunk").cast("string")).alias("query_id"), "query")
    return search_texts(t.spread("documents", "doc_id", "text"), "doc_id", "text", texts)
