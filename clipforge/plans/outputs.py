"""JSON and XML records over orders with their line items.

Stand-in: an article is an order; title ``<priority> & <<status>>`` (so HTML
escaping matters); date ``o_orderdate``; medium the customer's segment; URL
empty for status P; language ``nl`` for priority 1 (country present), else
``en``; faculty from the customer's region (AFRICA GEO, AMERICA REBO, ASIA
DGK, EUROPE BETA, other XYZ); keywords priority and status (blank for status
P, so no free-keyword group). Persons are the line items in (line number,
supplier) order: employee id ``S<supplier>``, name ``Dr <s_name>``, units the
supplier's nation then the customer's nation (classes as in ``org_lookup``).
Labels are the fixed set used without a classifier. XML record ids use a fixed
run stamp.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from clipforge.functions import constants as C
from clipforge.operators.entities import org_lookup
from clipforge.operators.labels import fixed_labels
from clipforge.operators.records import dedup_clippings, managing_unit_first, managing_unit_last, payload, \
    read_xml, record_ids, write_xml, xml_clipping
from clipforge.plans.entities import _NATION_ORGS_SQL, nation_orgs
from clipforge.plans.registry import register
from clipforge.session import scratch_path, shuffles_dropped, written
from clipforge.sources.tables import Tables

RUN_STAMP = "20250101-000000"
_LABELS = C.NO_CLASSIFIER_LABELS
#: What is read of a JSON record; its other fields are written and passed over.
_RECORD_FIELDS = """title struct<en_GB:string>, type struct<uri:string>, managingOrganization struct<uuid:string>,
workflow struct<step:string>, keywordGroups array<struct<keywords:array<struct<freeKeywords:array<string>>>>>,
mediaCoverages array<struct<coverageType:string, url:string, medium:string, date:string, country:struct<uri:string>,
  mediaType:struct<uri:string, term:struct<en_GB:string>>, degreeOfRecognition:struct<uri:string, term:struct<en_GB:string>>,
  persons:array<struct<name:struct<firstName:string, lastName:string>, role:struct<uri:string>, person:struct<uuid:string>,
    organizations:array<struct<uuid:string>>>>, organizations:array<struct<uuid:string>>>>"""


def order_articles(t, whole: bool = True):
    """Articles with their persons; unless ``whole``, persons have only what XML records hold: their
    employee ids and the ids and classes of their units."""
    orgs = nation_orgs(t)
    o = t.orders.join(t.customer, t.orders.o_custkey == t.customer.c_custkey) \
        .join(t.nation, t.customer.c_nationkey == t.nation.n_nationkey) \
        .join(t.region, t.nation.n_regionkey == t.region.r_regionkey) \
        .select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_orderdate", "c_mktsegment",
                F.col("c_nationkey").cast("string").alias("c_org"), "r_name")
    li = t.lineitem.join(t.supplier, t.lineitem.l_suppkey == t.supplier.s_suppkey) \
        .select("l_orderkey", "l_linenumber", "l_suppkey", "s_name", F.col("s_nationkey").cast("string").alias("s_org"))
    # A line item goes through the shuffle with its supplier's unit only; an order's own units (one
    # per row of its key, and per row of the unit in the unit table) are laid beside each afterwards.
    li = org_lookup(li, orgs, "s_org")
    unit = lambda org: F.struct(F.col(org).alias("organization_uuid"), "orgtype", "orgname")
    lines = li.groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", "l_suppkey", "s_name", unit("s_org").alias("unit"))).alias("_lines"))
    of = org_lookup(o.select("o_orderkey", "c_org"), orgs, "c_org")
    units = of.groupBy(F.col("o_orderkey").alias("_key")).agg(F.collect_list(unit("c_org")).alias("_units"))

    def person(x, c):
        return F.struct(
            F.concat(F.lit("S"), x["l_suppkey"].cast("string")).alias("employee_id"),
            F.concat(F.lit("supp-"), x["l_suppkey"].cast("string")).alias("uuid"),
            F.concat(F.lit("Dr "), x["s_name"]).alias("name"),
            F.array(x["unit"], c).alias("affiliations"))

    def part(p):
        unit_part = lambda u: F.struct(u["organization_uuid"].alias("organization_uuid"), u["orgtype"].alias("orgtype"))
        return F.struct(p["employee_id"].alias("employee_id"), F.transform(p["affiliations"], unit_part).alias("affiliations"))

    # Persons in the order of line, supplier, name and units. Beside one unit, as nearly always, that is the
    # order of the lines themselves; beside several, lines that tie in all are mixed by unit.
    placed = F.flatten(F.transform("_lines", lambda x: F.transform("_units", lambda c: F.struct(
        x["l_linenumber"].alias("l_linenumber"), x["l_suppkey"].alias("l_suppkey"), person(x, c).alias("p")))))
    a = (o.join(lines, o.o_orderkey == lines.l_orderkey).join(units, o.o_orderkey == units["_key"])
         .withColumn("persons", F.when(F.size("_units") == 1, F.transform(F.sort_array("_lines"), lambda x: person(x, F.get("_units", F.lit(0)))))
                     .otherwise(F.sort_array(placed)["p"])))
    if not whole:  # when they are ordered
        a = a.withColumn("persons", F.transform("persons", part))
    faculty = (F.when(F.col("r_name") == "AFRICA", "GEO").when(F.col("r_name") == "AMERICA", "REBO")
               .when(F.col("r_name") == "ASIA", "DGK").when(F.col("r_name") == "EUROPE", "BETA").otherwise("XYZ"))
    kw = F.when(F.col("o_orderstatus") == "P", F.array(F.lit(" "))) \
        .otherwise(F.array(F.col("o_orderpriority"), F.lit(" "), F.col("o_orderstatus")))
    return a.select(
        "o_orderkey", F.concat("o_orderpriority", F.lit(" & <"), "o_orderstatus", F.lit(">")).alias("title"),
        F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(
            F.concat(F.lit("https://orders.example/"), F.col("o_orderkey").cast("string"))).alias("url"),
        F.col("o_orderdate").alias("ts"), F.col("c_mktsegment").alias("media_name"), faculty.alias("faculty"),
        F.when(F.col("o_orderpriority").startswith("1"), "nl").otherwise("en").alias("language"),
        "persons", kw.alias("keywords"), fixed_labels(kw).alias("labels"))


_PERSONS_SQL = _NATION_ORGS_SQL + """,
pl AS (SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, 'Dr ' || s.s_name AS name,
              CAST(s.s_nationkey AS VARCHAR) AS s_org, coalesce(so.orgtype, 'Unknown') AS s_type,
              CAST(c.c_nationkey AS VARCHAR) AS c_org, coalesce(co.orgtype, 'Unknown') AS c_type,
              row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_suppkey) AS pn
       FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey JOIN orders o ON o.o_orderkey = l.l_orderkey
       JOIN customer c ON c.c_custkey = o.o_custkey
       LEFT JOIN norgs2 so ON so.uuid = CAST(s.s_nationkey AS VARCHAR)
       LEFT JOIN norgs2 co ON co.uuid = CAST(c.c_nationkey AS VARCHAR)),
pl2 AS (SELECT *, CASE WHEN s_type = 'Organization' THEN s_org WHEN c_type = 'Organization' THEN c_org END AS porg
        FROM pl),
per_order AS (SELECT l_orderkey,
   string_agg('S' || l_suppkey, ',' ORDER BY l_linenumber, l_suppkey) AS person_ids,
   coalesce(arg_max(porg, pn) FILTER (WHERE porg IS NOT NULL), 'UNKNOWN') AS managed_last,
   string_agg('Dr|' || substr(name, 4) || '|supp-' || l_suppkey || '|' || CASE WHEN s_org = c_org THEN s_org ELSE s_org || ',' || c_org END,
              ';' ORDER BY l_linenumber, l_suppkey) AS persons,
   string_agg('S' || l_suppkey || ':interviewee:' || s_org || ',' || c_org, ';' ORDER BY l_linenumber, l_suppkey) AS xml_persons,
   count(*) AS n_persons FROM pl2 GROUP BY 1),
first_unit AS (SELECT l_orderkey, CASE WHEN s_type = 'Organization' THEN s_org WHEN c_type = 'Organization' THEN c_org
                 WHEN s_type = 'dep/fac' THEN s_org WHEN c_type = 'dep/fac' THEN c_org ELSE s_org END AS managing_unit,
                 name FROM pl WHERE pn = 1),
n_orgs AS (SELECT l_orderkey, count(DISTINCT org) AS n_orgs, string_agg(DISTINCT org, ',' ORDER BY org) AS organizations FROM
           (SELECT l_orderkey, s_org AS org FROM pl UNION ALL SELECT l_orderkey, c_org FROM pl) GROUP BY 1)
"""


@register("managing_unit_first", sql=f"WITH {_PERSONS_SQL} SELECT l_orderkey AS o_orderkey, managing_unit FROM first_unit")
def q_managing_unit_first(spark, data_dir):
    a = order_articles(Tables(spark, data_dir))
    return a.select("o_orderkey", managing_unit_first("persons").alias("managing_unit"))


@register("managing_unit_last", sql=f"WITH {_PERSONS_SQL} SELECT l_orderkey AS o_orderkey, managed_last AS managing_unit "
          "FROM per_order")
def q_managing_unit_last(spark, data_dir):
    a = order_articles(Tables(spark, data_dir))
    return a.select("o_orderkey", managing_unit_last("persons").alias("managing_unit"))


@register("payload_json", sql=f"""WITH {_PERSONS_SQL}
SELECT o.o_orderkey,
  replace(replace(replace(o.o_orderpriority || ' & <' || o.o_orderstatus || '>', '&', '&amp;'), '<', '&lt;'), '>', '&gt;')
    AS title,
  f.managing_unit AS managing, 'CONTRIBUTION' AS coverage_type, 'Dr' AS first_name, substr(f.name, 4) AS last_name,
  p.n_persons, n.n_orgs,
  CASE r.r_name WHEN 'AFRICA' THEN 'entryInProgress' WHEN 'AMERICA' THEN 'forApproval' WHEN 'ASIA' THEN 'approved'
                WHEN 'EUROPE' THEN 'forApproval' ELSE 'approved' END AS workflow,
  CASE WHEN o.o_orderstatus = 'P' THEN 1 ELSE 2 END AS n_groups,
  CASE WHEN starts_with(o.o_orderpriority, '1') THEN '/dk/atira/pure/core/countries/nl' END AS country,
  CASE WHEN o.o_orderstatus = 'P' THEN '' ELSE 'https://orders.example/' || o.o_orderkey END AS url,
  '/dk/atira/pure/clipping/roles/clipping/interviewee' AS role_uri,
  '/dk/atira/pure/clipping/clippingtypes/clipping/exportcomment' AS type_uri,
  p.persons, n.organizations, strftime(o.o_orderdate, '%Y-%m-%d') AS date, c.c_mktsegment AS medium,
  '{C.URI_MEDIA_TYPE}{_LABELS["Medium_type"].lower()}|{_LABELS["Medium_type"]}' AS media_type,
  '{C.URI_DEGREE}{_LABELS["article_degree"].lower()}|{_LABELS["article_degree"].capitalize()}' AS degree,
  CASE WHEN o.o_orderstatus = 'P' THEN '' ELSE o.o_orderpriority || '|' || o.o_orderstatus END AS keywords
FROM orders o JOIN per_order p ON p.l_orderkey = o.o_orderkey JOIN first_unit f ON f.l_orderkey = o.o_orderkey
JOIN n_orgs n ON n.l_orderkey = o.o_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation ON c.c_nationkey = n_nationkey JOIN region r ON n_regionkey = r.r_regionkey
""")
def q_payload_json(spark, data_dir):
    a = order_articles(Tables(spark, data_dir))
    # labels as an expression: what depends on the fixed ones alone is a constant of the plan
    pl = payload("title", "url", "ts", "persons", "media_name", "faculty", "language", fixed_labels("keywords"))
    # counting the records keeps writing and parsing in projections of their own: in one, all of it is interpreted
    j = a.select("o_orderkey", F.to_json(pl).alias("j")).observe("records", F.count(F.lit(1)).alias("rows"))
    p = j.select("o_orderkey", F.from_json("j", _RECORD_FIELDS).alias("p"))   # the written text, parsed once
    cov = F.col("p.mediaCoverages")[0]
    first = cov["persons"][0]
    ids = lambda orgs: F.array_join(orgs["uuid"], ",")
    person = lambda x: F.concat_ws("|", x["name"]["firstName"], x["name"]["lastName"], x["person"]["uuid"], ids(x["organizations"]))
    named = lambda c: F.concat_ws("|", c["uri"], c["term"]["en_GB"])
    words = F.coalesce(F.array_join(F.get(F.get(F.col("p.keywordGroups"), F.lit(1))["keywords"], F.lit(0))["freeKeywords"], "|"), F.lit(""))
    return p.select(
        "o_orderkey", F.col("p.title.en_GB").alias("title"), F.col("p.managingOrganization.uuid").alias("managing"),
        cov["coverageType"].alias("coverage_type"), first["name"]["firstName"].alias("first_name"),
        first["name"]["lastName"].alias("last_name"), F.size(cov["persons"]).cast("long").alias("n_persons"),
        F.size(cov["organizations"]).cast("long").alias("n_orgs"), F.col("p.workflow.step").alias("workflow"),
        F.size("p.keywordGroups").alias("n_groups"), cov["country"]["uri"].alias("country"), cov["url"].alias("url"),
        first["role"]["uri"].alias("role_uri"), F.col("p.type.uri").alias("type_uri"),
        F.array_join(F.transform(cov["persons"], person), ";").alias("persons"), ids(cov["organizations"]).alias("organizations"),
        cov["date"].alias("date"), cov["medium"].alias("medium"), named(cov["mediaType"]).alias("media_type"),
        named(cov["degreeOfRecognition"]).alias("degree"), words.alias("keywords"))


@register("xml_records", sql=f"""WITH {_PERSONS_SQL},
arts AS (SELECT o_orderkey, o_orderpriority || ' & <' || o_orderstatus || '>' AS title,
                strftime(o_orderdate, '%Y-%m-%d') AS start_date, p.person_ids, p.managed_last AS managed_by,
                p.xml_persons AS persons, c_mktsegment AS medium,
                CASE WHEN o_orderstatus = 'P' THEN '' ELSE 'https://orders.example/' || o_orderkey END AS url,
                row_number() OVER (ORDER BY o_orderkey) - 1 AS i
         FROM orders JOIN per_order p ON p.l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey),
d AS (SELECT *, row_number() OVER (PARTITION BY lower(title), person_ids ORDER BY i) AS rn FROM arts)
SELECT '{C.RECORD_ID_PREFIX}-' || i || '-{RUN_STAMP}' AS record_id, title, start_date, managed_by, person_ids, persons, medium, url,
  '{_LABELS['typerole']}|{C.XML_VISIBILITY}|{C.XML_WORKFLOW}|{_LABELS['media_type']}|{_LABELS['Medium_type']}|{_LABELS['article_degree']}' AS fixed,
  title AS ref_title, start_date AS ref_date
FROM d WHERE rn = 1
""")
def q_xml_records(spark, data_dir):
    import uuid
    # the articles are read by the numbers, the first ones and the records; labels, fixed, are laid beside the records
    cols = ["o_orderkey", "title", "ts", "persons", "media_name", "url", "keywords"]
    with shuffles_dropped(spark):
        a = written(order_articles(Tables(spark, data_dir), whole=False).select(cols), "articles")
    ids = record_ids(a, ["o_orderkey"], RUN_STAMP)
    kept = dedup_clippings(ids, "title", "persons", "record_no").withColumn("labels", fixed_labels("keywords"))
    clip = kept.select(xml_clipping("record_id", "title", "ts", "persons", "media_name", "url", "labels")
                       .alias("clipping"))
    path = scratch_path(spark, f"xml_records/{uuid.uuid4().hex}")
    with shuffles_dropped(spark):
        write_xml(clip, path, compression="gzip")
    schema = clip.select("clipping.*").schema
    back = spark.read.format("xml").option("rowTag", "clipping").schema(schema).load(path)
    ref = F.col("mediaReferences.mediaReference")
    persons = ref["persons"]["person"]
    return back.select(F.col("_id").alias("record_id"), "title", F.col("startDate").alias("start_date"),
                       F.col("managedBy._lookupId").alias("managed_by"),
                       F.array_join(F.transform(persons, lambda x: x["_id"]), ",").alias("person_ids"),
                       F.array_join(F.transform(persons, lambda x: F.concat_ws(":", x["person"]["_lookupId"], x["role"], F.array_join(
                           F.transform(x["organisations"]["organisation"], lambda o: o["_lookupId"]), ","))), ";").alias("persons"),
                       ref["medium"].alias("medium"), F.coalesce(ref["url"], F.lit("")).alias("url"),
                       F.concat_ws("|", "_type", "visibility", "workflow", ref["_type"], ref["mediaType"], ref["degreeOfRecognition"]).alias("fixed"),
                       ref["title"].alias("ref_title"), ref["date"].alias("ref_date"))


__all__ = ["order_articles", "read_xml"]
