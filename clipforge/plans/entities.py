"""Entity resolution over documents (directory) and conversations (articles).

Stand-in directory, built from ``documents`` in the directory's nested schema:
a person is a distinct lower-cased word; ``pos`` is the first document holding it; its Employee ID is ``E<first non-Spanish document>``
(persons found only in Spanish documents have no Employee ID); it has one
association per source it occurs in, from day ``floor(min(doc_id) / 10)`` to day
``max(doc_id)`` after 2000-01-01, open-ended for ``src0``.
Organisations: one per source, type segment by the source's last digit
(1 -> r01, 2 -> 003, 3 -> 004x, else 005); sources ending in 9 are unknown.

Articles are conversations dated ``2000-01-01 08:30 + conv_id days``; their
mentions are the words of all turns (first position kept). Affiliations use supplier shipping periods, units use nations.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from clipforge.functions import constants as C
from clipforge.functions.text import WORD
from clipforge.operators.entities import active_affiliations, match_mentions, org_lookup, resolve_mentions
from clipforge.operators.fuzzy import deletion_variants
from clipforge.operators.variant_index import build_index, changed, match_indexed
from clipforge.plans.registry import register
from clipforge.session import written
from clipforge.sources.tables import Tables

ORG_TYPE_BASE = "/dk/atira/pure/organisation/organisationtypes/organisation/"


def _doc_words(t):
    w = F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(WORD), 0)))
    return t.spread("documents", "doc_id", "source", "lang", "text").select("doc_id", "source", "lang", w.alias("w"))


def _day(n):
    return F.date_format(F.date_add(F.lit("2000-01-01").cast("date"), n.cast("int")), "yyyy-MM-dd")


def _materialise(df):
    """The directory and mentions are tables in a real run; here they are derived
    from the given tables, so they are written once to the shared folder
    instead of being re-derived by every join that reads them."""
    return written(df, "derived")


def directory(t):
    return _materialise(_directory(t))


def _directory(t):
    dw = _doc_words(t)
    # the texts are read once: a person's own facts are those of its sources
    per_src = dw.groupBy("w", "source").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"),
                                            F.min(F.when(F.col("lang") != "es", F.col("doc_id"))).alias("emp"))
    assoc = F.struct(F.struct(F.col("source").alias("uuid")).alias("organization"),
                     F.struct(_day(F.floor(F.col("lo") / 10)).alias("startDate"),
                              F.when(F.col("source") != "src0", _day(F.col("hi"))).alias("endDate")).alias("period"))
    people = per_src.groupBy("w").agg(F.min("lo").alias("pos"), F.min("emp").alias("emp_doc"),
                                      F.array_sort(F.collect_list(assoc)).alias("staffOrganizationAssociations"))
    ident = F.when(F.col("emp_doc").isNotNull(), F.array(F.struct(
        F.concat(F.lit("E"), F.col("emp_doc").cast("string")).alias("id"),
        F.struct(F.struct(F.lit(C.EMPLOYEE_ID_TERM).alias("en_GB")).alias("term")).alias("type")))) \
        .otherwise(F.array(F.struct(F.lit("x").alias("id"),
                                    F.struct(F.struct(F.lit("Other").alias("en_GB")).alias("term")).alias("type"))))
    name_t = "struct<name:struct<firstName:string,lastName:string>>"
    return (people
            .select("pos", F.col("w").alias("uuid"),
                    F.struct(F.col("w").alias("firstName"), F.lit(None).cast("string").alias("lastName")).alias("name"),
                    F.array().cast(f"array<{name_t}>").alias("names"),
                    ident.alias("identifiers"), "staffOrganizationAssociations"))


def organisations(t):
    s = t.documents.select("source").distinct().where(~F.col("source").endswith("9"))
    seg = (F.when(F.col("source").endswith("1"), "r01").when(F.col("source").endswith("2"), "003")
           .when(F.col("source").endswith("3"), "004x").otherwise("005"))
    return s.select(F.col("source").alias("uuid"),
                    F.struct(F.concat(F.lit(ORG_TYPE_BASE), seg).alias("uri")).alias("type"),
                    F.struct(F.upper("source").alias("en_GB")).alias("name"))


def mentions(t):
    return _materialise(_mentions(t))


def _mentions(t):
    c = t.spread("conversations", "conv_id", "turn", "text").select("conv_id", "turn", F.posexplode(F.regexp_extract_all("text", F.lit(WORD), 0))
                               .alias("idx", "mention"))
    place = F.shiftleft(F.col("turn").cast("long"), 32) + F.col("idx")  # an array holds fewer than 2^31 words
    m = c.groupBy("conv_id", "mention").agg(F.min(place).alias("mention_pos"))
    ts = F.timestamp_add("DAY", F.col("conv_id"), F.lit("2000-01-01 08:30:00").cast("timestamp_ntz"))
    return m.select(F.col("conv_id").alias("article_id"), "mention_pos", "mention", ts.alias("ts"))


# --- SQL ----------------------------------------------------------------------------

_WORDS_SQL = r"""
doc_words AS (SELECT DISTINCT doc_id, source, lang, w FROM
  (SELECT doc_id, source, lang, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS w FROM documents)),
dir AS (SELECT w AS uuid, min(doc_id) AS pos, min(doc_id) FILTER (WHERE lang <> 'es') AS emp_doc
        FROM doc_words GROUP BY w)
"""


def _variants_sql(src: str, name: str) -> str:
    # Deletion variants with k <= min(floor(2n/19), 2): exact for words under 29 letters.
    return f"""
{name}_1 AS (SELECT w, unnest(range(1, length(w) + 1)) AS i FROM {src} WHERE (2 * length(w)) // 19 >= 1),
{name}_2 AS (SELECT w, i, unnest(range(i + 1, length(w) + 1)) AS j FROM {name}_1 WHERE (2 * length(w)) // 19 >= 2),
{name} AS (
  SELECT w, w AS variant, 0 AS k FROM {src}
  UNION ALL SELECT DISTINCT w, substr(w, 1, i - 1) || substr(w, i + 1), 1 FROM {name}_1
  UNION ALL SELECT DISTINCT w, substr(w, 1, i - 1) || substr(w, i + 1, j - i - 1) || substr(w, j + 1), 2
            FROM {name}_2)
"""


_MENTIONS_SQL = r"""
conv_toks AS (SELECT conv_id, turn, unnest(toks) AS mention, unnest(range(0, len(toks))) AS idx
              FROM (SELECT conv_id, turn, regexp_extract_all(text, '\p{L}+') AS toks FROM conversations)),
ments AS (SELECT conv_id AS article_id, mention, min(CAST(turn AS BIGINT) * 4294967296 + idx) AS mention_pos
          FROM conv_toks GROUP BY 1, 2),
ments_ts AS (SELECT *, TIMESTAMP '2000-01-01 08:30:00' + to_days(CAST(article_id AS INTEGER)) AS ts FROM ments),
mkeys AS (SELECT DISTINCT lower(mention) AS w FROM ments),
dkeys AS (SELECT DISTINCT uuid AS w FROM dir)
"""

_MATCH_SQL = _WORDS_SQL + "," + _MENTIONS_SQL + "," + _variants_sql("mkeys", "mvar") + "," + \
    _variants_sql("dkeys", "dvar") + r""",
pairs AS (SELECT a.w AS mention_key, b.w AS uuid, min(a.k + b.k) AS d
          FROM mvar a JOIN dvar b ON a.variant = b.variant GROUP BY 1, 2),
ok_pairs AS (SELECT p.*, length(mention_key) + length(uuid) AS L FROM pairs p
             WHERE 100 * (length(mention_key) + length(uuid) - d) >= 95 * (length(mention_key) + length(uuid))),
ranked AS (SELECT o.*, dir.pos, row_number() OVER (PARTITION BY mention_key
                 ORDER BY CAST(d AS DOUBLE) / L, dir.pos, o.uuid) AS rn
           FROM ok_pairs o JOIN dir ON dir.uuid = o.uuid),
best AS (SELECT mention_key, uuid, pos, d, L FROM ranked WHERE rn = 1)
"""

_RESOLVE_SQL = _MATCH_SQL + r""",
assoc AS (SELECT w AS uuid, source AS org_uuid,
                 CAST(DATE '2000-01-01' + CAST(min(doc_id) // 10 AS INTEGER) AS TIMESTAMP) AS start_ts,
                 CASE WHEN source <> 'src0' THEN CAST(DATE '2000-01-01' + CAST(max(doc_id) AS INTEGER) AS TIMESTAMP)
                      ELSE TIMESTAMP '9999-12-31 00:00:00' END AS end_ts
          FROM doc_words GROUP BY 1, 2),
orgs AS (SELECT DISTINCT source AS org, CASE WHEN source LIKE '%1' THEN 'r01' WHEN source LIKE '%2' THEN '003'
                 WHEN source LIKE '%3' THEN '004x' ELSE '005' END AS seg FROM documents WHERE source NOT LIKE '%9'),
orgs2 AS (SELECT org, upper(org) AS orgname,
                 CASE WHEN contains(seg, 'r') THEN 'Research organization'
                      WHEN starts_with(seg, '003') OR starts_with(seg, '004') THEN 'dep/fac'
                      ELSE 'Organization' END AS orgtype FROM orgs),
matched AS (SELECT m.article_id, m.mention_pos, m.mention, m.ts, b.uuid, 'E' || CAST(dir.emp_doc AS VARCHAR) AS employee_id
            FROM ments_ts m JOIN best b ON lower(m.mention) = b.mention_key JOIN dir ON dir.uuid = b.uuid
            WHERE dir.emp_doc IS NOT NULL),
active AS (SELECT m.article_id, m.mention_pos, a.org_uuid, coalesce(o.orgtype, 'Unknown') AS orgtype,
                  coalesce(o.orgname, 'Unknown') AS orgname
           FROM matched m JOIN assoc a ON a.uuid = m.uuid AND a.start_ts <= m.ts AND m.ts <= a.end_ts
           LEFT JOIN orgs2 o ON o.org = a.org_uuid),
affs AS (SELECT article_id, mention_pos,
                string_agg(org_uuid || ':' || orgtype || ':' || orgname, '|' ORDER BY org_uuid) AS affiliations
         FROM active GROUP BY 1, 2),
okm AS (SELECT m.*, f.affiliations FROM matched m JOIN affs f USING (article_id, mention_pos)),
kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY article_id, employee_id, affiliations
                                                   ORDER BY mention_pos) AS rn FROM okm) WHERE rn = 1)
"""


def _aff_text(col):
    return F.array_join(F.transform(col, lambda x: F.concat_ws(":", x["organization_uuid"], x["orgtype"],
                                                               x["orgname"])), "|")


@register("name_variants", sql=f"WITH {_WORDS_SQL}, dkeys AS (SELECT DISTINCT uuid AS w FROM dir), "
          + _variants_sql("dkeys", "dvar") + " SELECT w AS word, variant, k FROM dvar")
def q_name_variants(spark, data_dir):
    t = Tables(spark, data_dir)
    words = _doc_words(t).select(F.col("w").alias("word")).distinct()
    return deletion_variants(words, "word", "word")


@register("fuzzy_match", sql=f"WITH {_MATCH_SQL} SELECT mention_key, uuid, CAST(d AS INTEGER) AS d, "
          "CAST(L AS INTEGER) AS L FROM best")
def q_fuzzy_match(spark, data_dir):
    t = Tables(spark, data_dir)
    return match_mentions(mentions(t), directory(t), "mention").select("mention_key", "uuid", "d", "L")


@register("indexed_match", sql=f"WITH {_MATCH_SQL} SELECT mention_key, uuid, CAST(d AS INTEGER) AS d, "
          "CAST(L AS INTEGER) AS L FROM best")
def q_indexed_match(spark, data_dir):
    """``fuzzy_match`` against a stored index: built from the persons with an Employee ID, then
    changed by those without one."""
    t = Tables(spark, data_dir)
    people = directory(t)
    has_id = F.exists(F.coalesce("identifiers", F.array()), lambda x: x["id"].isNotNull())
    index = changed(build_index(people.where(has_id)), people.where(~has_id))
    return match_indexed(mentions(t), index, "mention").select("mention_key", "uuid", "d", "L")


@register("resolve_entities", sql=f"""WITH {_RESOLVE_SQL}
SELECT article_id, mention_pos, mention, employee_id, uuid, affiliations FROM kept""")
def q_resolve_entities(spark, data_dir):
    t = Tables(spark, data_dir)
    kept, _, _ = resolve_mentions(mentions(t), directory(t), organisations(t))
    return kept.select("article_id", "mention_pos", "mention", "employee_id", "uuid",
                       _aff_text(F.col("affiliations")).alias("affiliations"))


@register("unresolved_mentions", sql=f"""WITH {_RESOLVE_SQL}
SELECT article_id, mention_pos, mention FROM ments
WHERE (article_id, mention_pos) NOT IN (SELECT (article_id, mention_pos) FROM okm)""")
def q_unresolved_mentions(spark, data_dir):
    t = Tables(spark, data_dir)
    _, unresolved, _ = resolve_mentions(mentions(t), directory(t), organisations(t))
    return unresolved


# --- affiliation periods and units on the TPC-H tables ---------------------------------

def _supplier_assocs(t):
    """Supplier shipping period; suppliers with a negative balance are open-ended."""
    per = t.lineitem.groupBy("l_suppkey").agg(F.min("l_shipdate").alias("start_ts"),
                                              F.max("l_shipdate").alias("last_ts"))
    s = t.supplier.join(per, t.supplier.s_suppkey == per.l_suppkey)
    end = F.when(F.col("s_acctbal") < 0, F.lit("9999-12-31 00:00:00").cast("timestamp_ntz")).otherwise(F.col("last_ts"))
    return s.select(F.col("s_suppkey").alias("uuid"), F.lit(0).alias("assoc_no"),
                    F.col("s_nationkey").cast("string").alias("org_uuid"), "start_ts", end.alias("end_ts"),
                    F.lit(False).alias("malformed"))


@register("active_affiliations", sql="""
WITH per AS (SELECT l_suppkey, min(l_shipdate) AS start_ts, max(l_shipdate) AS last_ts FROM lineitem GROUP BY 1),
a AS (SELECT s_suppkey, start_ts, CASE WHEN s_acctbal < 0 THEN TIMESTAMP '9999-12-31 00:00:00' ELSE last_ts END AS end_ts
      FROM supplier JOIN per ON s_suppkey = l_suppkey)
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN a ON a.s_suppkey = l.l_suppkey
WHERE a.start_ts <= o.o_orderdate AND o.o_orderdate <= a.end_ts
""")
def q_active_affiliations(spark, data_dir):
    t = Tables(spark, data_dir)
    probes = t.lineitem.join(t.orders, t.lineitem.l_orderkey == t.orders.o_orderkey) \
        .select("l_orderkey", "l_linenumber", "l_suppkey", "o_orderdate")
    return active_affiliations(probes, _supplier_assocs(t), "l_suppkey", "o_orderdate") \
        .select("l_orderkey", "l_linenumber", "l_suppkey")


def nation_orgs(t):
    """Nations as organisations; the type segment follows the region, Middle East unknown."""
    j = t.nation.join(t.region, t.nation.n_regionkey == t.region.r_regionkey).where(F.col("r_name") != "MIDDLE EAST")
    seg = (F.when(F.col("r_name") == "AFRICA", "003").when(F.col("r_name") == "AMERICA", "004x")
           .when(F.col("r_name") == "ASIA", "r01").otherwise("005"))
    return j.select(F.col("n_nationkey").cast("string").alias("uuid"),
                    F.struct(F.concat(F.lit(ORG_TYPE_BASE), seg).alias("uri")).alias("type"),
                    F.struct(F.col("n_name").alias("en_GB")).alias("name"))


_NATION_ORGS_SQL = """
norgs AS (SELECT CAST(n_nationkey AS VARCHAR) AS uuid, n_name AS orgname,
                 CASE r_name WHEN 'AFRICA' THEN '003' WHEN 'AMERICA' THEN '004x' WHEN 'ASIA' THEN 'r01' ELSE '005' END AS seg
          FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'MIDDLE EAST'),
norgs2 AS (SELECT uuid, orgname, CASE WHEN contains(seg, 'r') THEN 'Research organization'
                  WHEN starts_with(seg, '003') OR starts_with(seg, '004') THEN 'dep/fac' ELSE 'Organization' END AS orgtype
           FROM norgs)
"""


@register("org_lookup", sql=f"""WITH {_NATION_ORGS_SQL}
SELECT s_suppkey, CAST(s_nationkey AS VARCHAR) AS org_uuid, coalesce(o.orgtype, 'Unknown') AS orgtype,
       coalesce(o.orgname, 'Unknown') AS orgname
FROM supplier LEFT JOIN norgs2 o ON o.uuid = CAST(s_nationkey AS VARCHAR)
""")
def q_org_lookup(spark, data_dir):
    t = Tables(spark, data_dir)
    s = t.supplier.select("s_suppkey", F.col("s_nationkey").cast("string").alias("org_uuid"))
    return org_lookup(s, nation_orgs(t))
