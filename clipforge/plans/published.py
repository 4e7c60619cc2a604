"""Already-published check, article status and run counts over the events table.

Stand-in: an incoming article is an event of type click, view or error; its
title is made of ``k`` from the ``props`` JSON, its persons the event's
``user_id``. A published item is a purchase event, its title made of its own ``k`` in
another spelling with the same comparison key: plain ASCII in another case,
``straße`` against ``STRASSE``, full-width letters, an entity against its character. The person directory is the signup events: a user counts as
resolved for an article when a signup precedes it. Articles whose props lack
``k`` are malformed (``error``).

XML-record dedup (title + ordered person ids) uses orders: title
``<priority> <status>``, person ids the line items' suppliers in line order
(line number, then supplier: line numbers repeat within an order).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from clipforge.operators.duplicates import already_published, keep_first, not_yet_published, \
    published_article_ids, published_table
from clipforge.operators.status import article_status, outcome_counts, status_counts
from clipforge.plans.registry import register
from clipforge.sources.tables import Tables

#: (article spelling, published spelling) by k modulo 4.
SPELLINGS = [(" item ", "ITEM "), ("Straße ", " STRASSE "), ("\uff29\uff34\uff25\uff2d ", "item "), ("R&amp;D Caf&eacute; ", "r&d CAFÉ ")]

_EV_SQL = r"""
ev AS (SELECT *, json_extract_string(props, '$.k') AS k FROM events),
art AS (SELECT event_id, CASE CAST(k AS INTEGER) % 4 WHEN 1 THEN 'Straße ' WHEN 2 THEN 'ＩＴＥＭ ' WHEN 3 THEN 'R&amp;D Caf&eacute; '
                         ELSE ' item ' END || k || ' ' AS title, ts, user_id, k FROM ev
        WHERE event_type NOT IN ('purchase', 'signup')),
pub AS (SELECT k, ts, user_id FROM ev WHERE event_type = 'purchase')
"""
# Two titles have one key exactly when they are made of the same k.
_MATCH = """EXISTS (SELECT 1 FROM pub p WHERE p.k = a.k
                  AND CAST(p.ts AS DATE) = CAST(a.ts AS DATE) AND p.user_id = a.user_id)"""
_MATCH_R = """EXISTS (SELECT 1 FROM pub p WHERE p.k = r.k
                    AND CAST(p.ts AS DATE) = CAST(r.ts AS DATE) AND p.user_id = r.user_id)"""


def _events(spark, data_dir):
    return Tables(spark, data_dir).events.withColumn("k", F.get_json_object("props", "$.k"))


def _spelled(which):
    x = F.lit(SPELLINGS[0][which])
    for i in (1, 2, 3):
        x = F.when(F.col("k").cast("int") % 4 == i, F.lit(SPELLINGS[i][which])).otherwise(x)
    return F.concat(x, "k")


def _articles(ev):
    return (ev.where(~F.col("event_type").isin("purchase", "signup"))
            .select("event_id", F.concat(_spelled(0), F.lit(" ")).alias("title"), "ts",
                    "user_id", "k", F.array("user_id").alias("persons")))


def _published(ev):
    return (ev.where(F.col("event_type") == "purchase")
            .select(_spelled(1).alias("pub_title"), F.col("ts").alias("pub_start"),
                    F.array("user_id").alias("pub_persons")))


_KW = dict(id_col="event_id", title_col="title", ts_col="ts", persons_col="persons",
           pub_title_col="pub_title", pub_start_col="pub_start", pub_persons_col="pub_persons")


@register("already_published", sql=f"WITH {_EV_SQL} SELECT event_id, title FROM art a WHERE {_MATCH}")
def q_already_published(spark, data_dir):
    ev = _events(spark, data_dir)
    return already_published(_articles(ev), _published(ev), **_KW).select("event_id", "title")


@register("not_yet_published", sql=f"WITH {_EV_SQL} SELECT event_id, title FROM art a WHERE NOT {_MATCH}")
def q_not_yet_published(spark, data_dir):
    ev = _events(spark, data_dir)
    return not_yet_published(_articles(ev), _published(ev), **_KW).select("event_id", "title")


_STATUS_SQL = f"""
WITH {_EV_SQL},
dir AS (SELECT user_id, min(ts) AS start_ts FROM ev WHERE event_type = 'signup' GROUP BY 1),
r AS (SELECT a.*, d.user_id IS NOT NULL AS resolved FROM art a
      LEFT JOIN dir d ON a.user_id = d.user_id AND d.start_ts <= a.ts),
st AS (SELECT event_id, CASE WHEN k IS NULL THEN 'error' WHEN NOT resolved THEN 'no_persons'
                             WHEN {_MATCH_R} THEN 'duplicate'
                             ELSE 'ok' END AS status FROM r)
"""


def _status(spark, data_dir):
    ev = _events(spark, data_dir)
    arts = _articles(ev)
    directory = (ev.where(F.col("event_type") == "signup").groupBy("user_id")
                 .agg(F.min("ts").alias("start_ts")))
    j = arts.join(directory.withColumnRenamed("user_id", "d_user"),
                  (arts.user_id == F.col("d_user")) & (F.col("start_ts") <= arts.ts), "left")
    resolved = j.withColumn("resolved", F.when(F.col("d_user").isNotNull(), F.array("user_id"))
                            .otherwise(F.array().cast("array<bigint>")))
    dup_ids = published_article_ids(resolved, _published(ev), **{**_KW, "persons_col": "resolved"})
    marked = resolved.join(dup_ids.withColumn("dup", F.lit(True)), "event_id", "left") \
        .withColumn("dup", F.coalesce("dup", F.lit(False))) \
        .withColumn("malformed", F.col("k").isNull())
    return article_status(marked, "resolved", "dup", malformed_col="malformed")


@register("article_status", sql=_STATUS_SQL + "SELECT event_id, status FROM st")
def q_article_status(spark, data_dir):
    return _status(spark, data_dir).select("event_id", "status")


@register("status_counts", sql=_STATUS_SQL + """
SELECT s.status, CAST(count(st.event_id) AS BIGINT) AS n
FROM (VALUES ('ok'), ('duplicate'), ('no_persons'), ('error')) s(status)
LEFT JOIN st ON st.status = s.status GROUP BY 1
""")
def q_status_counts(spark, data_dir):
    return status_counts(_status(spark, data_dir))


@register("outcome_counts", sql="""
SELECT CAST(count(*) FILTER (WHERE code IN (200, 201)) AS BIGINT) AS success,
       CAST(count(*) FILTER (WHERE code NOT IN (200, 201) OR code IS NULL) AS BIGINT) AS fail
FROM (SELECT CASE event_type WHEN 'purchase' THEN 201 WHEN 'error' THEN 500 ELSE 200 END AS code FROM events)
""")
def q_outcome_counts(spark, data_dir):
    ev = Tables(spark, data_dir).events
    code = (F.when(F.col("event_type") == "purchase", 201).when(F.col("event_type") == "error", 500)
            .otherwise(200))
    return outcome_counts(ev.select(code.alias("code")), "code")


@register("dedup_title_ids", sql="""
WITH ids AS (SELECT l_orderkey, string_agg(CAST(l_suppkey AS VARCHAR), ',' ORDER BY l_linenumber, l_suppkey) AS person_ids
             FROM lineitem GROUP BY 1),
a AS (SELECT o_orderkey, o_orderpriority || ' ' || o_orderstatus AS title, person_ids
      FROM orders JOIN ids ON o_orderkey = l_orderkey),
r AS (SELECT *, row_number() OVER (PARTITION BY lower(title), person_ids ORDER BY o_orderkey) AS rn FROM a)
SELECT o_orderkey, title, person_ids FROM r WHERE rn = 1
""")
def q_dedup_title_ids(spark, data_dir):
    t = Tables(spark, data_dir)
    ids = (t.lineitem.groupBy("l_orderkey")
           .agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey"))).alias("s"))
           .select("l_orderkey", F.transform("s", lambda x: x["l_suppkey"]).alias("ids")))
    a = t.orders.join(ids, t.orders.o_orderkey == ids.l_orderkey).select(
        "o_orderkey", F.concat_ws(" ", "o_orderpriority", "o_orderstatus").alias("title"), "ids")
    a = a.withColumn("_lt", F.lower("title"))
    kept = keep_first(a, key_cols=["_lt", "ids"], order_col="o_orderkey")
    return kept.select("o_orderkey", "title",
                       F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("person_ids"))


# --- published items in their nested form --------------------------------------------

@register("published_items", sql=r"""
WITH ev AS (SELECT *, json_extract_string(props, '$.k') AS k FROM events WHERE event_type = 'purchase')
SELECT event_id, CASE WHEN event_id % 7 > 0 THEN 'Item ' || k END AS pub_title,
       CASE WHEN event_id % 5 > 0 THEN CAST(CAST(ts AS DATE) AS VARCHAR) END AS pub_start,
       CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'E' || user_id ELSE 'E' || user_id || '|u' || user_id END AS persons
FROM ev""")
def q_published_items(spark, data_dir):
    """Purchases as nested items, some without a title, a start date, a person or an external id."""
    ev = _events(spark, data_dir).where(F.col("event_type") == "purchase")
    n = F.col("event_id")
    user = F.col("user_id").cast("string")
    person = lambda ext, own: F.struct(F.struct(ext.cast("string").alias("externalId"), own.cast("string").alias("internalId")).alias("person"))
    none = F.lit(None)
    nobody = F.struct(F.lit(None).cast("struct<externalId:string,internalId:string>").alias("person"))
    text = F.array(F.struct(F.concat(F.lit("Item "), "k").alias("value")))
    items = ev.select(
        "event_id", F.struct(F.when(n % 7 > 0, text).otherwise(F.slice(text, 1, 0)).alias("text")).alias("title"),
        F.struct(F.when(n % 5 > 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("startDate")).alias("period"),
        F.when(n % 3 == 0, F.array(nobody)).when(n % 3 == 1, F.array(nobody, person(F.concat(F.lit("E"), user), none)))
        .otherwise(F.array(person(F.concat(F.lit("E"), user), F.concat(F.lit("u"), user)))).alias("personAssociations"))
    return published_table(items, "event_id").select("event_id", "pub_title", F.col("pub_start").cast("string").alias("pub_start"),
                                                     F.array_join("pub_persons", "|").alias("persons"))
