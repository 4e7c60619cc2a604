"""Output records: managing unit picks, JSON payloads, XML clippings.

``persons`` is ARRAY<STRUCT<employee_id, uuid, name, affiliations:
ARRAY<STRUCT<organization_uuid, orgtype, orgname>>>> in article order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipforge.functions import constants as C
from clipforge.functions.text import capitalize, col_, html_escape, split_ws, strip_ws
from clipforge.operators.duplicates import keep_first
from clipforge.operators.lookups import lookup, workflow_struct
from clipforge.operators.ordering import positions


def _first_of(arr: Column, orgtype: str) -> Column:
    return F.try_element_at(F.filter(arr, lambda a: a["orgtype"] == orgtype), F.lit(1))


def managing_unit_first(persons) -> Column:
    """Of the first person's units: the first ``Organization``, else the first
    ``dep/fac``, else the first unit; ``UNKNOWN`` without any."""
    affs = F.coalesce(F.try_element_at(col_(persons), F.lit(1))["affiliations"],
                      F.array().cast("array<struct<organization_uuid:string,orgtype:string,orgname:string>>"))
    pick = F.coalesce(_first_of(affs, C.ORG_PLAIN), _first_of(affs, C.ORG_DEPFAC), F.try_element_at(affs, F.lit(1)))
    return F.coalesce(pick["organization_uuid"], F.lit(C.FALLBACK_ORG_UUID))


def managing_unit_last(persons, fallback: str = C.FALLBACK_ORG_UUID) -> Column:
    """For each person the first ``Organization`` unit; the last person having
    one wins; else the fallback."""
    firsts = F.transform(col_(persons), lambda p: _first_of(p["affiliations"], C.ORG_PLAIN)["organization_uuid"])
    found = F.filter(firsts, lambda x: x.isNotNull())
    return F.coalesce(F.try_element_at(found, F.lit(-1)), F.lit(fallback))


def _keyword_groups(keywords: Column) -> Column:
    cls = F.struct(F.lit(C.CLASSIFICATION_GROUP_TYPE).alias("typeDiscriminator"),
                   F.lit(C.CLASSIFICATION_GROUP_LOGICAL_NAME).alias("logicalName"),
                   F.struct(F.lit(C.CLASSIFICATION_GROUP_NAME).alias("en_GB")).alias("name"),
                   F.array(F.struct(F.lit(C.CLASSIFICATION_URI).alias("uri"),
                                    F.struct(F.lit("true").alias("en_GB")).alias("term"))).alias("classifications"),
                   F.lit(None).cast("array<struct<locale:string,freeKeywords:array<string>>>").alias("keywords"))
    free = F.struct(F.lit(C.FREE_KEYWORDS_GROUP_TYPE).alias("typeDiscriminator"),
                    F.lit(C.FREE_KEYWORDS_LOGICAL_NAME).alias("logicalName"),
                    F.struct(F.lit(C.FREE_KEYWORDS_NAME).alias("en_GB")).alias("name"),
                    F.lit(None).cast("array<struct<uri:string,term:struct<en_GB:string>>>").alias("classifications"),
                    F.array(F.struct(F.lit(C.LOCALE).alias("locale"), keywords.alias("freeKeywords"))).alias("keywords"))
    return F.when(F.size(keywords) > 0, F.array(cls, free)).otherwise(F.array(cls))


def _org_refs(uuids: Column) -> Column:
    return F.transform(uuids, lambda u: F.struct(u.alias("uuid"), F.lit(C.SYSTEM_ORGANIZATION).alias("systemName")))


def payload(title, url, date, persons, media_name, faculty, language, labels) -> Column:
    """The JSON record of an article as a struct (``to_json`` omits null fields,
    which drops ``country`` outside Dutch). ``labels`` is the struct of
    :func:`operators.labels.normalise_labels` / ``fixed_labels``."""
    lb = col_(labels)
    d = C.PAYLOAD_DEFAULTS
    medium_type = F.coalesce(lb["Medium_type"], F.lit(d["Medium_type"]))
    typerole = F.coalesce(lb["typerole"], F.lit(d["typerole"]))
    degree = F.coalesce(lb["article_degree"], F.lit(d["article_degree"]))
    role = F.coalesce(lb["researcher_role"], F.lit(d["researcher_role"]))
    kw = F.filter(F.transform(F.coalesce(lb["keywords"], F.array().cast("array<string>")), lambda k: strip_ws(k)),
                  lambda k: k != "")
    t = html_escape(col_(title))
    p = col_(persons)
    role_s = F.struct(F.concat(F.lit(C.URI_ROLE), F.lower(role)).alias("uri"),
                      F.struct(capitalize(role).alias("en_GB")).alias("term"))

    def person(x, parts):
        return F.struct(F.lit(C.PERSON_ASSOCIATION_TYPE).alias("typeDiscriminator"),
                        F.struct(F.try_element_at(parts, F.lit(1)).alias("firstName"),
                                 F.array_join(F.slice(parts, 2, 1 << 30), " ").alias("lastName")).alias("name"),
                        role_s.alias("role"),
                        F.struct(F.lit(C.SYSTEM_PERSON).alias("systemName"), x["uuid"].alias("uuid")).alias("person"),
                        # told apart and ordered as text: a struct is compared field by field
                        _org_refs(F.array_distinct(x["affiliations"]["organization_uuid"])).alias("organizations"))

    # the names are split beside the persons, so that a person's struct is built and copied once
    persons_s = F.zip_with(p, F.transform(p["name"], split_ws), person)
    all_orgs = _org_refs(F.sort_array(F.array_distinct(F.flatten(p["affiliations"])["organization_uuid"])))
    country = lookup(col_(language), C.LANGUAGE_TO_COUNTRY)
    coverage = F.struct(
        F.upper(lb["media_type"]).alias("coverageType"),
        F.struct(t.alias("en_GB")).alias("title"),
        F.struct(F.lit(" ").alias("en_GB")).alias("description"),
        col_(url).alias("url"),
        col_(media_name).alias("medium"),
        F.struct(F.concat(F.lit(C.URI_MEDIA_TYPE), F.lower(medium_type)).alias("uri"),
                 F.struct(medium_type.alias("en_GB")).alias("term")).alias("mediaType"),
        F.struct(F.concat(F.lit(C.URI_DEGREE), F.lower(degree)).alias("uri"),
                 F.struct(capitalize(degree).alias("en_GB")).alias("term")).alias("degreeOfRecognition"),
        F.lit("").alias("authorProducer"),
        F.lit("").alias("durationLengthSize"),
        F.date_format(col_(date), "yyyy-MM-dd").alias("date"),
        persons_s.alias("persons"),
        all_orgs.alias("organizations"),
        F.when(country.isNotNull(), F.struct(F.concat(F.lit(C.URI_COUNTRY), country).alias("uri"))).alias("country"))
    return F.struct(
        F.lit(C.PAYLOAD_VERSION).alias("version"),
        F.struct(t.alias("en_GB")).alias("title"),
        F.struct(F.concat(F.lit(C.URI_CLIPPING_TYPE), F.lower(typerole)).alias("uri")).alias("type"),
        F.struct(F.lit(C.VISIBILITY_KEY).alias("key"),
                 F.struct(F.lit(C.VISIBILITY_DESCRIPTION).alias("en_GB")).alias("description")).alias("visibility"),
        F.array(F.struct(F.struct(F.lit(" ").alias("en_GB")).alias("value"),
                         F.struct(F.lit(C.URI_DESCRIPTION).alias("uri"),
                                  F.struct(F.lit(C.DESCRIPTION_TERM).alias("en_GB")).alias("term")).alias("type")))
        .alias("descriptions"),
        F.struct(managing_unit_first(p).alias("uuid"), F.lit(C.SYSTEM_ORGANIZATION).alias("systemName"))
        .alias("managingOrganization"),
        F.array(coverage).alias("mediaCoverages"),
        workflow_struct(col_(faculty)).alias("workflow"),
        # one-element transform: the keywords are stripped once per record
        F.transform(F.array(kw), _keyword_groups)[0].alias("keywordGroups"))


def payload_json(*args, **kw) -> Column:
    return F.to_json(payload(*args, **kw))


# --- XML -----------------------------------------------------------------------------

def record_ids(df: DataFrame, order_cols: list, run_stamp: str, prefix: str = C.RECORD_ID_PREFIX) -> DataFrame:
    """``<prefix>-<i>-<run stamp>`` with ``i`` the 0-based position in the given total order
    (unique, not null): only the order columns are numbered (range-partitioned, no
    single-task window) and the numbers joined back to the records."""
    n = positions(df.select(*order_cols), order_cols=order_cols, out_col="_pos")
    return df.join(n, order_cols).withColumn("record_id", F.concat(
        F.lit(f"{prefix}-"), (F.col("_pos") - 1).cast("string"), F.lit(f"-{run_stamp}"))) \
        .withColumn("record_no", F.col("_pos") - 1).drop("_pos")


def xml_clipping(record_id, title, date, persons, media_name, url, labels,
                 fallback: str = C.FALLBACK_ORG_UUID) -> Column:
    """Struct laid out for Spark's XML writer (``_`` fields are attributes)."""
    lb = col_(labels)
    p = col_(persons)
    attr_org = lambda a: F.struct(a["organization_uuid"].alias("_lookupId"), F.lit(C.XML_ORG_LOOKUP_HINT).alias("_lookupHint"),
                                  F.lit(C.XML_ORIGIN).alias("_origin"))
    person = lambda x: F.struct(
        x["employee_id"].alias("_id"),
        F.struct(x["employee_id"].alias("_lookupId"), F.lit(C.XML_PERSON_LOOKUP_HINT).alias("_lookupHint"),
                 F.lit(C.XML_ORIGIN).alias("_origin")).alias("person"),
        lb["researcher_role"].alias("role"),
        F.struct(F.transform(x["affiliations"], attr_org).alias("organisation")).alias("organisations"))
    kw = F.coalesce(lb["keywords"], F.array().cast("array<string>"))
    day = F.date_format(col_(date), "yyyy-MM-dd")
    ref = F.struct(lb["media_type"].alias("_type"), F.concat(col_(record_id), F.lit("_ref")).alias("_id"),
                   col_(title).alias("title"), day.alias("date"),
                   F.struct(F.transform(p, person).alias("person")).alias("persons"),
                   col_(media_name).alias("medium"),
                   F.when(col_(url) != "", col_(url)).alias("url"),
                   lb["Medium_type"].alias("mediaType"),
                   lb["article_degree"].cast("string").alias("degreeOfRecognition"))
    return F.struct(
        col_(record_id).alias("_id"), lb["typerole"].alias("_type"), F.lit("true").alias("_managedInPure"),
        col_(title).alias("title"), F.lit(" ").alias("description"), day.alias("startDate"),
        F.struct(F.lit(C.XML_ORG_LOOKUP_HINT).alias("_lookupHint"), managing_unit_last(p, fallback).alias("_lookupId"))
        .alias("managedBy"),
        F.when(F.size(kw) > 0, F.struct(kw.alias("keyword"))).alias("keywords"),
        F.lit(C.XML_VISIBILITY).alias("visibility"), F.lit(C.XML_WORKFLOW).alias("workflow"),
        F.struct(ref.alias("mediaReference")).alias("mediaReferences"))


def dedup_clippings(df: DataFrame, title_col: str, persons_col: str, order_col: str) -> DataFrame:
    """Keep the first clipping per (lower title, ordered person ids); a null order is last and of
    rows that tie any one stays. Rows are compared by a digest of title and ids, so that the
    records go through one shuffle, dealt by digest and number: a common key is spread."""
    ids = F.transform(F.col(persons_col), lambda x: x["employee_id"])
    key = F.unhex(F.md5(F.to_json(F.struct(F.lower(title_col).alias("t"), ids.alias("i")))))
    k = df.withColumn("_key", key).withColumn("_at", F.struct(F.col(order_col).isNull().alias("none"), F.col(order_col).alias("no")))
    first = k.groupBy("_key").agg(F.min("_at").alias("_at")).select("_key", F.col("_at.none").alias("_none"), F.coalesce("_at.no", F.lit(0)).alias("_no"))
    k = k.withColumn("_none", F.col("_at.none")).withColumn("_no", F.coalesce("_at.no", F.lit(0))).drop("_at")
    there = ["_key", "_none", "_no"]
    return k.join(first, there, "left_semi").dropDuplicates(there).drop(*there)


def write_xml(clippings: DataFrame, path: str, clipping_col: str = "clipping", compression: str = "none") -> None:
    """Sink: ``<clippings xmlns=...><clipping ...>...</clipping>...</clippings>``."""
    (clippings.select(f"{clipping_col}.*").write.mode("overwrite").format("xml").option("compression", compression)
     .option("rowTag", C.XML_ROW_TAG).option("rootTag", f'{C.XML_ROOT_TAG} xmlns="{C.XML_NAMESPACE}"')
     .save(path))


def read_xml(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.format("xml").option("rowTag", C.XML_ROW_TAG).option("inferSchema", False)
            .option("ignoreNamespace", True).load(path))
