"""Person resolution: fuzzy match to a directory, active affiliations, units.

Directory schema (nested, as delivered by the research-information system)::

    pos INT, uuid STRING, name STRUCT<firstName, lastName>,
    names ARRAY<STRUCT<name: STRUCT<firstName, lastName>>>,
    identifiers ARRAY<STRUCT<id, type: STRUCT<term: STRUCT<en_GB>>>>,
    staffOrganizationAssociations ARRAY<STRUCT<period: STRUCT<startDate, endDate>,
                                               organization: STRUCT<uuid>>>

Organisations: ``uuid, type STRUCT<uri>, name STRUCT<en_GB>``.

Distinct mention strings are matched once across all articles and joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipforge.functions import constants as C
from clipforge.functions.text import org_class, strip_ws
from clipforge.operators.duplicates import keep_first
from clipforge.operators.fuzzy import best_match, fuzzy_pairs
from clipforge.session import written


def _full_name(name: Column) -> Column:
    return strip_ws(F.concat(F.coalesce(name["firstName"], F.lit("")), F.lit(" "),
                             F.coalesce(name["lastName"], F.lit(""))))


def directory_spellings(directory: DataFrame) -> DataFrame:
    """(uuid, pos, spelling): the main name and every alternative name, distinct, non-empty."""
    alts = F.transform(F.coalesce(F.col("names"), F.array()), lambda n: _full_name(n["name"]))
    sp = F.array_distinct(F.concat(F.array(_full_name(F.col("name"))), alts))
    return (directory.select("uuid", "pos", F.explode(sp).alias("spelling"))
            .where(F.col("spelling") != ""))


def employee_id(identifiers) -> Column:
    """Id of the first identifier whose type term is ``Employee ID``."""
    ids = F.filter(F.coalesce(F.col(identifiers) if isinstance(identifiers, str) else identifiers, F.array()),
                   lambda x: x["type"]["term"]["en_GB"] == C.EMPLOYEE_ID_TERM)
    return F.try_element_at(ids, F.lit(1))["id"]


def match_mentions(mentions: DataFrame, directory: DataFrame, mention_col: str = "mention",
                   threshold: int = C.MATCH_THRESHOLD) -> DataFrame:
    """Best directory person per distinct mention (case-insensitive ratio >=
    threshold; ties to the lowest directory position).

    Returns (mention_key, uuid, pos, d, L) with ``mention_key = lower(strip(mention))``.
    """
    keys = mentions.select(F.lower(strip_ws(mention_col)).alias("mention_key")).distinct()
    sp = directory_spellings(directory).withColumn("spelling_key", F.lower("spelling"))
    sp_keys = sp.select("spelling_key").distinct()
    pairs = fuzzy_pairs(keys, sp_keys, "mention_key", "mention_key", "spelling_key", "spelling_key",
                        threshold=threshold)
    per_person = pairs.join(sp.select("spelling_key", "uuid", "pos"), "spelling_key")
    return best_match(per_person, "mention_key", "uuid", rank_cols=["pos"])


def associations(directory: DataFrame) -> DataFrame:
    """(uuid, assoc_no, org_uuid, start_ts, end_ts, malformed) -- dates at midnight,
    a missing end is open (9999-12-31); a start that is missing or no date, and an end that
    is no date, are malformed."""
    a = directory.select("uuid", F.posexplode(F.coalesce("staffOrganizationAssociations", F.array()))
                         .alias("assoc_no", "a"))
    start = F.try_to_timestamp(F.col("a.period.startDate"), F.lit("yyyy-MM-dd")).cast("timestamp_ntz")
    end = F.try_to_timestamp(F.coalesce(F.col("a.period.endDate"), F.lit(C.OPEN_END_DATE)),
                             F.lit("yyyy-MM-dd")).cast("timestamp_ntz")
    return a.select("uuid", "assoc_no", F.col("a.organization.uuid").alias("org_uuid"),
                    start.alias("start_ts"), end.alias("end_ts"), (start.isNull() | end.isNull()).alias("malformed"))


def org_lookup(df: DataFrame, orgs: DataFrame, org_col: str = "org_uuid") -> DataFrame:
    """Add (orgtype, orgname); unknown ids get ``Unknown`` for both."""
    o = orgs.select(F.col("uuid").alias("_org"), org_class(F.col("type.uri")).alias("_type"),
                    F.col("name.en_GB").alias("_name"))
    j = df.join(o, df[org_col] == o["_org"], "left")
    return (j.withColumn("orgtype", F.coalesce("_type", F.lit(C.ORG_UNKNOWN)))
            .withColumn("orgname", F.when(F.col("_org").isNull(), F.lit(C.ORG_UNKNOWN)).otherwise(F.col("_name")))
            .drop("_org", "_type", "_name"))


#: Persons with more periods than this are met through the period index.
MANY_PERIODS = 32
#: Levels of the period index: spans of 1, 2, 4 ... days, up to the whole calendar.
PERIOD_LEVELS = 22
_FIRST_DAY = "0001-01-01"


def _day_no(c) -> Column:
    return F.date_diff(F.col(c).cast("date"), F.lit(_FIRST_DAY).cast("date"))


def _spans(first: Column, last: Column) -> Column:
    """The aligned spans (level, number) that make up the days first .. last, two per level at most.

    Going up a level, an odd first span and an even last span are taken as they are and the
    rest is halved, until nothing is left."""
    step = lambda a, level: F.struct(
        F.shiftright(a["lo"] + 1, 1).alias("lo"), F.shiftright(a["hi"] - 1, 1).alias("hi"),
        F.when(a["lo"] > a["hi"], a["out"]).otherwise(F.concat(
            a["out"],
            F.when((a["lo"] % 2 == 1), F.array(F.struct(level.alias("level"), a["lo"].alias("span")))).otherwise(F.array().cast("array<struct<level:int,span:int>>")),
            F.when((a["hi"] % 2 == 0) & ((a["hi"] > a["lo"]) | (a["lo"] % 2 == 0)), F.array(F.struct(level.alias("level"), a["hi"].alias("span"))))
            .otherwise(F.array().cast("array<struct<level:int,span:int>>")))).alias("out"))
    start = F.struct(first.cast("int").alias("lo"), last.cast("int").alias("hi"), F.array().cast("array<struct<level:int,span:int>>").alias("out"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(PERIOD_LEVELS)), start, step, lambda a: a["out"])


def indexed_periods(probes: DataFrame, periods: DataFrame, person_col: str, ts_col: str) -> DataFrame:
    """Probes joined with the periods (``_person``, start_ts, end_ts) of their person that hold
    their day. A period is cut into aligned spans of days, a probe stands in one span per
    level; both meet in exactly one span, so only pairs that belong together are made, however
    many periods and probes a person has."""
    p = (periods.where("start_ts <= end_ts").withColumn("_s", F.explode(_spans(_day_no("start_ts"), _day_no("end_ts"))))
         .withColumn("_level", F.col("_s.level")).withColumn("_span", F.col("_s.span")).drop("_s"))
    at = probes.where(F.col(ts_col).isNotNull()).withColumn("_level_p", F.explode(F.sequence(F.lit(0), F.lit(PERIOD_LEVELS))))
    at = at.withColumn("_span_p", F.expr(f"shiftright(date_diff(cast(`{ts_col}` as date), date'{_FIRST_DAY}'), _level_p)"))
    return (at.join(p, (F.col(person_col) == F.col("_person")) & (F.col("_level_p") == F.col("_level")) & (F.col("_span_p") == F.col("_span")))
            .drop("_level", "_span", "_level_p", "_span_p"))


def active_affiliations(probes: DataFrame, assocs: DataFrame, person_col: str, ts_col: str) -> DataFrame:
    """Associations of the probe's person whose period holds the probe time:
    ``start <= ts <= end`` (end at midnight, so a time on the last day misses).

    An equi-join on the person with the period as a residual filter; the periods of persons
    with more than ``MANY_PERIODS`` go through :func:`indexed_periods` instead. Malformed
    associations are kept and flagged so the caller can mark the article.
    """
    a = assocs.withColumnRenamed("uuid", "_person")
    many = written(a.where(~F.col("malformed")).groupBy("_person").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > MANY_PERIODS).select("_person"), "many_periods")
    ts = F.col(ts_col)
    holds = (F.col("start_ts") <= ts) & (ts <= F.col("end_ts"))
    if many.isEmpty():
        return probes.join(a, probes[person_col] == a["_person"]).where(F.col("malformed") | holds).drop("_person")
    few = a.where(F.col("malformed")).unionByName(a.where(~F.col("malformed")).join(many, "_person", "left_anti").select(*a.columns))
    plain = probes.join(few, probes[person_col] == few["_person"]).where(F.col("malformed") | holds).drop("_person")
    hot = a.where(~F.col("malformed")).join(many, "_person", "left_semi")
    of_hot = probes.join(many, probes[person_col] == many["_person"], "left_semi")
    return plain.unionByName(indexed_periods(of_hot, hot, person_col, ts_col).where(holds).drop("_person").select(*plain.columns))


def resolve_mentions(article_mentions: DataFrame, directory: DataFrame, orgs: DataFrame,
                     article_col: str = "article_id", mention_col: str = "mention",
                     pos_col: str = "mention_pos", ts_col: str = "ts",
                     threshold: int = C.MATCH_THRESHOLD) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Resolve each (article, mention) to (employee id, uuid, active affiliations).

    Returns ``(resolved, unresolved, errors)``:

    * resolved -- one row per kept person: article, mention_pos, mention,
      employee_id, uuid, affiliations ARRAY<STRUCT<organization_uuid, orgtype,
      orgname>> (association order), malformed; persons with the same employee id
      and affiliation set are kept once per article (first mention wins);
    * unresolved -- article, mention_pos, mention for mentions without a match,
      without an employee id, or without an active affiliation;
    * errors -- articles where a matched person has an association without a
      valid start or with an end that is no date (the whole article is an ``error``).
    """
    m = article_mentions.select(F.col(article_col).alias("article_id"), F.col(pos_col).alias("mention_pos"),
                                F.col(mention_col).alias("mention"), F.col(ts_col).alias("ts"),
                                F.lower(strip_ws(mention_col)).alias("mention_key"))
    # read by the resolved, unresolved and error outputs: matched once, stored
    best = written(match_mentions(m.select("mention"), directory, "mention", threshold), "match")
    people = best.select("mention_key", "uuid").join(directory.select("uuid", employee_id("identifiers").alias("employee_id")), "uuid")
    people = written(people.where(F.col("employee_id").isNotNull()), "people")
    with_id = written(m.join(people, "mention_key"), "matched")
    # the periods of matched persons only; their dates are parsed once
    periods = associations(directory.join(people.select("uuid"), "uuid", "left_semi"))
    affs = active_affiliations(with_id.select("article_id", "mention_pos", "uuid", "ts"),
                               written(periods, "periods"), "uuid", "ts")
    affs = org_lookup(affs, orgs)
    good = F.when(~F.col("malformed"), F.struct("assoc_no", "org_uuid", "orgtype", "orgname"))
    per_mention = affs.groupBy("article_id", "mention_pos").agg(
        F.array_sort(F.collect_list(good)).alias("_a"),
        F.max(F.col("malformed").cast("int")).cast("boolean").alias("malformed"))
    aff_arr = F.transform("_a", lambda x: F.struct(x["org_uuid"].alias("organization_uuid"),
                                                   x["orgtype"].alias("orgtype"), x["orgname"].alias("orgname")))
    per_mention = per_mention.select("article_id", "mention_pos", aff_arr.alias("affiliations"), "malformed")
    cand = with_id.join(per_mention, ["article_id", "mention_pos"], "left")
    ok = cand.where(F.size(F.coalesce("affiliations", F.array())) > 0)
    # affiliation sets are compared by a digest, so the lists are no keys of shuffles
    ok = ok.withColumn("_aff_key", F.unhex(F.md5(F.to_json(F.array_sort("affiliations")))))
    # read by the first mentions, the kept ones and the unresolved
    ok = written(ok.select("article_id", "employee_id", "_aff_key", "mention_pos", "mention", "uuid",
                           "affiliations", "malformed"), "resolved")
    kept = keep_first(ok, key_cols=["article_id", "employee_id", "_aff_key"], order_col="mention_pos").drop("_aff_key")
    unresolved = m.join(ok.select("article_id", "mention_pos"), ["article_id", "mention_pos"], "left_anti") \
        .select("article_id", "mention_pos", "mention")
    errors = per_mention.where(F.col("malformed")).select("article_id").distinct()
    return kept, unresolved, errors


def nest_resolved(resolved: DataFrame) -> DataFrame:
    """Per article: ``persons`` ARRAY<STRUCT<employee_id, uuid, name, affiliations>>
    in mention order, plus ``malformed`` (any person with a malformed period)."""
    s = F.struct("mention_pos", "employee_id", "uuid", F.col("mention").alias("name"), "affiliations")
    g = resolved.groupBy("article_id").agg(F.array_sort(F.collect_list(s)).alias("_p"),
                                           F.max(F.col("malformed").cast("int")).cast("boolean").alias("malformed"))
    persons = F.transform("_p", lambda x: F.struct(x["employee_id"].alias("employee_id"), x["uuid"].alias("uuid"),
                                                   x["name"].alias("name"), x["affiliations"].alias("affiliations")))
    return g.select("article_id", persons.alias("persons"), F.coalesce("malformed", F.lit(False)).alias("malformed"))
