"""Hierarchy reports from their exported definitions.

Two forms are read. A JSON definition names a driver series (persons at a unit, units below
included) and related series (units a person belongs to, ascendants of those), each with a
type filter, a cap and a delimiter: :func:`related_units`. An XML definition lists persons
grouped by unit below several roots: :func:`grouped_persons`. What a definition holds beyond
that is refused by name, so a report is never silently wider than it was asked for.

A definition is a small settings file; persons, memberships, units and the closure are
tables and meet by equi-joins.
"""

from __future__ import annotations

import json
import xml.etree.ElementTree as ET
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipforge.operators.hierarchy import active_memberships, capped_join, units_below

# FIXED VALUES: identifiers in exported report definitions.
PERSON, UNIT = "Person", "Organisation"
PERSON_NAME, UNIT_NAME = "Person.project(name)", "Organisation.project(name)"
AT_UNIT, UNIT_TYPE = "Person.filter(activeAcademicStaffAtOrganisation)", "Organisation.filter(type)"
MEMBER_OF, ASCENDANTS = "Person.currentlyAffiliatedWith(Organisation)", "Organisation.ascendants(Organisation)"
ELIMINATE, MATCH = "ELIMINATE_ROWS", "MATCH"
GROUP_PATH, BY_LAST_NAME = "organisationAssociations.organisation", "personOrderByLastName"
UNIT_FILTER, RECURSIVE, ACTIVE = "organisationalUnitReportFilter", "RecursiveContentValueAggregator", "active"


@dataclass
class Series:
    """A column of related units: of the persons themselves, or ascendants of another series."""
    name: str
    parent: str | None
    label: str
    types: list = field(default_factory=list)
    drop_unmatched: bool = False
    cap: int | None = None
    delimiter: str = ", "


@dataclass
class Definition:
    title: str
    roots: list
    below: bool
    active: bool
    series: list = field(default_factory=list)
    grouped: bool = False
    inner: bool = True
    by_last_name: bool = False
    descending: bool = False


def _known(what: str, value, *allowed):
    if value not in allowed:
        raise ValueError(f"report definition: {what} {value!r} is not known")
    return value


def _json_series(raw: dict, number: int, ids: dict) -> Series:
    _known("series", raw["systemName"], UNIT)
    relation = raw["driverRelation"]
    kind = _known("relation", relation["semanticRelationshipId"], MEMBER_OF, ASCENDANTS)
    parent = relation["driverSeriesId"]
    if parent not in ids or (kind == MEMBER_OF) != (ids[parent] is None):
        raise ValueError(f"report definition: relation {kind!r} of series {parent!r}")
    out = Series(raw["id"], None if kind == MEMBER_OF else parent, f"series_{number}")
    for f in raw.get("functions", []):
        _known("function", f["functionId"], UNIT_NAME)
        out.label = f.get("customLabel") or out.label
        out.cap = f.get("emission", {}).get("sampleSize")
        out.delimiter = f.get("emission", {}).get("delimiter", out.delimiter)
    for f in raw.get("filters", []):
        _known("filter", f["filterId"], UNIT_TYPE)
        many = f["selectMany"]
        _known("limitation", many.get("limitationType", MATCH), MATCH)
        out.types += many.get("values", [])
        out.drop_unmatched |= many.get("mode") == ELIMINATE
    return out


def _from_json(text: str) -> Definition:
    report = json.loads(text)
    series = [s for table in report["serializedReport"]["dataSets"] for s in table["series"]]
    drivers = [s for s in series if "driverRelation" not in s]
    if len(drivers) != 1:
        raise ValueError("report definition: one driver series expected")
    driver = drivers[0]
    _known("driver series", driver["systemName"], PERSON)
    for f in driver.get("functions", []):
        _known("function", f["functionId"], PERSON_NAME)
    out = Definition(report.get("title", ""), [], False, True)
    for f in driver.get("filters", []):
        _known("filter", f["filterId"], AT_UNIT)
        _known("limitation", f["hierarchicalContent"].get("limitationType", MATCH), MATCH)
        out.roots += f["hierarchicalContent"]["ids"]
        out.below |= bool(f["hierarchicalContent"].get("includeUnitsBelow"))
    ids = {driver["id"]: None}
    for number, raw in enumerate((s for s in series if s is not driver), 1):
        out.series.append(_json_series(raw, number, ids))
        ids[raw["id"]] = out.series[-1]
    return out


def _from_xml(text: str) -> Definition:
    root = ET.fromstring(text)
    group, order = root.find(".//groupings/group"), root.find(".//orderByConfiguration")
    out = Definition(root.findtext("basicTitle") or "", [], False, False)
    if group is not None:
        _known("grouping", group.get("recPropertyPath"), GROUP_PATH)
        out.grouped, out.inner = True, _known("join", group.findtext("joinBehavior"), "INNER", "LEFT") == "INNER"
    if order is not None:
        out.by_last_name = bool(_known("order", order.get("id"), BY_LAST_NAME))
        out.descending = root.findtext(".//applyOrderbyConfigurationAsDescending") == "true"
    for f in root.iterfind(".//reportFilter"):
        values = {p.get("name"): [v.text for v in p.iterfind(".//value")] for p in f.iterfind("property")}
        if f.get("id") == UNIT_FILTER:
            out.roots += values.get("organisationIds", [])
            out.below |= values.get("organisationValueAggregator") == [RECURSIVE]
        else:
            _known("filter", f.get("type"), "contentPropertyReportFilter")
            out.active = _known("period", *values["limit"], ACTIVE) == ACTIVE
    return out


def parse_definition(text: str) -> Definition:
    """A definition from its JSON or XML text; ``ValueError`` names what is not known."""
    return _from_xml(text) if text.lstrip("\ufeff \t\r\n").startswith("<") else _from_json(text)


def read_definition(spark: SparkSession, path: str) -> Definition:
    """The definition in one file of any store that Spark reads."""
    return parse_definition(spark.read.text(path, wholetext=True).first()["value"])


def _at_roots(d: Definition, memberships: DataFrame, closure: DataFrame) -> DataFrame:
    """Memberships at the definition's units; all where it names none."""
    if not d.roots:
        return memberships
    if not d.below:
        return memberships.where(F.col("unit_id").isin([str(r) for r in d.roots]))
    at = units_below(closure, d.roots)
    return memberships.join(at, memberships.unit_id == at.unit, "left_semi")


def _current(d: Definition, memberships: DataFrame, period) -> DataFrame:
    now = active_memberships(memberships, *period) if d.active else memberships
    return now.select("person_id", "unit_id").where("person_id is not null and unit_id is not null").distinct()


def related_units(d: Definition, persons: DataFrame, memberships: DataFrame, units: DataFrame,
                  closure: DataFrame, period: tuple) -> DataFrame:
    """Persons at the definition's units, with a column of joined unit names per series.

    persons (person_id, ...); memberships (person_id, unit_id, start_ts, end_ts); units
    (unit_id, unit_name, type_uri); closure from ``unit_closure``; ``period`` is what *active*
    means. A series keeps units of its types (all without types); names are distinct, sorted,
    cut to the cap and joined. A person without a unit in a series goes if that series
    eliminates rows, else the column is null. An ascendant series starts from the units its
    parent series kept.
    """
    now = _current(d, memberships, period)
    there = _at_roots(d, now, closure).select("person_id").distinct()
    pairs, out = {}, persons.join(there, "person_id", "left_semi")
    for s in d.series:
        if s.parent is None:
            p = now.join(there, "person_id", "left_semi")
        else:
            p = (pairs[s.parent].join(closure.select(F.col("unit").alias("unit_id"), "ancestor"), "unit_id")
                 .select("person_id", F.col("ancestor").alias("unit_id")).distinct())
        named = p.join(units.select("unit_id", "unit_name", "type_uri"), "unit_id")
        if s.types:
            named = named.where(F.col("type_uri").isin(s.types))
        pairs[s.name] = named.select("person_id", "unit_id")
        cell = named.groupBy("person_id").agg(capped_join(F.col("unit_name"), s.cap, s.delimiter).alias(s.label))
        out = out.join(cell, "person_id", "inner" if s.drop_unmatched else "left")
    return out


def grouped_persons(d: Definition, persons: DataFrame, memberships: DataFrame, units: DataFrame,
                    closure: DataFrame, period: tuple, last_name_col: str = "last_name") -> DataFrame:
    """Persons by the units of their memberships at the definition's roots, a row per person
    and unit, ordered by unit and, where the definition says so, last name. With an INNER
    grouping a person without such a unit has no row, else one row without a unit."""
    m = _at_roots(d, _current(d, memberships, period), closure).join(units, "unit_id")
    rows = m.join(persons, "person_id", "inner" if d.inner else "right")
    name = F.desc(last_name_col) if d.descending else F.asc(last_name_col)
    return rows.orderBy("unit_name", *([name] if d.by_last_name else []), "person_id")
