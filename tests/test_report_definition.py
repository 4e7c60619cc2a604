import json

import pytest

from clipforge.operators.hierarchy import unit_closure
from clipforge.operators.report_definition import grouped_persons, parse_definition, read_definition, related_units
from clipforge.plans.reports import REPORT_JSON, ROSTER_XML

PERIOD = ("2024-01-01", "2024-12-31")


def tables(spark):
    persons = spark.createDataFrame([(1, "Ann", "A"), (2, "Bob", "B"), (3, "Cy", "C"), (4, "Di", "D")], "person_id int, name string, last_name string")
    member = spark.createDataFrame(
        [(1, "N1", "2020-01-01", None), (1, "N2", "2020-01-01", None), (1, "N3", "2020-01-01", None), (2, "N1", "2020-01-01", "2023-12-31"),
         (2, "N9", "2020-01-01", None), (3, "N1", "2024-05-01", "2024-05-02"), (3, "N1", "2024-07-01", None), (None, "N1", "2020-01-01", None),
         (4, None, "2020-01-01", None)],
        "person_id int, unit_id string, start_ts string, end_ts string").selectExpr(
        "person_id", "unit_id", "cast(start_ts as timestamp_ntz) start_ts", "cast(end_ts as timestamp_ntz) end_ts")
    units = spark.createDataFrame([("R1", "East", "t3"), ("N1", "b", "t4"), ("N2", "a", "t4"), ("N3", "c", "t5"), ("N9", "z", "t4"), ("R9", "West", "t5")],
                                  "unit_id string, unit_name string, type_uri string")
    edges = spark.createDataFrame([("N1", "R1"), ("N2", "R1"), ("N3", "R1"), ("N9", "R9")], "child string, parent string")
    return persons, member, units, unit_closure(spark, edges), PERIOD


def changed(**types):
    d = json.loads(REPORT_JSON)
    for s in d["serializedReport"]["dataSets"][0]["series"][1:]:
        s["filters"][0]["selectMany"].update(types.get(s["id"], {}))
    return json.dumps(d)


def test_series_of_units(spark):
    rows = lambda text: sorted((r.person_id, r.units, r.ascendants) for r in related_units(parse_definition(text), *tables(spark)).collect())
    assert rows(changed(s2={"values": []})) == [(1, "a // b", "East"), (3, "b", "East")]  # cap of two, two periods one unit
    assert rows(changed(s2={"values": ["t5"]})) == []
    assert rows(changed(s2={"values": ["t5"], "mode": "KEEP"})) == [(1, "a // b", None), (3, "b", None)]
    assert rows(changed(s1={"values": ["t5"]}, s2={"values": ["t3"]})) == [(1, "c", "East")]


def test_roster(spark):
    run = lambda text: [(r.unit_name, r.name) for r in grouped_persons(parse_definition(text), *tables(spark)).collect()]
    assert run(ROSTER_XML) == [("a", "Ann"), ("b", "Cy"), ("b", "Ann"), ("c", "Ann")]
    assert run(ROSTER_XML.replace(">true<", ">false<")) == [("a", "Ann"), ("b", "Ann"), ("b", "Cy"), ("c", "Ann")]
    assert run(ROSTER_XML.replace("RecursiveContentValueAggregator", "Own")) == []
    assert run(ROSTER_XML.replace("INNER", "LEFT"))[:2] == [(None, "Di"), (None, "Bob")]


def test_files_and_what_is_not_known(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(json.loads(REPORT_JSON), indent=2))
    (tmp_path / "b.xml").write_text('<?xml version="1.0"?>\n' + ROSTER_XML)
    assert read_definition(spark, str(tmp_path / "a.json")) == parse_definition(REPORT_JSON)
    assert read_definition(spark, str(tmp_path / "b.xml")).roots == ["R0", "R1", "R2"]
    for text in (REPORT_JSON.replace("Organisation.ascendants", "Organisation.siblings"), REPORT_JSON.replace("filter(type)", "filter(size)"),
                 ROSTER_XML.replace("personOrderByLastName", "byAge"), ROSTER_XML.replace(">active<", ">former<")):
        with pytest.raises(ValueError, match="is not known"):
            parse_definition(text)
