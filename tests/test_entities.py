import datetime as dt

from clipforge.operators.entities import resolve_mentions

DIR_SCHEMA = ("pos int, uuid string, name struct<firstName:string,lastName:string>, "
              "names array<struct<name:struct<firstName:string,lastName:string>>>, "
              "identifiers array<struct<id:string,type:struct<term:struct<en_GB:string>>>>, "
              "staffOrganizationAssociations array<struct<period:struct<startDate:string,endDate:string>,"
              "organization:struct<uuid:string>>>")


def emp(i):
    return [(i, ("Employee ID",))] if False else [{"id": i, "type": {"term": {"en_GB": "Employee ID"}}}]


def assoc(start, end, org):
    return {"period": {"startDate": start, "endDate": end}, "organization": {"uuid": org}}


def directory(spark):
    rows = [
        (0, "u-dina", {"firstName": "Dina", "lastName": "Siegel"}, [], emp("E1"),
         [assoc("2020-01-01", "2025-03-12", "o1"), assoc("2024-01-01", None, "o2")]),
        (1, "u-jan", {"firstName": "Johannes", "lastName": "Vries"},
         [{"name": {"firstName": "Jan", "lastName": "de Vries"}}], emp("E2"), [assoc("2025-03-12", None, "o1")]),
        (2, "u-noid", {"firstName": "Piet", "lastName": "Jansen"}, [], [], [assoc("2020-01-01", None, "o1")]),
        (3, "u-bad", {"firstName": "Kees", "lastName": "Bakker"}, [], emp("E4"), [assoc(None, None, "o1")]),
        (4, "u-dina2", {"firstName": "Dina", "lastName": "Siegel"}, [], emp("E5"), [assoc("2020-01-01", None, "o1")]),
    ]
    return spark.createDataFrame(rows, DIR_SCHEMA)


def orgs(spark):
    base = "/dk/atira/pure/organisation/organisationtypes/organisation/"
    return spark.createDataFrame([("o1", {"uri": base + "003"}, {"en_GB": "Geo"}),
                                  ("o2", {"uri": base + "005"}, {"en_GB": "Univ"})],
                                 "uuid string, type struct<uri:string>, name struct<en_GB:string>")


def test_resolution(spark):
    ts1 = dt.datetime(2025, 3, 12, 0, 0)    # last day of o1 at 00:00: active
    ts2 = dt.datetime(2025, 3, 12, 8, 30)   # last day 08:30: o1 period over
    m = spark.createDataFrame([
        (1, 0, "dina siegel", ts1), (1, 1, "Jan de Vries", ts1), (1, 2, "Piet Jansen", ts1),
        (2, 0, "Dina Siegel", ts2), (2, 1, "Kees Bakker", ts2), (2, 2, "Nobody Here", ts2)],
        "article_id long, mention_pos int, mention string, ts timestamp_ntz")
    kept, unresolved, errors = resolve_mentions(m, directory(spark), orgs(spark))
    k = {(r.article_id, r.mention_pos): r for r in kept.collect()}
    # tie between u-dina and u-dina2: the lower directory position wins
    assert k[(1, 0)].uuid == "u-dina" and [a.organization_uuid for a in k[(1, 0)].affiliations] == ["o1", "o2"]
    assert k[(1, 1)].employee_id == "E2"                      # matched by the alternative name, first day
    assert (1, 2) not in k                                   # no Employee ID
    assert [a.organization_uuid for a in k[(2, 0)].affiliations] == ["o2"]
    assert {(r.article_id, r.mention_pos) for r in unresolved.collect()} == {(1, 2), (2, 1), (2, 2)}
    assert [r.article_id for r in errors.collect()] == [2]    # Kees Bakker: association without start


def test_malformed_end_is_an_error(spark):
    ts = dt.datetime(2025, 3, 12, 8, 30)
    rows = [(0, "u", {"firstName": "Kees", "lastName": "Bakker"}, [], emp("E4"), [assoc("2020-01-01", "31-12-2025", "o1")]),
            (1, "v", {"firstName": None, "lastName": None}, [{"name": {"firstName": "Anna", "lastName": "Smit"}}], emp("E5"), [assoc("2020-01-01", "2030-01-01", "o1")])]
    m = spark.createDataFrame([(1, 0, "Kees Bakker", ts), (2, 0, "Anna Smit", ts)], "article_id long, mention_pos int, mention string, ts timestamp_ntz")
    kept, _, errors = resolve_mentions(m, spark.createDataFrame(rows, DIR_SCHEMA), orgs(spark))
    assert [r.article_id for r in errors.collect()] == [1]
    assert [r.uuid for r in kept.collect()] == ["v"]
