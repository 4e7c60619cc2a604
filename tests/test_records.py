import datetime as dt
import json

from pyspark.sql import functions as F

from clipforge.operators.labels import fixed_labels, normalise_labels, parse_response
from clipforge.operators.records import managing_unit_first, managing_unit_last, payload_json, write_xml, \
    xml_clipping, read_xml

P = ("array<struct<employee_id:string,uuid:string,name:string,"
     "affiliations:array<struct<organization_uuid:string,orgtype:string,orgname:string>>>>")


def persons():
    a = lambda u, t: {"organization_uuid": u, "orgtype": t, "orgname": u.upper()}
    return [{"employee_id": "E1", "uuid": "p1", "name": "Dina Siegel", "affiliations": [a("d1", "dep/fac"), a("o1", "Organization")]},
            {"employee_id": "E2", "uuid": "p2", "name": "Jan de Vries", "affiliations": [a("o2", "Organization"), a("o2", "Organization")]},
            {"employee_id": "E3", "uuid": "p3", "name": "Piet", "affiliations": [a("r1", "Research organization")]}]


def test_managing_units(spark):
    df = spark.createDataFrame([(persons(),), ([],)], f"p {P}")
    got = df.select(managing_unit_first("p").alias("f"), managing_unit_last("p").alias("l")).collect()
    assert (got[0].f, got[0].l) == ("o1", "o2")
    assert (got[1].f, got[1].l) == ("UNKNOWN", "UNKNOWN")


def test_payload(spark):
    df = spark.createDataFrame([("A & B", "", dt.datetime(2025, 3, 12, 8, 30), persons(), "Daily", "BETA", "nl"),
                                ("C", "u", dt.datetime(2025, 3, 12), persons()[:1], "Daily", None, "en")],
                               f"t string, u string, ts timestamp_ntz, p {P}, m string, f string, lang string")
    lab = fixed_labels(F.array(F.lit(" kw "), F.lit(" ")))
    rows = [json.loads(r.j) for r in df.select(payload_json("t", "u", "ts", "p", "m", "f", "lang", lab).alias("j")).collect()]
    a, b = rows
    assert a["title"]["en_GB"] == "A &amp; B" and a["workflow"]["step"] == "forApproval"
    assert b["workflow"]["step"] == "approved" and "country" not in b["mediaCoverages"][0]
    assert a["mediaCoverages"][0]["country"]["uri"].endswith("/nl")
    cov = a["mediaCoverages"][0]
    assert [x["uuid"] for x in cov["persons"][1]["organizations"]] == ["o2"]      # distinct within a person
    assert cov["persons"][1]["name"] == {"firstName": "Jan", "lastName": "de Vries"}
    assert a["managingOrganization"]["uuid"] == "o1"
    assert a["keywordGroups"][1]["keywords"][0]["freeKeywords"] == ["kw"]
    assert cov["date"] == "2025-03-12" and cov["coverageType"] == "CONTRIBUTION"


def test_labels(spark):
    df = spark.createDataFrame([('{"researcher_role": "research cited", "typerole": "expert comment"}',),
                                ("not json",), ('{"researcher_role": "boss", "keywords": ["a"]}',)], "r string")
    got = df.select(normalise_labels(parse_response("r")).alias("l")).select("l.*").collect()
    assert (got[0].researcher_role, got[0].media_type, got[0].typerole) == ("researchcited", "Coverage", "exportcomment")
    assert (got[1].researcher_role, got[1].typerole, got[1].Medium_type, got[1].article_degree) == \
        ("participant", "other", "Web", "national")
    assert got[2].keywords == ["a"] and got[2].researcher_role == "participant"


def test_xml_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("K-0-x", "Title", dt.datetime(2025, 3, 12), persons(), "Daily", "")],
                               f"id string, t string, ts timestamp_ntz, p {P}, m string, u string")
    lab = fixed_labels(F.array(F.lit("kw")))
    clip = df.select(xml_clipping("id", "t", "ts", "p", "m", "u", lab).alias("clipping"))
    write_xml(clip, str(tmp_path / "x"))
    text = "".join(p.read_text() for p in (tmp_path / "x").glob("part-*"))
    assert 'xmlns="v1.unified.clipping.pure.atira.dk"' in text and "<url>" not in text
    back = read_xml(spark, str(tmp_path / "x")).first()
    assert back["_id"] == "K-0-x" and back["managedBy"]["_lookupId"] == "o2"


def test_xml_files_can_be_gzipped(spark, tmp_path):
    df = spark.createDataFrame([("K-0-x", "Title", dt.datetime(2025, 3, 12), persons(), "Daily", "")],
                               f"id string, t string, ts timestamp_ntz, p {P}, m string, u string")
    clip = df.select(xml_clipping("id", "t", "ts", "p", "m", "u", fixed_labels(F.array(F.lit("kw")))).alias("clipping"))
    write_xml(clip, str(tmp_path / "x"), compression="gzip")
    assert {p.suffix for p in (tmp_path / "x").glob("part-*")} == {".gz"}
    assert read_xml(spark, str(tmp_path / "x")).first()["_id"] == "K-0-x"


def test_articles_of_xml_records_hold_what_is_written_only(spark, tmp_path):
    """Narrow persons give the same clippings; shuffle files go with the write they were for."""
    import pathlib

    from clipforge.plans.outputs import order_articles
    from clipforge.session import shuffles_dropped
    from clipforge.sources.tables import TABLES
    make = lambda rows, schema: spark.createDataFrame(rows, schema)
    held = {"region": make([(0, "AFRICA"), (1, "ASIA")], "r_regionkey int, r_name string"),
            "nation": make([(0, "KENYA", 0), (1, "CHINA", 1), (1, "CINA", 1)], "n_nationkey int, n_name string, n_regionkey int"),
            "customer": make([(1, 0, "BUILDING"), (2, 1, "AUTO")], "c_custkey int, c_nationkey int, c_mktsegment string"),
            "supplier": make([(1, "Supplier#1", 1), (2, "Supplier#2", 0), (2, "Another", 1), (3, "Supplier#3", None)], "s_suppkey int, s_name string, s_nationkey int"),
            "orders": make([(10, 1, "1-URGENT", "O", "2024-01-02"), (11, 2, "5-LOW", "P", None), (11, 1, "5-LOW", "P", None), (12, 2, "5-LOW", "F", "2024-01-03")],
                           "o_orderkey int, o_custkey int, o_orderpriority string, o_orderstatus string, o_orderdate string").withColumn("o_orderdate", F.to_date("o_orderdate")),
            "lineitem": make([(10, 1, 1), (10, 2, 2), (11, 1, 2), (11, 1, 3), (12, 2, 1), (12, 1, 2), (12, 1, 2)], "l_orderkey int, l_linenumber int, l_suppkey int")}
    t = type("Given", (), {x: held.get(x) for x in TABLES})()
    less, full = order_articles(t, whole=False), order_articles(t)
    assert less.select("persons").schema["persons"].dataType.elementType.names == ["employee_id", "affiliations"]
    clip = lambda a: sorted(str(r) for r in a.select(xml_clipping(F.col("o_orderkey").cast("string"), "title", "ts", "persons", "media_name", "url", "labels")).collect())
    assert clip(less) == clip(full) and len(clip(full)) >= 4
    key, places = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    files = lambda: {str(x) for d in places for x in pathlib.Path(d.getPath()).rglob("shuffle_*.data")}
    before = spark.conf.get(key, None)
    seen = files()
    with shuffles_dropped(spark):
        spark.range(1000).repartition(7).write.parquet(str(tmp_path / "a"))
    assert not files() - seen and spark.conf.get(key, None) == before
    spark.range(1000).repartition(7).write.parquet(str(tmp_path / "b"))
    assert files() - seen and spark.read.parquet(str(tmp_path / "a")).count() == 1000
