"""Plans that decide how a query grows: what is shuffled, read or derived more than once."""

import re

from pyspark.sql import functions as F

from clipforge.operators.entities import resolve_mentions
from clipforge.operators.keywords import keyword_candidates
from clipforge.operators.mentions import clean_mentions, clean_name
from clipforge.plans.entities import _directory
from clipforge.plans.outputs import order_articles, q_payload_json
from clipforge.sources.tables import Tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keywords_deal_texts_not_words(spark):
    docs = spark.createDataFrame([(1, "Big blue bird. Big bird"), (None, "x y")], "doc_id long, text string")
    c = keyword_candidates(docs, "doc_id", "text", spark.createDataFrame([("blue",)], "word string"))
    assert not re.search(r"hashpartitioning\(_id#\d+L?, (w|phrase)#", plan(c))
    assert {r.phrase for r in c.collect()} == {"big", "bird", "big blue bird", "big bird"}


def test_mentions_are_cleaned_once(spark):
    rows = [(1, ["Jan Smit", " ###Jan", "Smit", "Universiteit", "###", "Piet Utrecht ", "a"]), (2, ["Jan"])]
    got = clean_mentions(spark.createDataFrame(rows, "id long, names array<string>"), "id", "names", patterns=[r"\bUtrecht\b", "^###"])
    assert got.inputFiles() and all("/cleaned-" in f for f in got.inputFiles())
    assert {(r.id, r.mention) for r in got.collect()} == {(1, "Jan Smit"), (1, "Universiteit"), (1, "Piet"), (1, "a"), (2, "Jan")}


def test_names_without_terms_are_stripped_too(spark):
    names = spark.createDataFrame([(" ##x  y ",), ("\u00a0x\ty",), ("Utrechtse",), ("#x",)], "n string")
    assert [r[0] for r in names.select(clean_name("n", [r"\bUtrecht\b", "^##"])).collect()] == ["x y", "x y", "Utrechtse", "#x"]


def test_directory_reads_the_texts_once(spark, tmp_path):
    rows = [(5, "src1", "en", "Cat dog"), (3, "src0", "es", "cat"), (9, None, "en", "cat")]
    spark.createDataFrame(rows, "doc_id long, source string, lang string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    d = _directory(Tables(spark, str(tmp_path)))
    assert plan(d).count("FileScan parquet") == 1
    cat = d.where("uuid = 'cat'").collect()[0]
    assert cat.pos == 3 and cat.identifiers[0].id == "E5" and [a.organization.uuid for a in cat.staffOrganizationAssociations] == [None, "src0", "src1"]


def test_periods_are_parsed_once(spark, tmp_path):
    spark.createDataFrame([(1, "src0", "en", "cat dog")], "doc_id long, source string, lang string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    m = spark.createDataFrame([(7, 0, "Cat"), (7, 1, "cat"), (7, 2, "owl")], "article_id long, mention_pos long, mention string") \
        .withColumn("ts", F.lit("2000-03-01 08:30:00").cast("timestamp_ntz"))
    orgs = spark.createDataFrame([("src0", ("x/r01",), ("SRC0",))], "uuid string, type struct<uri:string>, name struct<en_GB:string>")
    kept, unresolved, _ = resolve_mentions(m, _directory(Tables(spark, str(tmp_path))), orgs)
    assert all("/resolved-" in f for f in kept.inputFiles()) and any("/resolved-" in f for f in unresolved.inputFiles())
    assert [(r.mention_pos, r.employee_id, r.affiliations[0].orgname) for r in kept.collect()] == [(0, "E1", "SRC0")]
    assert [r.mention for r in unresolved.collect()] == ["owl"]


def _order_tables(spark, folder):
    put = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    put("region", [(0, "AFRICA"), (1, "EUROPE")], "r_regionkey int, r_name string")
    put("nation", [(5, "N5", 0), (6, "N6", 1)], "n_nationkey int, n_name string, n_regionkey int")
    put("customer", [(1, 5, "BUILDING"), (2, 6, "AUTO")], "c_custkey long, c_nationkey int, c_mktsegment string")
    put("supplier", [(7, "Supplier  7", 6), (8, None, 5), (9, " S 9 x ", None)], "s_suppkey long, s_name string, s_nationkey int")
    put("orders", [(10, 1, "O", "1-URGENT"), (11, 2, "P", "5-LOW"), (11, 1, "P", "5-LOW")],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string")
    put("lineitem", [(10, 2, 7), (10, 1, 9), (10, 1, 8), (11, 1, 7), (11, 1, 7)], "l_orderkey long, l_linenumber int, l_suppkey long")
    dated = spark.read.parquet(f"{folder}/orders.parquet").withColumn("o_orderdate", F.lit("2000-03-01").cast("date"))
    return type("T", (), {n: dated if n == "orders" else spark.read.parquet(f"{folder}/{n}.parquet") for n in (
        "region", "nation", "customer", "supplier", "orders", "lineitem")})


def test_persons_of_an_order_with_one_unit_and_with_several(spark, tmp_path):
    got = order_articles(_order_tables(spark, tmp_path)).collect()
    seen = {(r.o_orderkey, r.media_name): [(p.employee_id, p.name, [a.organization_uuid for a in p.affiliations]) for p in r.persons] for r in got}
    several = [("S7", "Dr Supplier  7", ["6", "5"])] * 2 + [("S7", "Dr Supplier  7", ["6", "6"])] * 2   # lines that tie are mixed by unit
    assert seen == {(10, "BUILDING"): [("S8", None, ["5", "5"]), ("S9", "Dr  S 9 x ", [None, "5"]), ("S7", "Dr Supplier  7", ["6", "5"])],
                    (11, "AUTO"): several, (11, "BUILDING"): several}


def test_records_are_written_and_parsed_apart(spark, tmp_path):
    t = _order_tables(spark, tmp_path)
    t.orders.write.mode("overwrite").parquet(str(tmp_path / "dated/orders.parquet"))
    for n in ("region", "nation", "customer", "supplier", "lineitem"):
        getattr(t, n).write.parquet(str(tmp_path / f"dated/{n}.parquet"))
    df = q_payload_json(spark, str(tmp_path / "dated"))
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    # in one projection all of it would be interpreted; a comparison by lambda would order the persons
    assert not any("from_json" in x and ("evaluate" in x or "to_json" in x) for x in lines)
    assert not any("array_sort" in x for x in lines)
    row = df.where("o_orderkey = 10").first()
    assert row.persons == "supp-8|5;Dr|S 9 x|supp-9|5;Dr|Supplier 7|supp-7|6,5"
    assert (row.n_persons, row.n_orgs, row.organizations, row.managing, row.keywords) == (3, 3, "5,6", "5", "1-URGENT|O")
    assert row.role_uri == "/dk/atira/pure/clipping/roles/clipping/interviewee"
