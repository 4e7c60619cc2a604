import json

from clipforge.operators.language import language_profile
from clipforge.plans.clipping_run import process_mails
from tests.test_entities import directory, orgs
from tests.test_mail import HTML, write_mail

PUB = ("uuid string, title struct<text:array<struct<value:string>>>, period struct<startDate:string>, "
       "personAssociations array<struct<person:struct<externalId:string,internalId:string>>>")


def profile(spark):
    train = spark.createDataFrame([("en", "the title of the text is the news of today and this week"),
                                   ("nl", "het nieuws van vandaag en deze week is de tekst van de dag")],
                                  "lang string, text string")
    return language_profile(train)


def test_whole_run(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    write_mail(src / "Alert faculteit GEO - 1.eml", HTML)
    other = HTML.replace("- Title &amp; text", "Other news of the week").replace("news.example/1", "news.example/9")
    write_mail(src / "Alert faculteit Beta 1 - 2.eml", other)
    # published: the second article (same title key, same day, shared person E2)
    pub = spark.createDataFrame([("p1", {"text": [{"value": "OTHER NEWS OF THE WEEK"}]}, {"startDate": "2025-03-12T00:00"},
                                  [{"person": {"externalId": "E2", "internalId": None}}, {"person": None}])], PUB)
    responses = spark.createDataFrame([], "article_id string, response string")
    out = process_mails(spark, str(src), directory(spark), orgs(spark), pub, profile(spark),
                        run_stamp="20250101-000000", allowed_languages=["en", "nl"], responses=responses,
                        xml_path=str(tmp_path / "xml"))
    st = {r.status: r.n for r in out["status_counts"].collect()}
    assert st == {"ok": 1, "duplicate": 1, "no_persons": 0, "error": 0}
    p = json.loads(out["payloads"].first().payload)
    persons = p["mediaCoverages"][0]["persons"]
    assert [x["person"]["uuid"] for x in persons] == ["u-dina", "u-jan"]
    assert p["workflow"]["step"] == "entryInProgress"          # faculty GEO from the file name
    assert p["title"]["en_GB"] == "Title &amp; text"
    assert out["clippings"].count() == 1
    assert (tmp_path / "xml").exists()
    metrics = [(m.step, m.phase, m.rows) for m in out["metrics"].orderBy("step").collect()]
    assert [m[1] for m in metrics] == ["extracted", "filtered", "resolved", "ok"]
    assert [m[2] for m in metrics] == [t.count() for t in (out["articles"], out["articles"], out["resolved"], out["ok"])]


def test_block_order_prompts_and_malformed_end(spark, tmp_path):
    """Twelve blocks with one title and no URL: the first block is kept (2 before 10); an
    association whose end is no date makes its article an error; prompts come out."""
    from tests.test_entities import DIR_SCHEMA, assoc, emp
    src = tmp_path / "in"
    src.mkdir()
    block = HTML[HTML.index("<tr"):HTML.index("</tr>") + 5].replace('href="https://news.example/1"', 'href=""')
    first = block.replace("Dina Siegel, Siegel", "Nobody Known")
    for drop in ("Jan</span>", "Vries</span>", "Jan de Vries"):
        first = first.replace(drop, drop.replace("Jan", "X").replace("Vries", "Y"))
    bad = block.replace("Dina Siegel, Siegel", "Kees Bakker").replace("Title &amp; text", "Bad period today")
    later = "".join(block.replace("Example Daily", f"Paper {i}") for i in range(2, 12))
    write_mail(src / "Alert faculteit GEO - 1.eml", "<table>" + first + bad + later + "</table>")
    d = directory(spark).where("uuid <> 'u-bad'").unionByName(spark.createDataFrame(
        [(9, "u-end", {"firstName": "Kees", "lastName": "Bakker"}, [], emp("E9"), [assoc("2020-01-01", "no date", "o1")])], DIR_SCHEMA))
    pub = spark.createDataFrame([], PUB)
    out = process_mails(spark, str(src), d, orgs(spark), pub, profile(spark), run_stamp="x", allowed_languages=["en", "nl"],
                        pages=spark.createDataFrame([("", "unused")], "url string, text string"))
    st = {r.status: r.n for r in out["status_counts"].collect()}
    assert st == {"ok": 10, "duplicate": 0, "no_persons": 1, "error": 1}
    ok = out["ok"].collect()
    assert len(ok) == 1 and ok[0].source == "Paper 2" and ok[0].article_id.endswith("#2")
    assert [p.name for p in ok[0].persons][0].lower() == "dina siegel"
    prompt = out["prompts"].first().prompt
    assert "Title & text" in prompt and "Paper 2" in prompt
    assert "the" not in (ok[0].keywords or [])
