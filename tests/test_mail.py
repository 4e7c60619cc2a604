from email.message import EmailMessage

from pyspark.sql import functions as F

from clipforge.functions.text import clean_title, parse_dutch_datetime
from clipforge.operators.mentions import clean_mentions, raw_mentions
from clipforge.sources.mail import extract_blocks, read_mails

HTML = """<html><body><table>
<tr class="article_container"><td>
  <a class="email-article-headline" href="https://news.example/1">- Title &amp; text</a>
  <span class="article-email-harvest-date">| 12 mrt 2025 08:30</span>
  <a class="email-article-source-name">Example Daily</a>
  <div><strong>Personen</strong>: Dina Siegel, Siegel, Anton Pijpers, Jan de Vries ...</div>
  <div>Faculteit Geo / Piet Jansen</div>
  <span style="background:#88C53E;">Jan</span> <span style="background:#88c53e;">Vries</span>
  <span style="background:#88C53E;">Utrecht</span>
</td></tr>
<tr class="article_container"><td><a href="x">no headline class</a></td></tr>
<tr class="article_container"><td>
  <a class="email-article-headline" href="https://news.example/2">Second</a>
  <span class="article-email-harvest-date">31 feb 2025 08:30</span>
</td></tr>
</table></body></html>"""


def write_mail(path, html=None):
    m = EmailMessage()
    m["Subject"] = "alert"
    m.set_content("plain part")
    if html is not None:
        m.add_alternative(html, subtype="html")
    path.write_bytes(bytes(m))


def test_blocks_from_mails(spark, tmp_path):
    d = tmp_path / "in" / "sub"
    d.mkdir(parents=True)
    write_mail(d / "Alert faculteit Beta 1 - a.eml", HTML)
    write_mail(d / "no html.eml", None)
    (d / "ignore.txt").write_text("x")
    blocks = extract_blocks(read_mails(spark, str(tmp_path / "in")))
    rows = sorted(blocks.collect(), key=lambda r: r.block_no)
    assert [r.block_no for r in rows] == [0, 2]          # block without headline skipped; no-HTML mail: no rows
    b = rows[0]
    assert b.url == "https://news.example/1" and b.source == "Example Daily"
    assert b.highlighted == ["Jan", "Vries", "Utrecht"]
    assert rows[1].source is None
    t = blocks.select("block_no", clean_title("title").alias("t"), parse_dutch_datetime("date_text").alias("ts"),
                      F.coalesce("source", F.lit("Unknown")).alias("src")).orderBy("block_no").collect()
    assert t[0].t == "Title & text" and t[0].ts.hour == 8 and t[1].ts is None and t[1].src == "Unknown"


def test_mentions_of_block(spark, tmp_path):
    d = tmp_path / "m"
    d.mkdir()
    write_mail(d / "a.eml", HTML)
    blocks = extract_blocks(read_mails(spark, str(d))).where("block_no = 0")
    raw = blocks.select("block_no", raw_mentions("labelled_text", "block_text", "highlighted").alias("names"))
    got = {r.mention for r in clean_mentions(raw, "block_no", "names").collect()}
    # Siegel is subsumed by Dina Siegel; Anton Pijpers is black-listed; the
    # highlighted run gives "Jan Vries Utrecht" -> cleaned to "Jan Vries";
    # single "Utrecht" is removed by cleaning; "Vries" is subsumed. The
    # "Faculteit Geo / ..." capture runs to the next "/", so it takes the
    # following lines too (as the reference's pattern does on the block text).
    assert "Siegel" not in got and "Anton Pijpers" not in got
    assert {"Dina Siegel", "Jan de Vries", "Piet Jansen Jan Vries", "Jan Vries"} <= got
    assert "Utrecht" not in got and "Vries" not in got


def test_unknown_charset_is_an_error_row(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    write_mail(d / "good.eml", HTML)
    (d / "bad.eml").write_bytes(b"MIME-Version: 1.0\nContent-Type: text/html; charset=no-such-set\n\n<p>x</p>")
    rows = extract_blocks(read_mails(spark, str(d))).collect()
    assert [r.title is None and "no-such-set" in r.error for r in rows if r.path.endswith("bad.eml")] == [True]
    assert all(r.error is None for r in rows if r.path.endswith("good.eml")) and len(rows) == 3


def test_style_and_script_are_no_text():
    from clipforge.sources import html_doc
    assert html_doc.parse("<div>a<style>b</style><script>c</script>d</div>").text() == "ad"
