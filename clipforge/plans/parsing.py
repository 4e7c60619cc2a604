"""Block extraction, titles, dates, language and mentions over pages, orders and documents.

Stand-ins: a mail is a document written as mail HTML, its whole text in the block and its first line in
the headline; ``mail_scan`` writes these as MIME mails of several charsets and structures into mailbox files and scans them. Elsewhere an article block is a web page of ``pages``; its headline is the
``<h1>``; its labelled person list is the navigation labels (``<li><a>``) read
as ``Personen: a, b, ...`` and two more names (the first with an institution before it,
and a black-listed one); its highlighted tokens are the words of all ``<b>`` runs; its
block text names the first two labels after ``Faculteit ... /``. Harvest dates are ``orders.o_orderdate`` written as mail text:
Dutch month names with a dot for status F, capitalised for status O, English
for status P (so March, May and October fail to parse, as they would in the
mails). Language profiles are learned from all ``documents`` (text, lang) and
applied to page headlines; the stand-in allow list is en, fr. Mention cleanup
adds the page junk markers to the unwanted terms and ``the``/``and`` to the black list.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from clipforge.functions import constants as C
from clipforge.functions.text import WS, clean_title, html_escape, html_unescape_basic, parse_dutch_datetime, split_ws
from clipforge.operators.language import filter_languages, identify_language, language_profile
from clipforge.operators.mentions import clean_mentions, faculty_names, raw_mentions, subsume_partials
from clipforge.plans import sqlfrag as S
from clipforge.plans.registry import register
from clipforge.session import scratch_path, written
from clipforge.sources.mail import extract_blocks, extract_blocks_from_html, read_mails, split_mailboxes, write_mailboxes
from clipforge.sources.tables import Tables
from clipforge.streaming.intake import articles_from_blocks

ALLOWED_STANDIN = ["en", "fr"]
BLACKLIST_STANDIN = [*C.BLACKLIST_NAMES, "the", "and"]
PATTERNS_STANDIN = [*C.UNWANTED_TERM_PATTERNS, "%%%", r"\*\*\*", "###", r"\$\$\$", "&&&"]
ENGLISH_MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
DUTCH_MONTHS_SQL = "['jan','feb','mrt','apr','mei','jun','jul','aug','sep','okt','nov','dec']"


def page_titles(pages):
    raw = F.regexp_replace(F.regexp_extract("html", r"(?s)<h1>(.*?)</h1>", 1), "<[^>]*>", "")
    return pages.where(F.col("html").rlike("<h1>")).select("page_id", clean_title(html_unescape_basic(raw)).alias("title"))


def _mails(docs):
    """One mail's HTML per document: a block with a headline link, date, source and body, one
    without a headline and one whose date is none. The month list has a thirteenth name."""
    from clipforge.functions.constants import DUTCH_MONTHS
    n = F.col("doc_id")
    month = F.element_at(F.array(*[F.lit(m) for m in [*DUTCH_MONTHS, "foo"]]), (n % 13 + 1).cast("int"))
    date = F.concat(F.lit("| "), (n % 31 + 1).cast("string"), F.lit(" "), month, F.lit(" 2024 "), F.lpad((n % 24).cast("string"), 2, "0"), F.lit(":30"))
    url = F.concat(F.lit("https://news.example/"), n.cast("string"), F.lit("?q="), F.repeat(F.lit("x"), (n % 2000).cast("int")))
    title = html_escape(F.concat(F.lit("-- "), F.split("text", "\n")[0], F.lit(" | R&D")))
    head = lambda t: F.concat(F.lit(f'<a class="{C.HEADLINE_CLASS}" href="'), html_escape(url), F.lit('">'), t, F.lit("</a>"))
    tag = lambda name, cls, t: F.concat(F.lit(f'<{name} class="{cls}">'), t, F.lit(f"</{name}>"))
    row = f'<tr class="{C.ARTICLE_BLOCK_CLASS}"><td>'
    html = F.concat(
        F.lit("<html><body><style>p{}</style><table>" + row + '<a href="x">no headline</a></td></tr>' + row), head(title),
        tag("span", C.HARVEST_DATE_CLASS, date), F.when(n % 5 > 0, tag("a", C.SOURCE_NAME_CLASS, html_escape(F.concat(F.lit(" "), "source", F.lit("\n| & Co"))))).otherwise(""),
        F.lit("<div>Faculteit Geo / "), html_escape(F.translate("text", "/", " ")), F.lit(" ... / end</div></td></tr>" + row), head(F.lit("undated")), F.lit("</td></tr></table></body></html>"))
    code = F.when(n % 4 == 0, "GEO").when(n % 4 == 1, "Beta 2").when(n % 4 == 2, "Rechten")
    path = F.concat(F.lit("/mail/Alert "), F.when(code.isNotNull(), F.concat(F.lit("faculteit "), code, F.lit(" - "))).otherwise(""), n.cast("string"), F.lit(".eml"))
    return docs.select(path.alias("path"), html.alias("html"))


_TITLE_SQL = S.clean_title("'-- ' || string_split(text, chr(10))[1] || ' | R&D'")
_NAME_SQL = f"regexp_replace({S.strip("replace(text, '/', ' ') || ' ... '")}, {S.q(WS + '*')} || '\\.\\.\\.$', '')"


@register("mail_articles", sql=f"""
WITH d AS (SELECT *, {DUTCH_MONTHS_SQL}[doc_id % 13 + 1] AS mon, doc_id % 13 + 1 AS mno, doc_id % 31 + 1 AS dno FROM documents)
SELECT '/mail/Alert ' || CASE doc_id % 4 WHEN 0 THEN 'faculteit GEO - ' WHEN 1 THEN 'faculteit Beta 2 - '
         WHEN 2 THEN 'faculteit Rechten - ' ELSE '' END || doc_id || '.eml' AS path, 1 AS block_no,
       {_TITLE_SQL} AS title,
       substr('https://news.example/' || doc_id || '?q=' || repeat('x', CAST(doc_id % 2000 AS INTEGER)), 1, 1024) AS url,
       strftime(make_timestamp(2024, mno, dno, doc_id % 24, 30, 0), '%Y-%m-%d %H:%M') AS ts,
       CASE WHEN doc_id % 5 > 0 THEN source || ' & Co' ELSE 'Unknown' END AS source,
       CASE doc_id % 4 WHEN 0 THEN 'GEO' WHEN 1 THEN 'BETA' WHEN 2 THEN 'Rechten' END AS faculty,
       {_NAME_SQL} AS names
FROM d WHERE mon IS NOT NULL AND dno <= day(last_day(make_date(2024, mno, 1)))
""")
def q_mail_articles(spark, data_dir):
    docs = Tables(spark, data_dir).spread("documents", "doc_id", "source", "text")
    arts = articles_from_blocks(extract_blocks_from_html(_mails(docs), "path", "html"))
    return arts.select("path", "block_no", "title", "url", F.date_format("ts", "yyyy-MM-dd HH:mm").alias("ts"), "source", "faculty",
                       F.array_join(faculty_names("block_text"), "|").alias("names"))


def _mime(mails):
    """(mail, content): each mail's HTML in a MIME file. By number: ISO-8859-1 where the text
    allows it, UTF-8 or UTF-16; the HTML beside a plain part, or nested one level deeper before
    a second HTML part; every seventh has a plain part only, every eleventh an unknown charset."""
    n, line = F.col("mail"), "\n"
    fits = F.col("html").rlike(r"(?s)^[\x00-\xFF]*$")
    charset = F.when(n % 3 == 2, "UTF-16").when((n % 3 == 0) & fits, "ISO-8859-1").otherwise("UTF-8")
    body = F.base64(F.when(charset == "UTF-16", F.encode("html", "UTF-16")).when(charset == "ISO-8859-1", F.encode("html", "ISO-8859-1")).otherwise(F.encode("html", "UTF-8")))
    named = F.when(n % 11 == 5, "no-such-charset").otherwise(charset)
    html = F.concat(F.lit("Content-Type: text/html; charset="), named, F.lit(f"{line}Content-Transfer-Encoding: base64{line}{line}"), body, F.lit(line))
    plain = f"Content-Type: text/plain; charset=utf-8{line}{line}<tr>plain part</tr>{line}"
    top = f"Subject: alert{line}MIME-Version: 1.0{line}Content-Type: "
    flat = F.concat(F.lit(f"{top}multipart/alternative; boundary=A{line}{line}--A{line}{plain}--A{line}"), html, F.lit(f"--A--{line}"))
    deep = F.concat(F.lit(f"{top}multipart/mixed; boundary=M{line}{line}--M{line}Content-Type: multipart/alternative; boundary=A{line}{line}--A{line}{plain}--A{line}"),
                    html, F.lit(f"--A--{line}--M{line}Content-Type: text/html; charset=utf-8{line}{line}<p>an attachment</p>{line}--M--{line}"))
    alone = F.lit(f"{top}text/plain; charset=utf-8{line}{line}no page here{line}")
    return mails.select("mail", F.when(n % 7 == 3, alone).when(n % 2 == 0, flat).otherwise(deep).alias("content"))


@register("mail_scan", sql=f"""
WITH d AS (SELECT *, {DUTCH_MONTHS_SQL}[doc_id % 13 + 1] AS mon, doc_id % 13 + 1 AS mno, doc_id % 31 + 1 AS dno FROM documents WHERE doc_id % 7 <> 3)
SELECT doc_id AS mail, 1 AS block_no, {_TITLE_SQL} AS title, strftime(make_timestamp(2024, mno, dno, doc_id % 24, 30, 0), '%Y-%m-%d %H:%M') AS ts,
       CASE WHEN doc_id % 5 > 0 THEN source || ' & Co' ELSE 'Unknown' END AS source, {_NAME_SQL} AS names, NULL AS error
FROM d WHERE mon IS NOT NULL AND dno <= day(last_day(make_date(2024, mno, 1))) AND doc_id % 11 <> 5
UNION ALL SELECT doc_id, -1, NULL, NULL, NULL, NULL, 'LookupError' FROM d WHERE doc_id % 11 = 5
""")
def q_mail_scan(spark, data_dir):
    """Documents as MIME mails in mailbox files of the shared folder, scanned recursively by Spark's own file source."""
    docs = Tables(spark, data_dir).spread("documents", "doc_id", "source", "text")
    mails = _mails(docs).select(F.regexp_extract("path", r"(\d+)\.eml$", 1).cast("long").alias("mail"), "html")
    folder = scratch_path(spark, f"mails-{uuid.uuid4().hex}")
    write_mailboxes(_mime(mails), folder, F.concat(F.lit("mail="), F.col("mail").cast("string")))
    blocks = written(extract_blocks(split_mailboxes(read_mails(spark, folder, "*.txt"))), "mail_blocks")
    mail = F.regexp_extract("path", r"#mail=(\d+)$", 1).cast("long").alias("mail")
    arts = articles_from_blocks(blocks).select(
        mail, "block_no", "title", F.date_format("ts", "yyyy-MM-dd HH:mm").alias("ts"), "source",
        F.array_join(faculty_names("block_text"), "|").alias("names"), F.lit(None).cast("string").alias("error"))
    none = [F.lit(None).cast("string").alias(c) for c in ("title", "ts", "source", "names")]
    return arts.unionByName(blocks.where("error IS NOT NULL").select(mail, "block_no", *none, F.split("error", ":")[0].alias("error")))


@register("article_titles", sql=f"SELECT page_id, {S.h1_title()} AS title FROM pages WHERE regexp_matches(html, '<h1>')")
def q_article_titles(spark, data_dir):
    return page_titles(Tables(spark, data_dir).spread("pages", "page_id", "html"))


def _date_text(t):
    from clipforge.functions.constants import DUTCH_MONTHS
    d = F.col("o_orderdate")
    nl = F.element_at(F.array(*[F.lit(m) for m in DUTCH_MONTHS]), F.month(d))
    en = F.element_at(F.array(*[F.lit(m) for m in ENGLISH_MONTHS]), F.month(d))
    month = (F.when(F.col("o_orderstatus") == "F", F.concat(nl, F.lit(".")))
             .when(F.col("o_orderstatus") == "O", F.initcap(nl)).otherwise(en))
    return F.concat_ws(" ", F.dayofmonth(d).cast("string"), month, F.year(d).cast("string"), F.date_format(d, "HH:mm"))


@register("article_dates", sql=r"""
WITH t AS (SELECT o_orderkey, concat_ws(' ', CAST(day(o_orderdate) AS VARCHAR),
             CASE o_orderstatus WHEN 'F' THEN """ + DUTCH_MONTHS_SQL + r"""[month(o_orderdate)] || '.'
                                WHEN 'O' THEN upper(substr(""" + DUTCH_MONTHS_SQL + r"""[month(o_orderdate)], 1, 1))
                                              || substr(""" + DUTCH_MONTHS_SQL + r"""[month(o_orderdate)], 2)
                                ELSE ['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec'][month(o_orderdate)] END,
             CAST(year(o_orderdate) AS VARCHAR), strftime(o_orderdate, '%H:%M')) AS date_text FROM orders),
p AS (SELECT o_orderkey, date_text,
             regexp_extract(date_text, '^(\d{1,2}) (\p{L}+)\.? (\d{4}) (\d{1,2}):(\d{1,2})$', ['d', 'm', 'y', 'hh', 'mi']) AS g
      FROM t)
SELECT o_orderkey, date_text,
       CASE WHEN list_position(""" + DUTCH_MONTHS_SQL + r""", lower(g.m)) > 0 THEN
         strftime(make_timestamp(CAST(g.y AS BIGINT), list_position(""" + DUTCH_MONTHS_SQL + r""", lower(g.m)),
                  CAST(g.d AS BIGINT), CAST(g.hh AS BIGINT), CAST(g.mi AS BIGINT), 0), '%Y-%m-%d %H:%M:%S') END AS ts
FROM p
""")
def q_article_dates(spark, data_dir):
    o = Tables(spark, data_dir).orders
    t = o.select("o_orderkey", _date_text(o).alias("date_text"))
    return t.select("o_orderkey", "date_text",
                    F.date_format(parse_dutch_datetime("date_text"), "yyyy-MM-dd HH:mm:ss").alias("ts"))


# --- language ---------------------------------------------------------------------

_PROFILE_SQL = r"""
dw AS (SELECT lang, w, count(*) AS c FROM
       (SELECT lang, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS w FROM documents WHERE lang IS NOT NULL)
       GROUP BY 1, 2),
prof AS (SELECT lang, gram, CAST(sum(c) AS BIGINT) AS n FROM
         (SELECT lang, c, unnest(list_transform(range(1, length(w) + 2), lambda i: substr(' ' || w || ' ', i, 2))) AS gram
          FROM dw) GROUP BY 1, 2)
"""

_ID_SQL = "WITH " + _PROFILE_SQL + f""",
vv AS (SELECT count(DISTINCT gram) AS V FROM prof),
w AS (SELECT lang, gram, ln(n + 1) AS w FROM prof
      UNION ALL SELECT lang, '##', -ln(sum(n) + (SELECT V FROM vv)) FROM prof GROUP BY lang),
titles AS (SELECT page_id, regexp_extract(html, '<html lang="([^"]*)"', 1) AS declared, {S.h1_title()} AS title
           FROM pages WHERE regexp_matches(html, '<h1>')),
tg AS (SELECT * FROM titles WHERE regexp_matches(title, '\\p{{L}}')),
tw AS (SELECT page_id, w, count(*) AS c FROM
       (SELECT page_id, unnest(regexp_extract_all(lower(title), '\\p{{L}}+')) AS w FROM tg) GROUP BY 1, 2),
g0 AS (SELECT page_id, gram, sum(c) AS cnt FROM
         (SELECT page_id, c, unnest(list_transform(range(1, length(w) + 2), lambda i: substr(' ' || w || ' ', i, 2))) AS gram
          FROM tw) GROUP BY 1, 2),
g AS (SELECT * FROM g0 UNION ALL SELECT page_id, '##', sum(cnt) FROM g0 GROUP BY page_id),
sc AS (SELECT page_id, lang, sum(cnt * w) AS score FROM g JOIN w USING (gram) GROUP BY 1, 2),
best AS (SELECT page_id, lang FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, lang) AS rn
         FROM sc) WHERE rn = 1)
"""


def _identified(spark, data_dir):
    from clipforge.plans.entities import _materialise
    t = Tables(spark, data_dir)
    # the learned profile is a model table: written once, read by the three weight terms
    prof = _materialise(language_profile(t.spread("documents", "text", "lang"), "text", "lang"))
    titles = page_titles(t.spread("pages", "page_id", "html"))
    ids = identify_language(titles, "page_id", "title", prof)
    declared = t.pages.select("page_id", F.regexp_extract("html", '<html lang="([^"]*)"', 1).alias("declared"))
    return ids.join(declared, "page_id").select("page_id", "declared", "lang")


@register("language_profile", sql="WITH " + _PROFILE_SQL + " SELECT lang, gram, n FROM prof")
def q_language_profile(spark, data_dir):
    return language_profile(Tables(spark, data_dir).spread("documents", "text", "lang"), "text", "lang")


@register("language_id", sql=_ID_SQL + " SELECT page_id, declared, lang FROM best JOIN tg USING (page_id)")
def q_language_id(spark, data_dir):
    return _identified(spark, data_dir)


@register("language_filter", sql=_ID_SQL + " SELECT page_id, lang FROM best WHERE lang IN ('en', 'fr')")
def q_language_filter(spark, data_dir):
    return filter_languages(_identified(spark, data_dir), "lang", ALLOWED_STANDIN).select("page_id", "lang")


# --- mentions ---------------------------------------------------------------------

def _page_parts(pages):
    labels = F.transform(F.regexp_extract_all("html", F.lit(r"<li><a[^>]*>([^<]*)</a>"), 1), html_unescape_basic)
    bold = F.flatten(F.transform(F.regexp_extract_all("html", F.lit(r"<b>([^<]*)"), 1), lambda x: split_ws(html_unescape_basic(x))))
    one = F.coalesce(F.get("labels", F.lit(0)), F.lit(""))
    two = F.coalesce(F.get("labels", F.lit(1)), F.lit(""))
    listed = F.concat(F.lit("Personen: "), F.array_join("labels", ", "), F.lit(", Universiteit Utrecht "), one, F.lit(", Anton Pijpers"))
    block = F.concat(F.lit("Faculteit Geo / "), one, F.lit("\nFaculteit Beta / "), two, F.lit(" ..."))
    return (pages.select("page_id", labels.alias("labels"), bold.alias("toks"))
            .select("page_id", F.array(listed).alias("labelled"), block.alias("block"), "toks"))


_WSQ = S.q(WS + "*")
_MENTION_SQL = f"""
p0 AS (SELECT page_id,
             list_transform(regexp_extract_all(html, '<li><a[^>]*>([^<]*)</a>', 1), lambda x: {S.unescape('x')}) AS labels,
             flatten(list_transform(regexp_extract_all(html, '<b>([^<]*)', 1), lambda y: {S.split_ws(S.unescape('y'))})) AS toks
      FROM pages),
p AS (SELECT *, 'Personen: ' || array_to_string(labels, ', ') || ', Universiteit Utrecht ' || coalesce(labels[1], '')
                || ', Anton Pijpers' AS listed,
             'Faculteit Geo / ' || coalesce(labels[1], '') || chr(10) || 'Faculteit Beta / ' || coalesce(labels[2], '')
                || ' ...' AS block FROM p0),
lab AS (SELECT page_id, unnest(string_split_regex(regexp_replace(listed, 'Personen:' || {_WSQ}, '', 'g'), ',' || {_WSQ})) AS raw FROM p),
fac AS (SELECT page_id, unnest(regexp_extract_all(block, {S.q(C.FACULTY_NAME_PATTERN)}, 1)) AS raw FROM p),
lab2 AS (SELECT page_id, regexp_replace({S.strip('raw')}, {_WSQ} || '\\.\\.\\.$', '') AS mention FROM lab
         UNION ALL SELECT page_id, regexp_replace(regexp_replace({S.strip('raw')}, '\\nFaculteit [^/]+', '', 'g'), {_WSQ} || '\\.\\.\\.$', '') FROM fac),
hl AS (SELECT page_id, array_to_string(toks, ' ') AS mention FROM p WHERE len(toks) BETWEEN 1 AND 6
       UNION ALL SELECT page_id, toks[i] || ' ' || toks[i + 1] FROM
         (SELECT page_id, toks, unnest(range(1, len(toks))) AS i FROM p)
       UNION ALL SELECT page_id, toks[len(toks)] FROM p WHERE len(toks) % 2 = 1),
m AS (SELECT DISTINCT page_id, mention FROM (SELECT * FROM lab2 UNION ALL SELECT * FROM hl) WHERE mention <> '')
"""


@register("mention_extract", sql=f"WITH {_MENTION_SQL} SELECT page_id, mention FROM m")
def q_mention_extract(spark, data_dir):
    p = _page_parts(Tables(spark, data_dir).spread("pages", "page_id", "html"))
    return p.select("page_id", F.explode(raw_mentions("labelled", "block", "toks")).alias("mention"))


def _subsume_sql(src: str, out: str, blacklist: list | None) -> str:
    sp = S.split_ws("mention")
    bl = ""
    if blacklist:
        bl = "AND lower(mention) NOT IN (" + ", ".join(S.q(b.lower()) for b in blacklist) + ")"
    return f"""
{out}_w AS (SELECT DISTINCT page_id, lower(w) AS w FROM
              (SELECT page_id, unnest({sp}) AS w FROM {src} WHERE len({sp}) > 1)),
{out} AS (SELECT page_id, mention FROM {src} s WHERE len({sp}) >= 1 {bl}
          AND NOT (len({sp}) = 1 AND EXISTS (SELECT 1 FROM {out}_w w WHERE w.page_id = s.page_id
                                             AND w.w = lower(({sp})[1]))))
"""


def _fold_sql(x: str) -> str:
    for p in PATTERNS_STANDIN:
        x = S.strip(f"regexp_replace({x}, {S.q(p)}, '', 'g')")
    return f"array_to_string({S.split_ws(x)}, ' ')"


_CLEANUP_SQL = "WITH " + _MENTION_SQL + "," + _subsume_sql("m", "pass1", BLACKLIST_STANDIN) + f""",
cleaned AS (SELECT DISTINCT page_id, {_fold_sql('mention')} AS mention FROM pass1),
cleaned2 AS (SELECT * FROM cleaned WHERE mention <> '')
""" + "," + _subsume_sql("cleaned2", "pass2", None)


@register("mention_cleanup", sql=_CLEANUP_SQL + " SELECT page_id, mention FROM pass2")
def q_mention_cleanup(spark, data_dir):
    p = _page_parts(Tables(spark, data_dir).spread("pages", "page_id", "html"))
    raw = p.select("page_id", raw_mentions("labelled", "block", "toks").alias("names"))
    return clean_mentions(raw, "page_id", "names", blacklist=BLACKLIST_STANDIN, patterns=PATTERNS_STANDIN).select("page_id", "mention")


@register("subsume_partials", sql=f"""
WITH names AS (SELECT DISTINCT p_brand, p_name AS name FROM part UNION SELECT DISTINCT p_brand, p_type FROM part),
w AS (SELECT DISTINCT p_brand, lower(x) AS w FROM (SELECT p_brand, unnest({S.split_ws('name')}) AS x FROM names
      WHERE len({S.split_ws('name')}) > 1))
SELECT p_brand, name FROM names n WHERE len({S.split_ws('name')}) > 1
   OR (len({S.split_ws('name')}) = 1 AND NOT EXISTS (SELECT 1 FROM w WHERE w.p_brand = n.p_brand
                                                     AND w.w = lower(({S.split_ws('name')})[1])))
""")
def q_subsume_partials(spark, data_dir):
    p = Tables(spark, data_dir).part
    names = p.select("p_brand", F.col("p_name").alias("name")).unionByName(
        p.select("p_brand", F.col("p_type").alias("name"))).distinct()
    return subsume_partials(names, "p_brand", "name")
