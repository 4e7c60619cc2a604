"""Classification tables, lookups and tagging.

Stand-ins: articles are web pages (headline = ``<h1>``); pages over ``https``
count as fetched, the others as failed fetches (title fallback). Prompts are
built for the conversations resolved in the entity plan. Classifier answers
are written from ``events``: error events return text that is not JSON,
signup events omit ``typerole`` and ``Medium_type``. Mail file names come
from the page URL's path language: en -> ``Beta 1``, fr -> ``GEO``,
de -> ``Rechten`` (not in the faculty map), es -> no faculty in the name.
Source home pages use a stand-in map of six sources; documents over 10,000
characters already carry a URL. Tags: six stand-in unit names.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from clipforge.functions import constants as C
from clipforge.operators.duplicates import keep_first
from clipforge.operators.entities import nest_resolved, resolve_mentions
from clipforge.operators.labels import names_and_orgs, normalise_labels, page_text, parse_response, prompt_text, \
    rename_mediatype, _template_parts
from clipforge.operators.ordering import positions
from clipforge.operators.lookups import dictionary_tags, faculty_code, fill_source_urls, table_tags, workflow
from clipforge.plans import sqlfrag as S
from clipforge.plans.entities import _RESOLVE_SQL, directory, mentions, organisations
from clipforge.plans.parsing import page_titles
from clipforge.plans.registry import register
from clipforge.sources.mail import page_visible_text
from clipforge.sources.tables import Tables

SOURCE_MAP_STANDIN = {f"src{i}": f"https://www.src{i}.example" for i in (0, 2, 4, 6, 8, 10)}
TAG_NAMES_STANDIN = ["the", "und", "les", "Nicht", "qui", "Faculteit Geo"]

_VISIBLE_SQL = (
    "array_to_string(list_filter(list_transform(regexp_split_to_array(regexp_replace(html, "
    + S.q(r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>|<template\b.*?</template>")
    + ", '', 'g'), '<[^>]*>'), lambda p: " + S.strip(S.unescape("p")) + "), lambda p: p <> ''), chr(10))")


@register("page_text", sql=f"""
WITH a AS (SELECT page_id, url, {S.h1_title()} AS title FROM pages WHERE regexp_matches(html, '<h1>')),
f AS (SELECT url, {_VISIBLE_SQL} AS text FROM pages WHERE starts_with(url, 'https'))
SELECT a.page_id, substr(CASE WHEN a.url IS NULL OR a.url = '' THEN a.title ELSE coalesce(f.text, a.title) END, 1, 2000)
       AS excerpt
FROM a LEFT JOIN f ON a.url = f.url
""")
def q_page_text(spark, data_dir):
    pages = Tables(spark, data_dir).spread("pages", "page_id", "url", "html")
    arts = page_titles(pages).join(pages.select("page_id", "url"), "page_id")
    firsts = keep_first(pages.where(F.col("url").startswith("https")).select("page_id", "url"), ["url"], "page_id")
    texts = page_visible_text(pages.join(firsts.select("page_id"), "page_id", "left_semi"))
    fetched = firsts.join(texts, "page_id").select("url", "text")
    return page_text(arts, fetched).select("page_id", "excerpt")


def _prompt_sql() -> str:
    parts = []
    fields = {"title": "title", "source": "source", "names": "names", "organizations": "organizations",
              "excerpt": "excerpt"}
    for k, v in _template_parts(C.PROMPT_TEMPLATE):
        parts.append(S.q(v) if k == "lit" else f"coalesce({fields[v]}, '')")
    return " || ".join(parts)


@register("prompt_table", sql="WITH " + _RESOLVE_SQL + f""",
conv AS (SELECT conv_id, substr(string_agg(text, chr(10) ORDER BY turn), 1, 2000) AS excerpt,
                arg_min(split_part(text, chr(10), 1), turn) AS title, arg_min(role, turn) AS source
         FROM conversations GROUP BY 1),
nm AS (SELECT article_id, string_agg(mention, ', ' ORDER BY mention_pos) AS names FROM kept GROUP BY 1),
og AS (SELECT k.article_id, string_agg(a.orgname, ', ' ORDER BY k.mention_pos, a.org_uuid) AS organizations
       FROM kept k JOIN active a ON a.article_id = k.article_id AND a.mention_pos = k.mention_pos GROUP BY 1),
pr AS (SELECT nm.article_id, title, source, names, organizations, excerpt
       FROM nm JOIN og USING (article_id) JOIN conv ON conv.conv_id = nm.article_id)
SELECT article_id, {_prompt_sql()} AS prompt FROM pr
""")
def q_prompt_table(spark, data_dir):
    t = Tables(spark, data_dir)
    kept, _, _ = resolve_mentions(mentions(t), directory(t), organisations(t))
    nested = nest_resolved(kept)
    # An excerpt of n characters holds parts of at most n turns (each adds its newline): only the
    # first n turns of a conversation are gathered, each cut to n characters.
    n = C.EXCERPT_MAX_CHARS
    turns = t.conversations.select("conv_id", "turn", "role", F.substring("text", 1, n).alias("text"),
                                   F.substring_index("text", "\n", 1).alias("line"))
    first = positions(t.conversations.select("conv_id", "turn"), ["turn"], ["conv_id"]).where(F.col("pos") <= n)
    turns = turns.join(first, ["conv_id", "turn"])
    conv = turns.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "text", "role", F.when(F.col("pos") == 1, F.col("line")).alias("line")))).alias("_t"))
    conv = conv.select(F.col("conv_id").alias("article_id"),
                       F.substring(F.array_join(F.transform("_t", lambda x: x["text"]), "\n"), 1, n).alias("excerpt"),
                       F.col("_t")[0]["line"].alias("title"), F.col("_t")[0]["role"].alias("source"))
    names, orgs = names_and_orgs("persons")
    j = nested.join(conv, "article_id")
    return j.select("article_id", prompt_text("title", "source", names, orgs, "excerpt").alias("prompt"))


def _responses(t):
    ev = t.events.withColumn("k", F.get_json_object("props", "$.k"))
    degree = F.when(F.col("value") > 50, "international").when(F.col("value") > 20, "national").otherwise("local")
    role = (F.when(F.col("event_type") == "click", "research cited").when(F.col("event_type") == "view", "interviewee")
            .when(F.col("event_type") == "purchase", "author").otherwise("expert"))
    tail = F.when(F.col("event_type") == "signup", F.lit("")) \
        .otherwise(F.lit(', "typerole": "expert comment", "Medium_type": "TV"'))
    js = F.concat(F.lit('{"keywords": ["'), F.col("event_type"), F.lit('", "k'), F.col("k"), F.lit('"], "degree": "'),
                  degree, F.lit('", "researcher_role": "'), role, F.lit('"'), tail, F.lit("}"))
    resp = F.when(F.col("event_type") == "error", F.concat(F.lit("not json: "), F.col("props"))).otherwise(js)
    return ev.select("event_id", resp.alias("response"))


_RESP_SQL = """
ev AS (SELECT *, json_extract_string(props, '$.k') AS k FROM events),
resp AS (SELECT event_id, CASE WHEN event_type = 'error' THEN 'not json: ' || props ELSE
  '{"keywords": ["' || event_type || '", "k' || k || '"], "degree": "' ||
  CASE WHEN value > 50 THEN 'international' WHEN value > 20 THEN 'national' ELSE 'local' END ||
  '", "researcher_role": "' || CASE event_type WHEN 'click' THEN 'research cited' WHEN 'view' THEN 'interviewee'
                                               WHEN 'purchase' THEN 'author' ELSE 'expert' END || '"' ||
  CASE WHEN event_type = 'signup' THEN '' ELSE ', "typerole": "expert comment", "Medium_type": "TV"' END || '}' END
  AS response FROM ev),
parsed AS (SELECT event_id,
  CASE WHEN json_valid(response) THEN coalesce(array_to_string(json_extract_string(response, '$.keywords[*]'), '|'), '')
       ELSE '' END AS keywords,
  coalesce(CASE WHEN json_valid(response) THEN json_extract_string(response, '$.degree') END, 'national') AS article_degree,
  coalesce(CASE WHEN json_valid(response) THEN json_extract_string(response, '$.researcher_role') END, 'participant')
    AS researcher_role,
  coalesce(CASE WHEN json_valid(response) THEN json_extract_string(response, '$.typerole') END, 'unknown') AS typerole,
  coalesce(CASE WHEN json_valid(response) THEN json_extract_string(response, '$.Medium_type') END, 'Web') AS Medium_type
  FROM resp)
"""


@register("response_parse", sql=f"WITH {_RESP_SQL} SELECT * FROM parsed")
def q_response_parse(spark, data_dir):
    r = _responses(Tables(spark, data_dir)).select("event_id", parse_response("response").alias("p"))
    return r.select("event_id", F.array_join("p.keywords", "|").alias("keywords"), "p.article_degree",
                    "p.researcher_role", "p.typerole", "p.Medium_type")


@register("label_normalise", sql=f"""WITH {_RESP_SQL}
SELECT event_id,
  CASE WHEN researcher_role IN ('research cited', 'researchcited') THEN 'researchcited'
       WHEN researcher_role IN ('author', 'interviewee') THEN researcher_role ELSE 'participant' END AS researcher_role,
  CASE WHEN researcher_role IN ('research cited', 'researchcited') THEN 'Coverage' ELSE 'Contribution' END AS media_type,
  CASE typerole WHEN 'public engagement activity' THEN 'publicengagement' WHEN 'expert comment' THEN 'exportcomment'
                WHEN 'unknown' THEN 'other' ELSE typerole END AS typerole,
  'yes' AS goodfit, Medium_type, article_degree,
  CASE Medium_type """ + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in C.MEDIATYPE_RENAMES.items()) + """ ELSE Medium_type END AS medium_renamed
FROM parsed""")
def q_label_normalise(spark, data_dir):
    r = _responses(Tables(spark, data_dir)).select("event_id", normalise_labels(parse_response("response")).alias("l"))
    return r.select("event_id", "l.researcher_role", "l.media_type", "l.typerole", "l.goodfit", "l.Medium_type",
                    "l.article_degree", rename_mediatype("l.Medium_type").alias("medium_renamed"))


# --- lookups --------------------------------------------------------------------------

def _mail_paths(t):
    seg = F.regexp_extract("url", r"^https?://[^/]+/([^/?#]+)", 1)
    label = F.when(seg == "en", "Beta 1").when(seg == "fr", "GEO").when(seg == "de", "Rechten")
    name = F.when(label.isNotNull(), F.concat(F.lit("Alert faculteit "), label, F.lit(" - "),
                                              F.col("page_id").cast("string"), F.lit(".eml"))) \
        .otherwise(F.concat(F.lit("Alert "), F.col("page_id").cast("string"), F.lit(".eml")))
    return t.pages.select("page_id", F.concat(F.lit("/mail/2025/"), name).alias("path"))


_PATHS_SQL = r"""
segs AS (SELECT page_id, regexp_extract(url, '^https?://[^/]+/([^/?#]+)', 1) AS seg FROM pages),
paths AS (SELECT page_id, '/mail/2025/' || CASE WHEN seg IN ('en', 'fr', 'de') THEN
            'Alert faculteit ' || CASE seg WHEN 'en' THEN 'Beta 1' WHEN 'fr' THEN 'GEO' ELSE 'Rechten' END
            || ' - ' || page_id || '.eml' ELSE 'Alert ' || page_id || '.eml' END AS path FROM segs),
labels AS (SELECT page_id, CASE WHEN regexp_matches(path, 'faculteit (.*?) -')
                  THEN trim(regexp_extract(path, 'faculteit (.*?) -', 1)) END AS label FROM paths),
codes AS (SELECT page_id, CASE WHEN label IS NULL THEN NULL ELSE CASE label WHEN 'Beta 1' THEN 'BETA'
            WHEN 'Beta 2' THEN 'BETA' WHEN 'Beta 3' THEN 'BETA' WHEN 'DGK' THEN 'DGK' WHEN 'FSW' THEN 'FSW'
            WHEN 'GEO' THEN 'GEO' WHEN 'GW' THEN 'GW' WHEN 'REBO' THEN 'REBO' ELSE label END END AS faculty FROM labels)
"""


@register("group_codes", sql=f"WITH {_PATHS_SQL} SELECT page_id, faculty FROM codes")
def q_group_codes(spark, data_dir):
    return _mail_paths(Tables(spark, data_dir)).select("page_id", faculty_code("path").alias("faculty"))


@register("workflow_lookup", sql=f"""WITH {_PATHS_SQL}
SELECT page_id, faculty, coalesce(CASE faculty WHEN 'GEO' THEN 'entryInProgress' WHEN 'GW' THEN 'entryInProgress'
  WHEN 'FSW' THEN 'entryInProgress' WHEN 'REBO' THEN 'forApproval' WHEN 'BETA' THEN 'forApproval'
  WHEN 'DGK' THEN 'approved' END, 'approved') AS workflow FROM codes""")
def q_workflow_lookup(spark, data_dir):
    g = _mail_paths(Tables(spark, data_dir)).select("page_id", faculty_code("path").alias("faculty"))
    return g.select("page_id", "faculty", workflow("faculty").alias("workflow"))


@register("source_urls", sql="""
SELECT doc_id, source, CASE WHEN n_chars > 10000 THEN 'https://docs.example/' || doc_id
  ELSE coalesce(CASE lower(source) """ + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SOURCE_MAP_STANDIN.items())
          + """ END, '') END AS url
FROM documents""")
def q_source_urls(spark, data_dir):
    d = Tables(spark, data_dir).documents
    arts = d.select("doc_id", "source", F.when(F.col("n_chars") > 10000, F.concat(
        F.lit("https://docs.example/"), F.col("doc_id").cast("string"))).otherwise(F.lit("")).alias("url"))
    return fill_source_urls(arts, mapping=SOURCE_MAP_STANDIN)


@register("dictionary_tags", sql="""
SELECT doc_id, array_to_string(CASE WHEN len(h) > 0 THEN h ELSE ['not found'] END, '|') AS tags FROM
  (SELECT doc_id, list_sort(list_filter([""" + ", ".join(S.q(n) for n in TAG_NAMES_STANDIN) + """],
                                        lambda n: contains(text, n))) AS h FROM documents)""")
def q_dictionary_tags(spark, data_dir):
    d = Tables(spark, data_dir).spread("documents", "doc_id", "text")
    return d.select("doc_id", F.array_join(dictionary_tags("text", TAG_NAMES_STANDIN), "|").alias("tags"))


@register("table_tags", sql=r"""
WITH tok AS (SELECT item_id, list_filter(string_split_regex(text, '[ \t\r\n]+'), lambda t: t <> '') AS ws FROM benchmark),
names AS (SELECT unnest(ws) AS name FROM tok
          UNION SELECT ws[i] || ' ' || ws[i + 1] FROM (SELECT ws, unnest(range(1, len(ws))) AS i FROM tok)
          UNION SELECT p_type FROM part)
SELECT doc_id, name FROM documents JOIN names ON contains(text, name)
""")
def q_table_tags(spark, data_dir):
    """Dictionary table: every word and pair of neighbouring words of the benchmark, and part types."""
    t = Tables(spark, data_dir)
    ws = F.filter(F.split("text", "[ \\t\\r\\n]+"), lambda x: x != "")
    tok = t.benchmark.select(ws.alias("ws"))
    pairs = F.zip_with(F.slice("ws", 1, F.size("ws") - 1), F.slice("ws", 2, F.size("ws")), lambda a, b: F.concat(a, F.lit(" "), b))
    names = (tok.select(F.explode("ws").alias("name")).unionByName(tok.where(F.size("ws") > 1).select(F.explode(pairs).alias("name")))
             .unionByName(t.part.select(F.col("p_type").alias("name"))))
    return table_tags(t.spread("documents", "doc_id", "text"), names, "doc_id", "text")
