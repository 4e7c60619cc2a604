"""Classification seam: page text, prompt table, response parsing, label rules.

The model call itself is outside Spark; prompts are written as a table and
responses come back as a table keyed by article.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipforge.functions import constants as C
from clipforge.functions.text import col_

RESPONSE_SCHEMA = ("keywords array<string>, degree string, researcher_role string, typerole string, "
                   "Medium_type string")


def page_text(articles: DataFrame, pages: DataFrame, url_col: str = "url", title_col: str = "title",
              page_url_col: str = "url", text_col: str = "text",
              max_chars: int = C.EXCERPT_MAX_CHARS) -> DataFrame:
    """Adds ``excerpt``: the first ``max_chars`` characters of the fetched page
    text, or of the title when the URL is empty or no page was fetched.
    ``pages`` holds one row per URL (see ``duplicates.keep_first``)."""
    p = pages.select(F.col(page_url_col).alias("_u"), F.col(text_col).alias("_text"))
    j = articles.join(p, articles[url_col] == p["_u"], "left")
    txt = F.when((F.col(url_col).isNull()) | (F.col(url_col) == ""), F.col(title_col)) \
        .otherwise(F.coalesce("_text", F.col(title_col)))
    return j.withColumn("excerpt", F.substring(txt, 1, max_chars)).drop("_u", "_text")


def _template_parts(template: str):
    out, pos = [], 0
    for m in re.finditer(r"\{(\w+)\}", template):
        out.append(("lit", template[pos:m.start()]))
        out.append(("col", m.group(1)))
        pos = m.end()
    out.append(("lit", template[pos:]))
    return out


def prompt_text(title, source, names, organizations, excerpt, template: str = C.PROMPT_TEMPLATE) -> Column:
    cols = {"title": col_(title), "source": col_(source), "names": col_(names),
            "organizations": col_(organizations), "excerpt": col_(excerpt)}
    return F.concat(*[F.lit(v) if k == "lit" else F.coalesce(cols[v], F.lit("")) for k, v in _template_parts(template)])


def names_and_orgs(persons) -> tuple[Column, Column]:
    """Comma lists of person names and of all their organisation names (duplicates kept)."""
    p = col_(persons)
    names = F.array_join(F.transform(p, lambda x: x["name"]), ", ")
    orgs = F.array_join(F.flatten(F.transform(p, lambda x: F.transform(x["affiliations"], lambda a: a["orgname"]))),
                        ", ")
    return names, orgs


def parse_response(response) -> Column:
    """Struct of the classifier's answer with defaults for missing keys and for
    answers that are not JSON."""
    r = F.from_json(col_(response), RESPONSE_SCHEMA)
    d = C.RESPONSE_DEFAULTS
    return F.struct(F.coalesce(r["keywords"], F.array().cast("array<string>")).alias("keywords"),
                    F.coalesce(r["degree"], F.lit(d["degree"])).alias("article_degree"),
                    F.coalesce(r["researcher_role"], F.lit(d["researcher_role"])).alias("researcher_role"),
                    F.coalesce(r["typerole"], F.lit(d["typerole"])).alias("typerole"),
                    F.coalesce(r["Medium_type"], F.lit(d["Medium_type"])).alias("Medium_type"))


def _rename(c: Column, mapping: dict) -> Column:
    out = c
    for k, v in mapping.items():
        out = F.when(c == k, F.lit(v)).otherwise(out)
    return out


def rename_typerole(c) -> Column:
    return _rename(col_(c), C.TYPEROLE_RENAMES)


def rename_mediatype(c) -> Column:
    return _rename(col_(c), C.MEDIATYPE_RENAMES)


def normalise_labels(parsed) -> Column:
    """Role rule (research cited -> researchcited + Coverage; author/interviewee
    kept; anything else participant; those -> Contribution), type-role rename,
    goodfit always yes."""
    p = col_(parsed)
    role = p["researcher_role"]
    cited = role.isin(*C.ROLE_RESEARCH_CITED)
    new_role = F.when(cited, F.lit(C.ROLE_RESEARCH_CITED_LABEL)).when(role.isin(*C.ROLES_KEPT), role) \
        .otherwise(F.lit(C.ROLE_OTHERWISE))
    media = F.when(cited, F.lit(C.MEDIA_TYPE_CITED)).otherwise(F.lit(C.MEDIA_TYPE_OTHERWISE))
    return F.struct(p["keywords"].alias("keywords"), p["article_degree"].alias("article_degree"),
                    new_role.alias("researcher_role"), media.alias("media_type"),
                    rename_typerole(p["typerole"]).alias("typerole"), F.lit(C.GOODFIT).alias("goodfit"),
                    p["Medium_type"].alias("Medium_type"))


def fixed_labels(keywords) -> Column:
    """Labels when classification is switched off."""
    d = C.NO_CLASSIFIER_LABELS
    return F.struct(col_(keywords).alias("keywords"), F.lit(d["article_degree"]).alias("article_degree"),
                    F.lit(d["researcher_role"]).alias("researcher_role"), F.lit(d["media_type"]).alias("media_type"),
                    F.lit(d["typerole"]).alias("typerole"), F.lit(d["goodfit"]).alias("goodfit"),
                    F.lit(d["Medium_type"]).alias("Medium_type"))


__all__ = ["page_text", "prompt_text", "names_and_orgs", "parse_response", "normalise_labels",
           "fixed_labels", "rename_typerole", "rename_mediatype"]
