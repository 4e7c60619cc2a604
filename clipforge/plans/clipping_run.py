"""The whole article run over mail files, composed from the operators.

mails -> article blocks -> cleaned articles -> language filter -> block lists ->
mentions -> resolution against the directory -> published check -> status ->
keep-first on (title, URL) -> prompts, labels -> JSON payloads and XML clippings.

Inputs are tables: the person directory and organisations in their nested
schemas (``operators/entities``), published items (``uuid, title.text[].value,
period.startDate, personAssociations[].person{externalId, internalId}``), a
learned language profile, and optionally classifier answers
``(article_id, response)``. Nothing here is registered as a query: the driver
tables hold no mails; ``tests/test_clipping_run.py`` runs it on fixture mails.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clipforge.functions import constants as C
from clipforge.operators.blocklists import drop_blocked_sources, drop_blocked_titles
from clipforge.operators.duplicates import keep_first, published_article_ids, published_table
from clipforge.operators.entities import nest_resolved, resolve_mentions
from clipforge.operators.keywords import keyword_candidates, top_keywords
from clipforge.operators.labels import fixed_labels, names_and_orgs, normalise_labels, page_text, parse_response, \
    prompt_text
from clipforge.operators.language import filter_languages, identify_language
from clipforge.operators.lookups import fill_source_urls
from clipforge.operators.mentions import clean_mentions, raw_mentions
from clipforge.operators.ordering import positions
from clipforge.operators.records import dedup_clippings, payload_json, record_ids, write_xml, xml_clipping
from clipforge.operators.status import article_status, status_counts
from clipforge.session import RunMetrics
from clipforge.sources.mail import extract_blocks, read_mails
from clipforge.streaming.intake import articles_from_blocks


def _numbered(blocks: DataFrame, run: RunMetrics) -> DataFrame:
    """Articles with ``article_id`` (text) and ``article_no``, the place of the block in the
    order of files and of blocks within a file (numbers, not text: block 10 follows 9)."""
    arts = articles_from_blocks(blocks).withColumn(
        "article_id", F.concat_ws("#", F.col("path"), F.col("block_no").cast("string")))
    arts = run.written(arts, "extracted")
    numbers = positions(arts.select("article_id", "path", "block_no"), ["path", "block_no"], out_col="article_no")
    return arts.join(numbers.select("article_id", "article_no"), "article_id")


def process_mails(spark: SparkSession, mail_folder: str, directory: DataFrame, organisations: DataFrame,
                  published: DataFrame, language_profile: DataFrame, *, run_stamp: str,
                  allowed_languages=C.ALLOWED_LANGUAGES, blocked_sources: DataFrame | None = None,
                  blocked_words: DataFrame | None = None, stopwords: DataFrame | None = None,
                  responses: DataFrame | None = None, pages: DataFrame | None = None, blacklist=C.BLACKLIST_NAMES,
                  patterns=C.UNWANTED_TERM_PATTERNS, xml_path: str | None = None) -> dict[str, DataFrame]:
    """Run the article flow; returns the intermediate and final tables, and ``metrics``: rows
    and seconds of the phases extracted, filtered, resolved and ok.

    ``pages`` (url, text): fetched pages, one row per URL; the prompts of a classifier
    take their excerpt from there, or from the title. Stop words default to English."""
    run = RunMetrics(spark)
    arts = _numbered(extract_blocks(read_mails(spark, mail_folder)), run)
    lang = identify_language(arts, "article_id", "title", language_profile)
    arts = arts.join(filter_languages(lang, "lang", allowed_languages).select("article_id", F.col("lang").alias("language")),
                     "article_id")
    if blocked_sources is not None:
        arts = drop_blocked_sources(arts, blocked_sources)
    if blocked_words is not None:
        arts = drop_blocked_titles(arts, blocked_words, title_col="title", key_col="article_id")
    # every later stage reads the articles
    arts = run.written(fill_source_urls(arts), "filtered")

    raw = arts.select("article_id", raw_mentions("labelled_text", "block_text", "highlighted").alias("names"))
    mentions = clean_mentions(raw, "article_id", "names", blacklist=blacklist, patterns=patterns)
    mentions = mentions.join(arts.select("article_id", "ts"), "article_id") \
        .withColumn("mention_pos", F.dense_rank().over(Window.partitionBy("article_id").orderBy("first_pos", "mention")))
    kept, unresolved, errors = resolve_mentions(mentions, directory, organisations)
    kept = run.written(kept, "resolved")
    nested = nest_resolved(kept)

    with_persons = arts.join(nested.drop("malformed"), "article_id", "left") \
        .withColumn("persons", F.coalesce("persons", F.array().cast(nested.schema["persons"].dataType))) \
        .withColumn("person_ids", F.transform("persons", lambda p: p["employee_id"]))
    dup = published_article_ids(with_persons, published_table(published), id_col="article_id", title_col="title",
                                ts_col="ts", persons_col="person_ids", pub_title_col="pub_title",
                                pub_start_col="pub_start", pub_persons_col="pub_persons")
    marked = with_persons.join(dup.withColumn("dup", F.lit(True)), "article_id", "left") \
        .withColumn("dup", F.coalesce("dup", F.lit(False))) \
        .join(errors.withColumn("malformed", F.lit(True)), "article_id", "left") \
        .withColumn("malformed", F.coalesce("malformed", F.lit(False)))
    status = article_status(marked, "persons", "dup", "malformed")
    ok = keep_first(status.where(F.col("status") == "ok").drop("labelled_text", "block_text", "highlighted"),
                    ["title", "url"], "article_no")
    ok = run.written(ok, "ok")
    fetched = pages if pages is not None else spark.createDataFrame([], "url string, text string")
    names, orgs = names_and_orgs("persons")
    prompts = page_text(ok, fetched).select("article_id", prompt_text("title", "source", names, orgs, "excerpt").alias("prompt"))

    if responses is not None:
        labelled = ok.join(responses, "article_id", "left") \
            .withColumn("labels", normalise_labels(parse_response("response")))
    else:
        sw = stopwords if stopwords is not None else spark.createDataFrame([(w,) for w in C.ENGLISH_STOPWORDS], "word string")
        kw = top_keywords(keyword_candidates(ok, "article_id", "title", sw), "article_id")
        labelled = ok.join(kw, "article_id", "left") \
            .withColumn("labels", fixed_labels(F.coalesce("keywords", F.array().cast("array<string>"))))

    payloads = labelled.select("article_id", payload_json("title", "url", "ts", "persons", "source", "faculty",
                                                          "language", "labels").alias("payload"))
    ids = record_ids(labelled, ["article_no"], run_stamp)
    clips = dedup_clippings(ids, "title", "persons", "record_no") \
        .select("record_no", xml_clipping("record_id", "title", "ts", "persons", "source", "url", "labels")
                .alias("clipping"))
    if xml_path:
        write_xml(clips, xml_path)
    return {"articles": arts, "resolved": kept, "unresolved": unresolved, "status": status,
            "status_counts": status_counts(status), "ok": labelled, "prompts": prompts, "payloads": payloads, "clippings": clips, "metrics": run.table()}
