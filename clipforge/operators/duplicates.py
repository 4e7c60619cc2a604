"""Already-published check and keep-first deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipforge.functions.text import title_key


def published_article_ids(articles: DataFrame, published: DataFrame, id_col: str, title_col: str,
                          ts_col: str, persons_col: str, pub_title_col: str, pub_start_col: str,
                          pub_persons_col: str) -> DataFrame:
    """Ids of articles with a published item of equal title key, equal calendar
    day and at least one shared person id.

    Items without a title or start date, and person entries without an id, are
    ignored (``pub_persons_col`` is an array that lists external and internal ids).
    Both sides are exploded to (day, person) and reduced to rows whose day and
    person the other side has; title keys are computed for those only.
    """
    a = (articles.select(F.col(id_col).alias("_id"), F.col(title_col).alias("_title"), F.to_date(ts_col).alias("_day"),
                         F.explode(persons_col).alias("_pid")).where(F.col("_pid").isNotNull() & F.col("_title").isNotNull()))
    p = (published.select(F.col(pub_title_col).alias("_title"), F.to_date(pub_start_col).alias("_day"),
                          F.explode(pub_persons_col).alias("_pid"))
         .where(F.col("_pid").isNotNull() & F.col("_day").isNotNull() & (F.col("_title") != "")))
    there = ["_day", "_pid"]
    a_near = a.join(p.select(*there).distinct(), there, "left_semi")
    p_near = p.join(a.select(*there).distinct(), there, "left_semi")
    pk = p_near.select(title_key("_title").alias("_key"), *there).distinct()
    return a_near.withColumn("_key", title_key("_title")).join(pk, ["_key", *there], "left_semi").select(F.col("_id").alias(id_col)).distinct()


def published_table(items: DataFrame, *keep: str) -> DataFrame:
    """(keep..., pub_title, pub_start, pub_persons) from published items in their nested schema; a
    missing title, date or person is null or left out."""
    ids = F.flatten(F.transform(F.filter(F.coalesce("personAssociations", F.array()), lambda a: a["person"].isNotNull()),
                                lambda a: F.array(a["person"]["externalId"], a["person"]["internalId"])))
    return items.select(*keep, F.try_element_at(F.col("title.text"), F.lit(1))["value"].alias("pub_title"),
                        F.to_date(F.substring("period.startDate", 1, 10)).alias("pub_start"),
                        F.filter(ids, lambda x: x.isNotNull()).alias("pub_persons"))


def already_published(articles: DataFrame, published: DataFrame, **kw) -> DataFrame:
    ids = published_article_ids(articles, published, **kw)
    return articles.join(ids, kw["id_col"], "left_semi")


def not_yet_published(articles: DataFrame, published: DataFrame, **kw) -> DataFrame:
    ids = published_article_ids(articles, published, **kw)
    return articles.join(ids, kw["id_col"], "left_anti")


def item_by_id(items: DataFrame, ids: DataFrame, id_col: str, ids_col: str | None = None) -> DataFrame:
    """Items whose id is in the id table (a semi join; each id at most once)."""
    k = ids.select(F.col(ids_col or id_col).alias(id_col)).distinct()
    return items.join(k, id_col, "left_semi")


def keep_first(df: DataFrame, key_cols: list, order_col: str) -> DataFrame:
    """One row per key: the row with the smallest ``order_col``, a number or time. A null
    comes after every number; of rows that tie, and of a key with nulls only, any one stays.

    The smallest number per key is a hash aggregate with partial sums, so a key that
    holds a third of the rows is reduced before the shuffle, and no row is sorted or
    carried through the aggregate; the rows are then picked by a semi join. A null in a
    key is a value like any other.
    """
    first = df.groupBy(*key_cols).agg(F.min(order_col).alias("_first"))
    first = first.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(key_cols)], "_first")
    same = F.col(order_col).eqNullSafe(F.col("_first"))
    for i, c in enumerate(key_cols):
        same = same & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    return df.join(first, same, "left_semi").dropDuplicates(key_cols)
