"""``(A1 OR A2 ...) NEAR/k (B1 OR B2 ...)`` over a documents table, many queries at once.

Queries are rows of a phrase table: (query, side, phrase) with side ``a`` or ``b``, written
by hand or read back from query texts (:func:`parsed_queries`). Phrases are lower-case word
sequences; a document's words are its runs of letters, lower-cased, numbered from 0. A
phrase occurs at ``p`` when words ``p .. p+len-1`` equal it. An A occurrence is a hit when
some B occurrence starts at most ``k`` words before or after it.

* Postings: the documents' words that stand in some phrase, with their positions, are
  written once; everything after reads them.
* A phrase is looked up by its rarest word (counted on the postings); its other words must
  then stand at their places, which is an equi-join on (document, position, word).
* Side B comes first. Queries with the same A side share it: its places are marked in a bit
  array per document with running counts, and a B occurrence reads from it how many it
  reaches that the B occurrence before it does not. The work follows the B occurrences; A
  occurrences are never laid beside queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipforge.functions import constants as C
from clipforge.functions.text import WORD, words_of
from clipforge.session import written


def _occurrences(docs: DataFrame, id_col: str, text_col: str, phrases: DataFrame) -> DataFrame:
    """(_id, ph, at) of every phrase (ph, ws: its words) in the documents."""
    places = phrases.select("ph", F.size("ws").alias("len"), F.posexplode("ws").alias("i", "tok"))
    words = docs.select(F.col(id_col).alias("_id"),
                        F.posexplode(F.regexp_extract_all(F.lower(text_col), F.lit(WORD), 0)).alias("pos", "tok"))
    postings = written(words.where(F.col("_id").isNotNull()).join(places.select("tok").distinct(), "tok", "left_semi"), "postings")
    common = postings.groupBy("tok").agg(F.count(F.lit(1)).alias("n"))
    rarest = (places.join(common, "tok").groupBy("ph", "len").agg(F.min(F.struct("n", "i", "tok")).alias("w"))
              .select("ph", "len", F.col("w.i").alias("i"), F.col("w.tok").alias("tok")))
    found = (postings.join(rarest, "tok").where(F.col("pos") >= F.col("i"))
             .select("_id", "ph", "len", (F.col("pos") - F.col("i")).alias("at"), "i"))
    rest = (found.where("len > 1").join(places.select("ph", F.col("i").alias("j"), "tok"), "ph").where("i <> j")
            .select("_id", "ph", "len", "at", (F.col("at") + F.col("j")).alias("pos"), "tok"))
    whole = (rest.join(postings, ["_id", "pos", "tok"]).groupBy("_id", "ph", "len", "at").agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("n") == F.col("len") - 1).select("_id", "ph", "at"))
    return found.where("len = 1").select("_id", "ph", "at").unionByName(whole)


def _marks(a: DataFrame) -> DataFrame:
    """(_id, side_id, marks) of the places ``a``: for every 64 places from 0 a long with a bit for
    each that is marked, and the number of marks before it."""
    block = a.groupBy("_id", "side_id", F.floor(F.col("a") / 64).alias("block")).agg(
        F.bit_or(F.expr("shiftleft(1L, a % 64)")).alias("bits"))
    last = block.groupBy("_id", "side_id").agg(F.max("block").alias("last"))
    empty = last.select("_id", "side_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last") + 1)).alias("block"), F.lit(0).cast("long").alias("bits"))
    every = block.unionByName(empty).groupBy("_id", "side_id", "block").agg(F.bit_or("bits").alias("bits"))
    w = Window.partitionBy("_id", "side_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    every = every.withColumn("before", F.coalesce(F.sum(F.bit_count("bits")).over(w), F.lit(0)))
    return (every.groupBy("_id", "side_id").agg(F.sort_array(F.collect_list(F.struct("block", "bits", "before"))).alias("m"))
            .select("_id", "side_id", F.col("m.bits").alias("bits"), F.col("m.before").alias("marks")))


def _marks_to(at: Column) -> Column:
    """The number of marks at places up to ``at`` (long) of a row of :func:`_marks`; its last long is empty."""
    block = F.least(F.shiftright(at, 6), F.size("bits") - 1).cast("int")
    upto = F.call_function("shiftrightunsigned", F.lit(-1).cast("long"), (63 - at.bitwiseAND(F.lit(63))).cast("int"))
    return F.when(at < 0, 0).otherwise(F.get("marks", block) + F.bit_count(F.get("bits", block).bitwiseAND(upto)))


def proximity_hits(docs: DataFrame, id_col: str, text_col: str, phrases: DataFrame,
                   distance: int = C.NEAR_DISTANCE) -> DataFrame:
    """(query, id, hits): documents with at least one A occurrence near a B occurrence of
    a query; ``hits`` counts such A occurrences (positions).

    ``phrases``: (query, side, phrase), and the query's own distance where it has a column
    ``near``. Phrases without a word are ignored; a document id names one document."""
    near = F.col("near") if "near" in phrases.columns else F.lit(distance)
    p = phrases.select("query", "side", near.cast("int").alias("near"), words_of(F.lower("phrase")).alias("ws")).where(F.size("ws") > 0)
    p = written(p.withColumn("ph", F.xxhash64("ws")).distinct(), "phrases")
    occurs = written(_occurrences(docs, id_col, text_col, p.select("ph", "ws").distinct()), "occurrences")

    # Queries of one A side and distance share the marks of that side.
    sides = p.where("side = 'a'").groupBy("query", "near").agg(F.sort_array(F.collect_set("ph")).alias("phs"))
    # A query goes through the shuffle as a number.
    sides = sides.select("query", "near", F.xxhash64("near", "phs").alias("side_id"), "phs", F.monotonically_increasing_id().alias("no"))
    sides = written(sides, "sides")
    a = sides.select("side_id", F.explode("phs").alias("ph")).distinct().join(occurs, "ph").select("_id", "side_id", F.col("at").alias("a"))
    # A B occurrence counts the A occurrences that it reaches and the one before it does not.
    b = (p.where("side = 'b'").select("query", "ph").distinct().join(sides.select("query", "side_id", "near", "no"), "query").join(occurs, "ph")
         .select("_id", "side_id", "no", F.col("near").cast("long").alias("near"), F.col("at").cast("long").alias("at")).repartition("_id", "side_id").distinct())
    w = Window.partitionBy("_id", "side_id", "no").orderBy("at")
    b = b.withColumn("before", F.lag("at").over(w)).withColumn("after", F.lead("at").over(w))
    low, high = F.col("at") - F.col("near"), F.col("at") + F.col("near")
    b = b.select("_id", "side_id", "no", "at", high.alias("high"), F.greatest(low - 1, F.col("before") + F.col("near")).alias("low"),
                 (F.coalesce(F.col("before") < low, F.lit(True)) & F.coalesce(F.col("after") > high, F.lit(True))).alias("alone"))
    itself = F.when(F.col("alone"), _marks_to(F.col("at")) - _marks_to(F.col("at") - 1)).otherwise(0)
    met = b.join(_marks(a), ["_id", "side_id"]).select("_id", "side_id", "no", (_marks_to(F.col("high")) - _marks_to(F.col("low")) - itself).alias("n"))
    met = met.groupBy("_id", "side_id", "no").agg(F.sum("n").alias("n")).where("n > 0").join(sides.select("no", "query"), "no")
    return met.groupBy("query", "_id").agg(F.sum("n").alias("hits")).withColumnRenamed("_id", id_col)


#: What :func:`operators.units.unit_queries` writes: two lists of quoted phrases around NEAR/k.
QUERY_TEXT = r'^\s*\("(.*?)"\)\s+NEAR/([0-9]+)\s+\("(.*)"\)\s*$'
LIST_OR = r'"\s+OR\s+"'


def parsed_queries(queries: DataFrame, query_col: str = "query_id", text_col: str = "query") -> DataFrame:
    """(query, side, phrase, near) of written query texts, the input of :func:`proximity_hits`.

    Phrases end where a quote is followed by ``OR`` and the next quote, so a name may hold
    quotes itself. A text of another form gives one row with null side, phrase and near."""
    part = lambda g: F.regexp_extract(F.col(text_col), f"(?s){QUERY_TEXT}", g)
    fits = F.coalesce(F.col(text_col).rlike(f"(?s){QUERY_TEXT}"), F.lit(False))
    side = lambda name, g: F.transform(F.split(part(g), LIST_OR), lambda x: F.struct(F.lit(name).alias("side"), x.alias("phrase")))
    none = F.array(F.struct(F.lit(None).cast("string").alias("side"), F.lit(None).cast("string").alias("phrase")))
    return (queries.select(F.col(query_col).alias("query"), F.when(fits, part(2)).cast("int").alias("near"),
                           F.explode(F.when(fits, F.concat(side("a", 1), side("b", 3))).otherwise(none)).alias("p"))
            .select("query", "p.side", "p.phrase", "near"))


def search_texts(docs: DataFrame, id_col: str, text_col: str, queries: DataFrame, query_col: str = "query_id", query_text_col: str = "query") -> DataFrame:
    """(query, id, hits) of written query texts over documents; texts of another form find nothing."""
    parsed = parsed_queries(queries, query_col, query_text_col)
    return proximity_hits(docs, id_col, text_col, parsed.where(F.col("phrase").isNotNull()))


def query_phrases(members: DataFrame, limit: int = C.NAMES_PER_QUERY, name_en: str = C.INSTITUTION_NAME_ENGLISH,
                  name_nl: str = C.INSTITUTION_NAME_DUTCH) -> DataFrame:
    """The phrase table of the queries that :func:`operators.units.unit_queries` writes:
    side a the institution's names, side b the names of one chunk of a faculty."""
    from clipforge.operators.units import numbered_names
    n = numbered_names(members, limit).select(F.concat_ws("#", "faculty", F.col("chunk").cast("string")).alias("query"), "name_variant")
    b = n.select("query", F.lit("b").alias("side"), F.col("name_variant").alias("phrase"))
    a = n.select("query").distinct().select("query", F.lit("a").alias("side"),
                                            F.explode(F.array(F.lit(name_en), F.lit(name_nl))).alias("phrase"))
    return a.unionByName(b)
