"""Quality rules by distribution divergence, in DataFrame expressions only.

Two histograms of a document -- its characters by class and its words over the
language's common words -- are compared with those of its language by
Jensen-Shannon distance (base 2, 0 to 1). Documents under a minimum length are not
judged by the distances, whose small-sample noise would reject clean text.

References are built from all documents. A language's common words are the words
with at least ``COMMON_SHARE`` of its words, so there are at most 1 / COMMON_SHARE
of them: the joined side has a proven bound per language and its measured size
decides on a broadcast.

The repeated-window rule runs inside the row: windows are hashed to longs, and
only documents in which some hash repeats sort their windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipforge.llm.common import broadcast_if_small, stored, unused

WORD_BREAK = r"[\x20\x09-\x0D]+"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

#: Words of a document from which on the distances count.
MIN_WORDS_JUDGED = 50
#: Words of a language from which on it has a reference of its own.
MIN_WORDS_REFERENCE = 1000
COMMON_SHARE = 0.004
MAX_CLASS_DISTANCE = 0.3
MAX_WORD_DISTANCE = 0.45

#: Character classes that are counted; what is left over is ASCII lower case and control characters.
CLASSES = {
    "c_space": r"[\x20\x09-\x0D]+",
    "c_upper": r"[A-Z]+",
    "c_digit": r"[0-9]+",
    "c_symbol": r"[#*$%&|<>]+",
    "c_punct": r"[!\"'()+,\-./:;=?@\[\\\]^_`{}~]+",
    "c_other": r"[^\x00-\x7F]+",
}
BINS = [*CLASSES, "c_lower"]


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, WORD_BREAK, -1), "")


def _covered(windows: Column) -> Column:
    """Words inside the windows whose hash occurs twice or more: the sorted starts of
    such windows each cover up to ``WINDOW`` words until the next start."""
    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(s: Column) -> Column:
        same = lambda x, k: ((k > 0) & (s[F.greatest(k - 1, F.lit(0))]["h"] == x["h"])) | (
            (k + 1 < F.size(s)) & (s[F.least(k + 1, F.size(s) - 1)]["h"] == x["h"]))
        return F.sort_array(F.transform(F.filter(s, same), lambda x: x["i"]))

    def total(p: Column) -> Column:
        spans = F.transform(p, lambda v, k: F.when(k + 1 < F.size(p), F.least(p[F.least(k + 1, F.size(p) - 1)] - v, F.lit(WINDOW))).otherwise(WINDOW))
        return F.aggregate(spans, F.lit(0).cast("long"), lambda a, x: a + x)

    return _let(_let(ordered, starts), total)


def features(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, doc_key (hash of id and text), lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the
    character classes of each document (long). Null text has no words, lines or characters."""
    t = F.coalesce(F.col(text), F.lit(""))
    d = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(id_col), F.col(text)).alias("doc_key"), F.col(lang).alias("lang"), t.alias("t"))
    d = d.select("*", _words(F.col("t")).alias("w"))
    d = d.select("*", F.size("w").cast("long").alias("n_words"), F.transform("w", lambda x: F.xxhash64(x)).alias("hw"))
    h = F.col("hw")
    d = d.withColumn("g", F.when(F.size(h) >= WINDOW, F.transform(
        F.slice(h, 1, F.greatest(F.size(h) - (WINDOW - 1), F.lit(1))),
        lambda x, i: F.xxhash64(x, *[h[i + k] for k in range(1, WINDOW)]))))
    n = F.length("t")
    lines = F.filter(F.split("t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = d.select("doc_id", "doc_key", "lang", "n_words", n.alias("n"),
                 *[(n - F.length(F.regexp_replace("t", p, ""))).cast("long").alias(c) for c, p in CLASSES.items()],
                 _let(lines, lambda a: (F.size(a) - F.size(F.array_distinct(a))).cast("long")).alias("n_dup_lines"),
                 F.when(F.size("g") == F.size(F.array_distinct("g")), F.lit(0).cast("long"))
                 .when(F.col("g").isNull(), F.lit(0).cast("long"))
                 .otherwise(_covered(F.col("g"))).alias("n_repeat_words"))
    return d.select("doc_id", "doc_key", "lang", "n_words", (F.col("n") - F.col("c_space")).cast("long").alias("word_chars"),
                    F.col("c_symbol").alias("n_symbols"), "n_dup_lines", "n_repeat_words", *CLASSES,
                    (F.col("n") - sum(F.col(c) for c in CLASSES)).cast("long").alias("c_lower"))


def _term(p: Column, q: Column) -> Column:
    """One bin's share of the Jensen-Shannon divergence."""
    m = (p + q) / 2
    part = lambda x: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    return (part(p) + part(q)) / 2


def references(docs: DataFrame, feats: DataFrame, text: str = "text", lang: str = "lang",
               min_words: int = MIN_WORDS_REFERENCE, share: float = COMMON_SHARE) -> tuple[DataFrame, DataFrame]:
    """Class histogram per reference (ref, r_<class>, common) and common words (ref, word, q).

    A reference is a language with enough words, or ``*`` for all documents."""
    # explode_outer: for the plain form the optimiser splits every text twice, to test for words
    words = docs.select(F.col(lang).alias("lang"), F.explode_outer(_words(F.col(text))).alias("word")).where("word is not null")
    counts = stored(words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")), "word_counts")
    per_lang = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    per_lang = per_lang.where(F.col("lang").isNotNull() & (F.col("total") >= min_words))
    per_lang = stored(per_lang, "language_totals")
    common = (counts.join(broadcast_if_small(per_lang, 64), "lang").where(F.col("n") >= F.lit(share) * F.col("total"))
              .select(F.col("lang").alias("ref"), "word", (F.col("n") / F.col("total")).alias("q")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    pooled = (counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= F.lit(share * total))
              .select(F.lit("*").alias("ref"), "word", (F.col("n") / F.lit(total)).alias("q")))
    common = stored(common.unionByName(pooled), "common_words")

    sums = [F.sum(c).cast("double").alias(c) for c in BINS]
    by_lang = feats.groupBy("lang").agg(F.sum("n_words").alias("total"), *sums)
    own = by_lang.where(F.col("lang").isNotNull() & (F.col("total") >= min_words)).withColumnRenamed("lang", "ref")
    every = by_lang.agg(F.sum("total").alias("total"), *[F.sum(c).alias(c) for c in BINS]).select(F.lit("*").alias("ref"), "total", *BINS)
    classes = own.unionByName(every.where("total is not null"))
    chars = sum(F.col(c) for c in BINS)
    classes = classes.select("ref", *[F.when(chars > 0, F.col(c) / chars).otherwise(0.0).alias(f"r_{c}") for c in BINS])
    classes = classes.join(common.groupBy("ref").agg(F.sum("q").alias("common")), "ref", "left").na.fill(0.0, ["common"])
    return stored(classes, "class_references"), common


def judge(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
          max_class: float = MAX_CLASS_DISTANCE, max_word: float = MAX_WORD_DISTANCE) -> DataFrame:
    """Features, ``base_failed``, both distances and ``kept`` of each document.

    ``base_failed``: under ten words, or more than a fifth of the words repeated. The
    distances are null for documents under ``MIN_WORDS_JUDGED`` words, which pass on the
    base rules alone. A null language, or one with few words, is compared with all
    documents. Null or empty text has no words and fails. Ids may be null or repeat:
    documents are told apart by ``doc_key``, which only exact repeats of a row share."""
    feats = stored(features(docs, id_col, text, lang), "quality_features")
    classes, common = references(docs, feats, text, lang)
    classes_b = broadcast_if_small(classes, 256)
    known = broadcast_if_small(classes.select(F.col("ref").alias("_known")), 64)
    at = lambda d: (d.join(known, F.col("lang") == F.col("_known"), "left")
                    .withColumn("ref", F.coalesce("_known", F.lit("*"))).drop("_known"))

    words = at(docs.select(F.xxhash64(F.col(id_col), F.col(text)).alias("doc_key"), F.col(lang).alias("lang"), F.col(text).alias("t")))
    words = words.select("doc_key", "ref", F.explode_outer(_words(F.col("t"))).alias("word"))
    longest = common.agg(F.coalesce(F.max(F.octet_length("word") + F.octet_length("ref")), F.lit(0))).first()[0]
    hits = (words.join(broadcast_if_small(common, longest + 64), ["ref", "word"])
            .groupBy("doc_key", "word").agg(F.count(F.lit(1)).alias("c"), F.max("q").alias("q")))
    # Repeats of a row count as often in ``hits`` as in ``copies``.
    f = (feats.where(F.col("n_words") >= MIN_WORDS_JUDGED).groupBy("doc_key")
         .agg(F.count(F.lit(1)).alias("copies"), *[F.max(c).alias(c) for c in ("lang", "n_words", *BINS)]))
    f = at(f).join(classes_b, "ref")
    sums = (hits.join(f.select("doc_key", "n_words", "copies"), "doc_key")
            .withColumn("p", F.col("c") / (F.col("n_words") * F.col("copies")))
            .groupBy("doc_key").agg(F.sum(_term(F.col("p"), F.col("q")) - F.col("q") / 2).alias("d"), F.sum("p").alias("p_common")))
    chars = sum(F.col(c) for c in BINS)
    far = (f.join(sums, "doc_key", "left").na.fill(0.0, ["d", "p_common"])
           .select("doc_key",
                   F.sqrt(F.greatest(F.lit(0.0), sum(_term(F.col(c) / chars, F.col(f"r_{c}")) for c in BINS))).alias("class_distance"),
                   F.sqrt(F.greatest(F.lit(0.0), F.col("d") + F.col("common") / 2 + _term(
                       F.greatest(F.lit(0.0), 1 - F.col("p_common")), F.greatest(F.lit(0.0), 1 - F.col("common"))))).alias("word_distance")))
    out = feats.join(far, "doc_key", "left")
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    good = (F.coalesce("class_distance", F.lit(0.0)) <= max_class) & (F.coalesce("word_distance", F.lit(0.0)) <= max_word)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      base.alias("base_failed"), (~base & good).alias("kept"), "class_distance", "word_distance", "doc_key")


def keep_good(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` without the documents that ``judge`` rejects; all columns stay."""
    keys = stored(judge(docs, id_col, text, lang).where("kept").select("doc_key").distinct(), "good")
    good = unused(docs, "_good")[0]
    side = broadcast_if_small(keys.withColumnRenamed("doc_key", good), 16)
    return docs.join(side, F.xxhash64(docs[id_col], docs[text]) == F.col(good), "left_semi")
