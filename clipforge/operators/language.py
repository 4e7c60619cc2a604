"""Language identification from character-bigram profiles learned from a labelled table.

Text model: the lower-cased words (runs of letters), each read as
``' ' + word + ' '``; its bigrams are the text's bigrams (words are separated
by one space, so the boundary bigrams ``'x '`` and ``' y'`` are counted once).
Words are counted first and each distinct word's bigrams are weighted by its
count, so the expensive step runs over the vocabulary, not the raw text.

Profile: bigram counts per language. Score of a text for a language:
``sum over its bigrams of count * ln((n_lang(g) + 1) / (N_lang + V))`` (add-one
smoothing, ``V`` distinct bigrams overall); the highest score wins, ties to the
smaller language code. Deterministic, unlike sampling detectors.

The score splits into ``sum(count * ln(n + 1))`` over the bigrams that the
language has (an equi-join on the bigram) and ``-(bigrams of the text) * ln(N + V)``,
which is added per language after the sum: no key is shared by all texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipforge.functions import constants as C
from clipforge.functions.text import col_


def words_lower(c) -> Column:
    return F.regexp_extract_all(F.lower(col_(c)), F.lit(r"\p{L}+"), 0)


def word_bigrams(w) -> Column:
    """Bigrams of ``' ' + w + ' '`` (w is a short word column)."""
    s = F.concat(F.lit(" "), col_(w), F.lit(" "))
    return F.transform(F.sequence(F.lit(1), F.length(col_(w)) + 1), lambda i: F.substring(s, i, F.lit(2)))


def has_letters(c) -> Column:
    return col_(c).rlike(r"\p{L}")


def _gram_counts(df: DataFrame, key_cols: list, text_col: str) -> DataFrame:
    """(keys..., gram, cnt): word counts first, then bigrams weighted by them."""
    w = (df.select(*key_cols, F.explode(words_lower(text_col)).alias("_w"))
         .groupBy(*key_cols, "_w").agg(F.count(F.lit(1)).alias("_c")))
    return (w.select(*key_cols, "_c", F.explode(word_bigrams("_w")).alias("gram"))
            .groupBy(*key_cols, "gram").agg(F.sum("_c").alias("cnt")))


def language_profile(train: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, gram, n): bigram counts per language (map-side combined aggregates)."""
    t = train.where(col_(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("_t"))
    return _gram_counts(t, ["lang"], "_t").withColumnRenamed("cnt", "n")


def identify_language(df: DataFrame, id_col: str, text_col: str, profile: DataFrame) -> DataFrame:
    """(id, lang, score) for each row with at least one letter; others get no row
    (detection failure). ``profile`` is read three times: pass a stored table."""
    rows = df.where(has_letters(text_col)).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"))
    grams = _gram_counts(rows, ["_id"], "_t")
    seen = (grams.join(profile.select("lang", "gram", F.log(F.col("n") + 1).alias("w")), "gram")
            .groupBy("_id", "lang").agg(F.sum(F.col("cnt") * F.col("w")).alias("part")))
    v = profile.select(F.count_distinct("gram")).scalar()
    base = profile.groupBy("lang").agg(F.sum("n").alias("N")).select("lang", (-F.log(F.col("N") + v)).alias("w"))
    # one small row holding every language's base weight, as a scalar
    langs = base.agg(F.collect_list(F.struct("lang", "w"))).scalar()
    totals = (grams.groupBy("_id").agg(F.sum("cnt").alias("cnt"))
              .select("_id", "cnt", F.explode(langs).alias("b"))
              .select("_id", F.col("b.lang").alias("lang"), (F.col("cnt") * F.col("b.w")).alias("part")))
    scored = seen.unionByName(totals).groupBy("_id", "lang").agg(F.sum("part").alias("score"))
    # at most one entry per language and text
    best = scored.groupBy("_id").agg(F.array_min(F.collect_list(F.struct((-F.col("score")).alias("neg"), "lang"))).alias("_b"))
    return best.select(F.col("_id").alias(id_col), F.col("_b.lang").alias("lang"), (-F.col("_b.neg")).alias("score"))


def filter_languages(df: DataFrame, lang_col: str = "lang", allowed=C.ALLOWED_LANGUAGES) -> DataFrame:
    return df.where(F.col(lang_col).isin(list(allowed)))
