"""Unsupervised keywords of short texts (titles): phrases of up to three words,
top ``k`` after a greedy near-duplicate filter.

The reference calls an external extractor; its scoring is not part of the
reference, so the score here is defined in this module (a statistical
word-feature score in the spirit of published unsupervised extractors; lower is
better). Per text, over lower-cased words (runs of letters); sentences end at
``.``, ``!`` or ``?``:

* ``casing  = max(TF_capitalised, TF_acronym) / (1 + ln TF)`` (capitalised:
  initial upper case not at a sentence start; acronym: all upper case, 2+ letters)
* ``position = ln(ln(3 + median sentence index))``
* ``freq = TF / (mean TF + population std TF)`` over the text's non-stop words
* ``rel = 1 + (DL + DR) * TF / max TF`` with DL/DR = distinct left/right
  neighbours over left/right neighbour occurrences
* ``spread = sentences containing the word / sentences``
* word score ``S = rel * position / (casing + freq / rel + spread / rel)``
* phrase score ``prod S / (TF_phrase * (1 + sum S))`` for 1-3 consecutive words
  of one sentence that neither start nor end with a stop word.

Candidates are ranked by (score, phrase); a candidate is kept while its
similarity ``1 - levenshtein / max length`` to every kept one is at most the
limit, until ``k`` are kept. Stop words are a table (one column ``word``).
Per-text windows and arrays are bounded by the text itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipforge.functions import constants as C

TOKEN = r"\p{L}+|[.!?]"


def top_document_words(docs: DataFrame, text_col: str, n: int) -> DataFrame:
    """The ``n`` words found in the most texts (ties by word): a stop-word table
    derived from the corpus by rule."""
    w = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text_col), F.lit(r"\p{L}+"), 0)))
                    .alias("word"))
    return w.groupBy("word").count().orderBy(F.desc("count"), "word").limit(n).select("word")


def keyword_candidates(docs: DataFrame, id_col: str, text_col: str, stopwords: DataFrame,
                       max_words: int = C.KEYWORD_MAX_WORDS) -> DataFrame:
    """(id, phrase, score) for every candidate phrase of every text.

    The texts are dealt by id once, before they are split: windows and sums per text then need
    no shuffle of words. A word's places ride along with its sums and take its score back to
    the tokens; phrases come from ``lead`` over the scored tokens.
    """
    spark = docs.sparkSession  # many parts: a part's words are sorted in its task's memory
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 16 * spark.sparkContext.defaultParallelism)
    dealt = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).repartition(parts, "_id")
    t = dealt.select("_id", F.posexplode(F.regexp_extract_all("_text", F.lit(TOKEN), 0)).alias("pos", "raw"))
    wd = Window.partitionBy("_id").orderBy("pos")
    t = (t.withColumn("_end", F.col("raw").rlike(r"^[.!?]$"))
         .withColumn("sent", F.coalesce(F.sum(F.col("_end").cast("int"))
                                        .over(wd.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
         .withColumn("_prev", F.lag("raw", 1).over(wd)).withColumn("_next", F.lead("raw", 1).over(wd)))
    # a neighbour in the same sentence is an adjacent token that is not a sentence end
    is_word = lambda c: c.isNotNull() & ~c.rlike(r"^[.!?]$")
    words = t.where(~F.col("_end")).select(
        "_id", "pos", "sent", "raw", F.lower("raw").alias("w"),
        F.when(is_word(F.col("_prev")), F.lower("_prev")).alias("left"),
        F.when(is_word(F.col("_next")), F.lower("_next")).alias("right"),
        (~is_word(F.col("_prev"))).alias("_sent_start"))
    sw = stopwords.select(F.col("word").alias("w")).distinct().withColumn("stop", F.lit(True))
    cap = (~F.col("_sent_start")) & F.col("raw").rlike(r"^\p{Lu}") & ~F.col("raw").rlike(r"^\p{Lu}+$")
    acr = F.col("raw").rlike(r"^\p{Lu}{2,}$")
    per = words.groupBy("_id", "w").agg(
        F.count(F.lit(1)).alias("tf"), F.sum(cap.cast("int")).alias("tf_cap"), F.sum(acr.cast("int")).alias("tf_acr"),
        F.median("sent").alias("med_sent"), F.size(F.collect_set("sent")).alias("n_sent_w"),
        F.count("left").alias("n_left"), F.size(F.collect_set("left")).alias("d_left"),
        F.count("right").alias("n_right"), F.size(F.collect_set("right")).alias("d_right"),
        F.collect_list(F.struct("pos", "sent")).alias("_at"))
    per = per.join(F.broadcast(sw), "w", "left").withColumn("stop", F.coalesce("stop", F.lit(False)))
    doc = words.groupBy("_id").agg((F.max("sent") + 1).alias("n_sent"))
    ns = per.where(~F.col("stop")).groupBy("_id").agg(
        F.avg("tf").alias("mean_tf"), F.stddev_pop("tf").alias("std_tf"), F.max("tf").alias("max_tf"))
    f = per.join(doc, "_id").join(ns, "_id", "left")
    casing = F.greatest("tf_cap", "tf_acr") / (1 + F.log("tf"))
    position = F.log(F.log(3 + F.col("med_sent")))
    freq = F.col("tf") / (F.col("mean_tf") + F.col("std_tf"))
    dl = F.when(F.col("n_left") > 0, F.col("d_left") / F.col("n_left")).otherwise(0.0)
    dr = F.when(F.col("n_right") > 0, F.col("d_right") / F.col("n_right")).otherwise(0.0)
    rel = 1 + (dl + dr) * F.col("tf") / F.col("max_tf")
    spread = F.col("n_sent_w") / F.col("n_sent")
    s = rel * position / (casing + freq / rel + spread / rel)
    # phrases: 1..max_words consecutive words of one sentence, from leads over the scored tokens
    tok = f.select("_id", "w", "stop", s.alias("S"), F.explode("_at").alias("_p")).select("_id", "_p.pos", "_p.sent", "w", "stop", "S")
    ww = Window.partitionBy("_id").orderBy("pos")
    for j in range(1, max_words):
        # (column names are case-insensitive: keep sentence and score leads apart)
        tok = (tok.withColumn(f"w{j}", F.lead("w", j).over(ww)).withColumn(f"sent{j}", F.lead("sent", j).over(ww))
               .withColumn(f"stop{j}", F.lead("stop", j).over(ww)).withColumn(f"score{j}", F.lead("S", j).over(ww)))
    cands = []
    for n in range(1, max_words + 1):
        same = F.lit(True)
        for j in range(1, n):
            same = same & (F.col(f"sent{j}") == F.col("sent"))
        ws = [F.col("w")] + [F.col(f"w{j}") for j in range(1, n)]
        Ss = [F.col("S")] + [F.col(f"score{j}") for j in range(1, n)]
        last_stop = F.col("stop") if n == 1 else F.col(f"stop{n - 1}")
        prod = Ss[0]
        total = Ss[0]
        for x in Ss[1:]:
            prod = prod * x
            total = total + x
        ok = F.coalesce(same, F.lit(False)) & ~F.col("stop") & ~F.coalesce(last_stop, F.lit(True))
        cands.append(F.when(ok, F.struct(F.concat_ws(" ", *ws).alias("phrase"), prod.alias("_prod"),
                                         total.alias("_sum"))))
    c = tok.select("_id", F.explode(F.array(*cands)).alias("c")).where(F.col("c").isNotNull()).select("_id", "c.*")
    tfp = c.groupBy("_id", "phrase").agg(F.count(F.lit(1)).alias("tf_p"), F.first("_prod").alias("_prod"),
                                         F.first("_sum").alias("_sum"))
    return tfp.select(F.col("_id").alias(id_col), "phrase",
                      (F.col("_prod") / (F.col("tf_p") * (1 + F.col("_sum")))).alias("score"))


def top_keywords(cands: DataFrame, id_col: str, k: int = C.KEYWORDS_TOP,
                 dedup_limit: float = C.KEYWORD_DEDUP_LIMIT) -> DataFrame:
    """(id, keywords ARRAY<STRING>): greedy, best first, near-duplicates dropped."""
    g = cands.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct(
        F.round("score", 12).alias("score"), "phrase"))).alias("_c"))

    def sim(a, b):
        return 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b))

    def step(acc, x):
        ok = (F.size(acc) < k) & F.forall(acc, lambda kept: sim(kept, x["phrase"]) <= dedup_limit)
        return F.when(ok, F.concat(acc, F.array(x["phrase"]))).otherwise(acc)

    kw = F.aggregate("_c", F.array().cast("array<string>"), step)
    return g.select(id_col, kw.alias("keywords"))
