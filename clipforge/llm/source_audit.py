"""Divergence between the sources of a language, and the terms that mark a source.

Terms are counted once per document inside the tasks and summed per (language, source,
term) by Spark. A language keeps the terms that occur in enough of its documents and
numbers them, so that a source is a sparse vector of (term id, count), sorted by term id
and cut into runs of ``BLOCK`` ids. A pair task co-groups the runs of two sources of a
language: a galloping search of the shorter in the longer finds the overlap, terms of one
side are priced against the other's probability of an absent term, both ways at once, as
the price is symmetric. Terms that neither source has are counted, not listed. So a pair
costs what its two sources hold, and no task sees more than two runs.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipforge.llm.common import broadcast_if_small, partitions, slices, stored
from clipforge.operators.ordering import positions

MIN_DOCUMENTS = 10
TOP = 10
#: Parts per SCALE; SCALE is STEP ** STEPS.
SCALE, STEP, STEPS = 1_000_000_000, 1_000, 3
#: Counted terms that a task holds before it passes them on.
HELD = 500_000
#: Term ids per run of a source's vector.
BLOCK = 1 << 15

#: A-Z lower-cased; what is neither a letter of ASCII nor a byte of a longer character is blank.
_FOLD = bytes(32 if b < 65 or 90 < b < 97 or 122 < b < 128 else b + 32 if 65 <= b <= 90 else b for b in range(256))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term of each group, summed in the task until it holds
    ``HELD`` of them."""
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in groups.items():
            if n:
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(n), pa.string()), pa.array([source] * len(n), pa.string()), pa.array(n.keys(), pa.binary()).cast(pa.string()),
                    pa.array(n.values(), pa.int64()), pa.array([docs[t] for t in n], pa.int64())], ["lang", "source", "term", "n", "docs"])
        groups.clear()

    for rows in (part for batch in batches for part in slices(batch, 2)):
        for lang, source, text in zip(*(rows.column(i).to_pylist() for i in range(3)), strict=True):
            terms = Counter(text.encode().translate(_FOLD).split())
            n, docs = groups.setdefault((lang, source), (Counter(), Counter()))
            n.update(terms)
            docs.update(terms.keys())
        if sum(len(n) for n, _ in groups.values()) >= HELD:
            yield from flush()
    yield from flush()


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def share(count: Column, total: Column) -> Column:
    """1 + floor(SCALE * count / total), exactly: long division in steps, so that no product leaves 64 bits."""
    value, rest = F.lit(0).cast("long"), count
    for _ in range(STEPS):
        value = value * STEP + _div(rest * STEP, total)
        rest = (rest * STEP) % total
    return value + 1


def price(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), p + q)


def _shares(count: np.ndarray, total: int) -> np.ndarray:
    value, rest = np.zeros(len(count), np.int64), count + 2
    for _ in range(STEPS):
        value = value * STEP + rest * STEP // total
        rest = rest * STEP % total
    return value + 1


def _prices(p: np.ndarray, q: np.ndarray) -> int:
    return int(((p - q) * (p - q) // (p + q)).sum())


def _vector(side: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    if not side.num_rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    terms = side["terms"].combine_chunks().flatten()
    return terms.field("id").to_numpy(), terms.field("n").to_numpy()


def _merge(key: tuple, a: pa.Table, b: pa.Table) -> pa.Table:
    """The price of the terms that one or both of two sources hold in a run of term ids, and their number."""
    whole = a if a.num_rows else b
    total_a, total_b = whole["mass_a"][0].as_py(), whole["mass_b"][0].as_py()
    (ids_a, n_a), (ids_b, n_b) = _vector(a), _vector(b)
    swap = len(ids_a) > len(ids_b)
    if swap:
        ids_a, n_a, total_a, ids_b, n_b, total_b = ids_b, n_b, total_b, ids_a, n_a, total_a
    at = np.searchsorted(ids_b, ids_a)
    both = np.zeros(len(ids_a), bool)
    inside = at < len(ids_b)
    both[inside] = ids_b[at[inside]] == ids_a[inside]
    alone = np.ones(len(ids_b), bool)
    alone[at[both]] = False
    p, q = _shares(n_a, total_a), _shares(n_b, total_b)
    none = np.zeros(1, np.int64)
    value = (_prices(p[both], q[at[both]]) + _prices(p[~both], _shares(none, total_b)) + _prices(_shares(none, total_a), q[alone]))
    lang, first, second, _ = (k.as_py() for k in key)
    return pa.table({"lang": [lang], "a": [first], "b": [second], "value": pa.array([value], pa.int64()), "n_terms": pa.array([len(ids_a) + int(alone.sum())], pa.int64())})


def _small(df: DataFrame, *names: str) -> DataFrame:
    """``df`` for a join, broadcast where its rows times the longest of its names allow it."""
    longest = df.agg(*[F.coalesce(F.max(F.octet_length(c)), F.lit(0)) for c in names]).first()
    return broadcast_if_small(df, sum(longest) + 64)


def _pairs(groups: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, item, value of every ordered pair of a language's sources."""
    runs = stored(kept.groupBy("lang", "source", F.expr(f"id div {BLOCK}").alias("run"))
                  .agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("terms")), "audit_runs")
    side = lambda c: groups.select("lang", "v", F.col("source").alias(c), F.col("mass").alias(f"mass_{c}"))
    pairs = side("a").join(side("b").drop("v"), "lang").where("a < b")
    pairs = stored(pairs.repartition(partitions(groups.sparkSession), "lang", "a", "b"), "audit_pairs")
    keys = ["lang", "a", "b", "run"]
    of = lambda c: (pairs.join(runs.withColumnRenamed("source", c), ["lang", c])
                    .select(*[F.col(k).alias(k) for k in (*keys, "mass_a", "mass_b", "terms")]))
    merged = (of("a").groupBy(*keys).cogroup(of("b").groupBy(*keys))
              .applyInArrow(_merge, "lang string, a string, b string, value long, n_terms long")
              .groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("n_terms").alias("n_terms")))
    none = F.lit(2).cast("long")
    absent = price(share(none, F.col("mass_a")), share(none, F.col("mass_b")))
    priced = pairs.join(merged, ["lang", "a", "b"], "left").select("lang", "a", "b", F.when(F.col("v") == 0, 0).otherwise(
        F.coalesce("value", F.lit(0)) + (F.col("v") - F.coalesce("n_terms", F.lit(0))) * absent).cast("long").alias("value"))
    priced = stored(priced, "audit_priced")
    return (priced.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value")
            .unionByName(priced.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value")))


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def divergences(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
                min_documents: int = MIN_DOCUMENTS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank.

    Part ``pair`` prices every other source of the language, over all kept terms; part
    ``term`` the ``top`` kept terms that the source uses more than its language does. Null
    text, language or source counts as ''. A document is a row, repeated or not. A source
    without kept terms has pairs, but no terms; a language of one source has no pairs; without
    kept terms every pair is worth 0; an empty table gives no rows. Ties rank by item.
    Extra columns are ignored. The ranks of terms are cut per task before they are shuffled."""
    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    cells = stored(named.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
                   .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "audit_cells")
    words = cells.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_documents)
    words = stored(positions(words.drop("docs"), ["term"], ["lang"], out_col="id").withColumn("id", F.col("id").cast("long")), "audit_words")
    langs = words.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_mass"))
    kept = stored(cells.drop("docs").join(words, ["lang", "term"]), "audit_kept")
    groups = (named.select("lang", "source").distinct()
              .join(kept.groupBy("lang", "source").agg(F.sum("n").alias("mass")), ["lang", "source"], "left").join(langs, "lang", "left"))
    v = F.coalesce("v", F.lit(0)).cast("long")
    groups = stored(groups.select("lang", "source", v.alias("v"), (F.coalesce("mass", F.lit(0)) + 2 * v).alias("mass"),
                                  (F.col("lang_mass") + 2 * v).alias("lang_mass")), "audit_groups")

    p, q = share(F.col("n") + 2, F.col("mass")), share(F.col("lang_n") + 2, F.col("lang_mass"))
    terms = (kept.join(_small(groups, "lang", "source"), ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
             .where("p > q").select("lang", "source", "item", price(F.col("p"), F.col("q")).alias("value")))
    return _ranked(_pairs(groups, kept), "pair").unionByName(_ranked(terms, "term").where(F.col("rank") <= top))
