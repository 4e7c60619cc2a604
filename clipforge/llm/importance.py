"""Quality classifier by importance resampling of hashed n-grams.

Two generative models over hashed word unigrams and bigrams -- one of target text, one
of the other, raw text -- give each document the log ratio of its probabilities. Adding
Gumbel noise to the log ratios and taking the largest k samples k documents without
replacement in proportion to their importance weights.

Counts are of documents: an n-gram counts once in each that holds it, in the models and in
a score. They are kept in a table by the n-gram's hash (``HASH_BITS``), which grows with the
corpus.
An n-gram has an entry of its own where the target's share of its documents is off the
target's share of all documents by more than ``DEVIATIONS`` standard deviations; the others
have the same probability in both models, so that the many rare n-grams of a document do
not give away whether it was a target.

Bigrams are counted where both of their words stand in ``LEAST_DOCS`` documents, as
else they can't either. The ``HEAD`` most frequent entries are broadcast and scored in the
scan; all further ones, rarer each, are joined by hash. The top k is exact and sorts
nothing in one task: rows are dealt by range and numbered with per-task offsets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipforge.llm.common import broadcast_if_small, mix, slices, stored, text_bytes
from clipforge.llm.shingles import words
from clipforge.operators.ordering import positions

#: An n-gram in fewer documents has no entry of its own.
LEAST_DOCS = 10
#: How far an n-gram's target documents must be off their expected number.
DEVIATIONS = 4.0
#: Entries that are broadcast (16 bytes each).
HEAD = 1 << 20
#: Bits of the largest filter of frequent words (16 MB); more words only let more bigrams through.
FILTER_BITS = 1 << 27
#: Share of the documents that is sampled.
SHARE = 0.85
SEED = 20240607
#: Entries that a task holds before it hands them on.
HELD = 1 << 20
#: Bytes of text per range of hashes: the ranges, each summed in one task, grow in number with the input.
RANGE_BYTES = 16 << 20
#: Bits of an n-gram's hash: 10 ** 12 buckets, which are not held but shuffled.
HASH_BITS = 40
#: Bytes of text that a task takes at once.
SLICE = 2 << 20

_SHIFT = np.uint64(64 - HASH_BITS)


class Filter:
    """A set of hashes as bits: holds every member, and some others."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(len(bits) * 64 - 1)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = keys & self.mask
        return (self.bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)

    @staticmethod
    def of(keys: DataFrame) -> Filter:
        """Filter of the column ``key``, eight bits a member up to ``FILTER_BITS``: the driver
        gets a row per 64 bits."""
        n = min(FILTER_BITS, 1 << max(10, (8 * keys.count()).bit_length()))
        at = F.col("key").bitwiseAND(F.lit(n - 1))
        rows = (keys.select(F.shiftright(at, 6).alias("word"), F.expr(f"shiftleft(1L, cast((key & {n - 1}L) & 63 as int))").alias("bit"))
                .groupBy("word").agg(F.expr("bit_or(bit)").alias("bits")).toArrow())
        bits = np.zeros(n // 64, np.uint64)
        bits[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
        return Filter(bits)


def _unigrams(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every word of a column."""
    (w, _), at = words(*text_bytes(col))
    return w >> _SHIFT, np.repeat(np.arange(len(at) - 1), np.diff(at))


def _bigrams(w: np.ndarray, doc: np.ndarray, frequent: Filter) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every two neighbouring words that the filter lets through."""
    if not len(w):
        return w, doc
    good = frequent(w)
    pair = np.flatnonzero((doc[1:] == doc[:-1]) & good[1:] & good[:-1])
    return mix(mix(w[pair]) * np.uint64(0x9E3779B97F4A7C15) + w[pair + 1]) >> _SHIFT, doc[pair]


def _once(keys: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every key once per text, sorted by key."""
    order = np.argsort(keys, kind="stable")  # texts ascend, so they do under equal keys
    keys, doc = keys[order], doc[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
    return keys[new], doc[new]


def _summed(keys: np.ndarray, docs: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(docs[order], first) if len(first) else docs, np.add.reduceat(target[order], first) if len(first) else target


def _packed(keys: np.ndarray, docs: np.ndarray, target: np.ndarray, bits: int) -> pa.RecordBatch:
    """Sorted sums as one compressed block per range of hashes: differences of keys, documents and
    target documents, each laid out byte after byte."""
    pack = zstandard.ZstdCompressor(level=1).compress
    part = (keys >> np.uint64(HASH_BITS - bits)).astype(np.int64)
    edges = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]]) if len(part) else np.zeros(1, np.int64)
    blocks = []
    for s, e in zip(edges[:-1], edges[1:], strict=True):
        entry = np.stack([np.diff(keys[s:e].astype(np.int64), prepend=0), docs[s:e], target[s:e]], axis=1)
        blocks.append(pack(entry.view(np.uint8).T.tobytes()))
    return pa.RecordBatch.from_arrays([pa.array(part[edges[:-1]]), pa.array(blocks, pa.binary())], ["part", "block"])


def _unpacked(block: bytes) -> list[np.ndarray]:
    entry = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), np.uint8).reshape(24, -1).T.copy().view(np.int64)
    return [np.cumsum(entry[:, 0]), entry[:, 1], entry[:, 2]]


def _count(bits: int, frequent=None):
    """Documents and target documents of every word, or of every bigram of frequent words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for part in (part for batch in batches for part in slices(batch, 0, SLICE)):
            wanted = part.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            keys, doc = _unigrams(part.column(0))
            if frequent is not None:
                keys, doc = _bigrams(keys, doc, frequent.value)
            keys, doc = _once(keys, doc)
            held.append(_summed(keys, np.ones(len(keys), np.int64), wanted[doc]))
            n += len(held[-1][0])
            if n > HELD:
                held = [_summed(*[np.concatenate(x) for x in zip(*held, strict=True)])]
                n = len(held[0][0])
                if n > HELD // 2:
                    yield _packed(*held[0], bits)
                    held, n = [], 0
        if held:
            yield _packed(*_summed(*[np.concatenate(x) for x in zip(*held, strict=True)]), bits)
    return run


def _sum_range(least: int):
    """The sums of one range of hashes that reach ``least`` documents."""
    def run(blocks: pa.Table) -> pa.Table:
        entries = [np.concatenate(x) for x in zip(*[_unpacked(b.as_py()) for b in blocks.column("block")], strict=True)]
        keys, docs, target = _summed(*entries)
        enough = docs >= least
        return pa.table({"key": keys[enough], "docs": docs[enough], "target": target[enough]})
    return run


def counts(flagged: DataFrame, size: int) -> tuple[DataFrame, Filter]:
    """(key, docs, target) of the words and bigrams in ``LEAST_DOCS`` documents, from rows
    (text, target boolean) of ``size`` bytes, and the filter of those words."""
    bits = min(HASH_BITS - 1, max(3, (size // RANGE_BYTES).bit_length()))

    def table(frequent, name):
        blocks = flagged.mapInArrow(_count(bits, frequent), "part long, block binary")
        return stored(blocks.groupBy("part").applyInArrow(_sum_range(LEAST_DOCS), "key long, docs long, target long"), name)

    unigrams = table(None, "importance_words")
    frequent = Filter.of(unigrams)
    return unigrams.unionByName(table(flagged.sparkSession.sparkContext.broadcast(frequent), "importance_bigrams")), frequent


def log_weights(docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text: str = "text") -> tuple[DataFrame, Filter]:
    """(key, docs, weight): log of target over raw probability of every n-gram with an entry of its
    own (add-one smoothing), and the filter of frequent words. Without target text, or without
    any other, there are no entries."""
    ids = target_ids.select(F.col(target_ids.columns[0]).cast("long").alias("_id")).where("_id is not null").distinct()
    src = docs.select(F.col(id_col).cast("long").alias("_doc"), F.col(text).cast("string").alias("text"))
    flagged = src.join(broadcast_if_small(ids, 16).withColumn("_t", F.lit(True)), F.col("_doc") == F.col("_id"), "left")
    flagged = flagged.select("text", F.coalesce("_t", F.lit(False)).alias("target"))
    all_docs, targets, size = flagged.agg(F.count(F.lit(1)), F.coalesce(F.count_if("target"), F.lit(0)),
                                          F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()
    table, frequent = counts(flagged, size)
    share = targets / all_docs if all_docs else 0.0
    n, in_target, total = table.agg(F.count(F.lit(1)), F.coalesce(F.sum("target"), F.lit(0)), F.coalesce(F.sum("docs"), F.lit(0))).first()
    expected = F.col("docs") * F.lit(share)
    telling = (F.col("target") - expected) ** 2 > F.lit(DEVIATIONS ** 2 * (1 - share)) * expected
    weight = F.log((F.col("target") + 1) / F.lit(float(in_target + n))) - F.log((F.col("docs") - F.col("target") + 1) / F.lit(float(total - in_target + n)))
    return stored(table.where(telling & F.lit(0 < share < 1)).select("key", "docs", weight.alias("weight")), "importance_weights"), frequent


def _divided(weights: DataFrame, head: int) -> tuple[DataFrame, DataFrame]:
    """The most frequent entries, at most ``head``, and the others. Entries are divided at a power
    of two of their documents, counted by power."""
    power = F.floor(F.log2("docs")).cast("int")
    left, least = head, 64
    for p, n in sorted(weights.groupBy(power).count().collect(), reverse=True):  # at most 64 rows
        if n > left:
            break
        left, least = left - n, p
    return weights.where(power >= least), weights.where(power < least)


def _ngrams(w: np.ndarray, doc: np.ndarray, frequent: Filter) -> tuple[np.ndarray, np.ndarray]:
    """Every word and bigram once per text."""
    pairs, of = _bigrams(w, doc, frequent)
    return _once(np.concatenate([w, pairs]), np.concatenate([doc, of]))


def _score(keys, weights, frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, v = keys.value, weights.value
        for rows in (part for batch in batches for part in slices(batch, 1, SLICE)):
            w, of = _unigrams(rows.column(1))
            found, doc = _ngrams(w, of, frequent.value)
            total = np.zeros(rows.num_rows)
            if len(k):
                place = np.minimum(np.searchsorted(k, found), len(k) - 1)
                total = np.bincount(doc, np.where(k[place] == found, v[place], 0.0), minlength=rows.num_rows)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.bincount(of, minlength=rows.num_rows)), pa.array(total), rows.column(2), rows.column(3)],
                                             ["doc_id", "n_words", "log_ratio", "uniform", "doc_key"])
    return run


def _met(frequent, wanted):
    """The n-grams of every text that the filter ``wanted`` lets through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in (part for batch in batches for part in slices(batch, 1, SLICE)):
            found, doc = _ngrams(*_unigrams(rows.column(1)), frequent.value)
            good = wanted.value(found)
            of = pa.array(doc[good])
            yield pa.RecordBatch.from_arrays([rows.column(0).take(of), rows.column(3).take(of), pa.array(found[good].view(np.int64))],
                                             ["_doc", "_doc_key", "key"])
    return run


def resample(docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text: str = "text",
             share: float = SHARE, seed: int = SEED, head: int = HEAD) -> DataFrame:
    """doc_id, n_words, log_ratio, gumbel_key, rank (1 is first), kept per document.

    The ceil(share x n) documents with the largest key are kept; equal keys go by id, nulls
    first. The noise of a document is a hash of its id and text. Null or wordless text has
    log ratio 0. Rows that repeat have equal keys and ranks next to each other. At most
    ``head`` entries of the models are broadcast; the result is the same with any number."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    weights, frequent = log_weights(docs, target_ids, id_col, text)
    top, rest = _divided(weights, head)
    entries = top.select("key", "weight").toArrow()  # at most ``head`` rows
    keys = entries["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    shared = sc.broadcast(frequent)
    uniform = (F.pmod(F.xxhash64(F.lit(seed), F.col(id_col), F.col(text)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), uniform.alias("uniform"),
                      F.xxhash64(F.lit(seed + 1), F.col(id_col), F.col(text)).alias("doc_key"))
    scored = src.mapInArrow(_score(sc.broadcast(keys[order]), sc.broadcast(entries["weight"].to_numpy()[order]), shared),
                            "doc_id long, n_words long, log_ratio double, uniform double, doc_key long")
    if not rest.isEmpty():
        met = src.mapInArrow(_met(shared, sc.broadcast(Filter.of(rest))), "_doc long, _doc_key long, key long").distinct()  # rows may repeat
        more = met.join(rest, "key").groupBy("_doc", "_doc_key").agg(F.sum("weight").alias("_more"))
        scored = scored.join(more, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("doc_key") == F.col("_doc_key")), "left")
        scored = scored.withColumn("log_ratio", F.col("log_ratio") + F.coalesce("_more", F.lit(0.0)))
    scored = scored.withColumn("gumbel_key", F.col("log_ratio") - F.log(-F.log("uniform")))
    scored = stored(scored.select("doc_id", "n_words", "log_ratio", "gumbel_key", (-F.col("gumbel_key")).alias("_down")), "importance")
    n = scored.count()
    ranked = positions(scored, ["_down", "doc_id"], out_col="rank")
    return ranked.select("doc_id", "n_words", "log_ratio", "gumbel_key", F.col("rank").cast("long").alias("rank"),
                         (F.col("rank") <= F.ceil(F.lit(share * n))).alias("kept"))
