"""N-gram Jaccard self-join as a blocked sparse matrix product.

Documents are rows, word shingles columns of a 0/1 incidence matrix; the product
with its transpose holds the overlaps. With a threshold of 90 %, two linked
documents share a shingle among the first 10 % of each, in any fixed order of the
shingles, so only those entries of the matrix are multiplied. The order puts rare
shingles first. It comes from a counting sketch of fixed size over all documents;
the sketch steers cost only, any order gives the same links.

* Equal sets are one class with one row of the matrix (128-bit key of the set).
* A column is a block. Its pairs are not written out: a column is first multiplied
  with its hub alone, the document that ranks it earliest. Pairs below the bound on
  the overlap that the two sizes and the places of the match allow are discarded;
  the others are counted exactly on their whole sets.
* The links found give components. Only columns whose documents still fall into
  several components are multiplied in full, across components, under the same
  bounds. So no link between components is missed.
* The links inside a component are counted in tiles of its sets, all pairs, so that
  every class has the number of all its links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipforge.llm.common import broadcast_if_small, slices, stored, text_bytes, unused
from clipforge.llm.components import components
from clipforge.llm.shingles import SHINGLE, degrees, set_key, sets, shingles, smallest_linked
from clipforge.llm.shingles import links as confirmed

PERCENT = 90
#: Counters of the sketch and their share per row of its table: 2 ** 21 bytes in all, whatever the input.
SKETCH_BITS = 21
BLOCK_BITS = 11

ROWS = "uid long, doc_id long, doc_key long, n long, cid binary, prefix array<long>, body binary"


def _sketch(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(1 << SKETCH_BITS, np.int32)
        for rows in (part for batch in batches for part in slices(batch, 0)):
            (h, _), _ = shingles(*text_bytes(rows.column(0)), shingle)
            place, n = np.unique(h >> np.uint64(64 - SKETCH_BITS), return_counts=True)
            count[place.astype(np.int64)] += n.astype(np.int32)
        if count.any():
            zip_ = zstandard.ZstdCompressor(level=1).compress
            blocks = count.reshape(-1, 1 << BLOCK_BITS)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(blocks), dtype=np.int32)), pa.array([zip_(b.tobytes()) for b in blocks], pa.binary())], ["block", "counts"])
    return run


def _sum_sketch(rows: pa.Table) -> pa.Table:
    unzip = zstandard.ZstdDecompressor().decompress
    total = np.zeros(1 << BLOCK_BITS, np.int64)
    for x in rows.column("counts"):
        total += np.frombuffer(unzip(x.as_py()), np.int32)
    rank = np.minimum(255, np.round(8 * np.log2(total + 1))).astype(np.uint8)
    return pa.table({"block": rows.column("block")[:1], "ranks": pa.array([rank.tobytes()], pa.binary())})


def shingle_ranks(docs: DataFrame, text: str, shingle: int = SHINGLE) -> np.ndarray:
    """A byte per sketch counter that grows with the log of its count over all documents."""
    rows = (docs.select(F.col(text).alias("t")).mapInArrow(_sketch(shingle), "block int, counts binary")
            .groupBy("block").applyInArrow(_sum_sketch, "block int, ranks binary").collect())
    ranks = np.zeros((1 << (SKETCH_BITS - BLOCK_BITS), 1 << BLOCK_BITS), np.uint8)
    for r in rows:
        ranks[r["block"]] = np.frombuffer(r["ranks"], np.uint8)
    return ranks.ravel()


def prefix_size(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def _rows(ranks, percent: int, shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, shift = ranks.value, np.uint64(64 - SKETCH_BITS)
        task, serial = TaskContext.get().partitionId() << 32, 0
        zip_ = zstandard.ZstdCompressor(level=3).compress
        least = smallest_linked(percent)
        for rows in (part for batch in batches for part in slices(batch, 2)):
            data, offsets = text_bytes(rows.column(2))
            n, cid, prefix, body = [], [], [], []
            for i, whole in enumerate(sets(data, offsets, shingle)):
                own = whole[0]
                n.append(len(own))
                cid.append(set_key(whole))
                if len(own) >= least:
                    p = prefix_size(len(own), percent)
                    key = (rank[(own >> shift).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (own >> np.uint64(8))
                    prefix.append(own[np.argsort(key, kind="stable")[:p]].view(np.int64))
                    body.append(zip_(data[offsets[i]:offsets[i + 1]].tobytes()))
                else:
                    prefix.append(None)
                    body.append(None)
            m = len(n)
            yield pa.RecordBatch.from_arrays([
                pa.array(task + serial + np.arange(m)), rows.column(0), rows.column(1), pa.array(n, pa.int64()), pa.array(cid, pa.binary()),
                pa.array(prefix, pa.list_(pa.int64())), pa.array(body, pa.binary())], ["uid", "doc_id", "doc_key", "n", "cid", "prefix", "body"])
            serial += m
    return run


def _possible(n: Column, i: Column, m: Column, j: Column, percent: int) -> Column:
    """Whether sets of n and m members whose first common member ranks i-th and j-th
    (from 1) can reach the threshold: at most one member plus the rest of the shorter
    remainder is common, and percent / (100 + percent) of both sizes must be."""
    return ((100 + percent) * (1 + F.least(n - i, m - j)) >= percent * (n + m)) & (100 * F.least(n, m) >= percent * F.greatest(n, m))


def grouped(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = PERCENT, shingle: int = SHINGLE,
            count_links: bool = True) -> DataFrame:
    """doc_id, doc_key (hash of id and text), n, cid (class of equal sets), label (component; null
    for an empty set), component_id and n_links (null unless counted) of every row."""
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(shingle_ranks(docs, text, shingle))
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(id_col), F.col(text)).alias("doc_key"), F.col(text).cast("string").alias("text"))
    rows = stored(src.mapInArrow(_rows(ranks, percent, shingle), ROWS), "shingle_sets")
    classes = stored(rows.where("n > 0").groupBy("cid").agg(F.min("uid").alias("uid"), F.min("doc_id").alias("least")), "set_classes")
    matrix = rows.where("prefix is not null").join(classes.select("uid"), "uid", "left_semi")
    bodies = matrix.select("uid", "n", "body")
    entries = matrix.select("uid", "n", F.posexplode("prefix").alias("i", "col")).withColumn("i", F.col("i") + 1)

    hubs = (entries.groupBy("col").agg(F.min(F.struct("i", "uid", "n")).alias("hub"), F.count(F.lit(1)).alias("size"))
            .where("size > 1").select("col", "size", F.col("hub.uid").alias("hub"), F.col("hub.n").alias("m"), F.col("hub.i").alias("j")))
    blocks = stored(entries.join(hubs, "col").select("col", "size", "uid", "n", "i", "hub", "m", "j"), "blocks")
    star = (blocks.where((F.col("uid") != F.col("hub")) & _possible(F.col("n"), F.col("i"), F.col("m"), F.col("j"), percent))
            .select(F.least("uid", "hub").alias("a"), F.greatest("uid", "hub").alias("b")).distinct())
    links = stored(confirmed(star, bodies, percent, shingle), "links")
    labels = components(links)

    named = (blocks.where("size > 2").join(labels.withColumnRenamed("node", "uid"), "uid", "left")
             .withColumn("label", F.coalesce("label", "uid")))
    mixed = named.groupBy("col").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("col")
    named = stored(named.join(mixed, "col", "left_semi").select("col", "uid", "n", "i", "label", "hub"), "mixed_blocks")
    other = named.select("col", F.col("uid").alias("uid_2"), F.col("n").alias("m"), F.col("i").alias("j"), F.col("label").alias("label_2"))
    rest = (named.join(other, "col").where((F.col("label") < F.col("label_2")) & (F.col("uid") != F.col("hub")) & (F.col("uid_2") != F.col("hub"))
                                           & _possible(F.col("n"), F.col("i"), F.col("m"), F.col("j"), percent))
            .select(F.least("uid", "uid_2").alias("a"), F.greatest("uid", "uid_2").alias("b")).distinct())
    more = stored(confirmed(rest, bodies, percent, shingle), "links")
    if not more.isEmpty():
        links = links.unionByName(more)
        labels = components(links)

    named = classes.join(labels.withColumnRenamed("node", "uid"), "uid", "left").withColumn("label", F.coalesce("label", "uid"))
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    if count_links:
        named = named.join(degrees(links, labels, bodies, percent, shingle), "uid", "left").withColumn("n_links", F.coalesce("n_links", F.lit(0).cast("long")))
    else:
        named = named.withColumn("n_links", F.lit(None).cast("long"))
    of = named.join(least, "label").select("cid", "label", "component_id", "n_links")
    found = rows.select("doc_id", "doc_key", "n", "cid").join(of, "cid", "left")
    found = found.withColumn("component_id", F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")))
    return found.withColumn("n_links", F.coalesce("n_links", F.lit(0).cast("long"))) if count_links else found


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, class_id, n_links per document.

    ``class_id`` is the fingerprint of the document's set: documents of one class have
    equal sets. ``n_links`` counts the links of the class to other classes, all of them. Null or wordless text has an empty
    set, no links, and its own id as component. Null ids are never smallest; a component of
    null ids only has a null component_id. Repeated rows are members of one class."""
    return grouped(docs, id_col, text, percent).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.lower(F.hex("cid")).alias("class_id"), "n_links")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """One document of each component (the smallest id, null last); all columns stay.

    Documents without words are components of their own. Of exact repeats of a row one stays."""
    g = stored(grouped(docs, id_col, text, percent, shingle, count_links=False), "grouped")
    key = unused(docs, "_key")[0]
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "doc_key")
    winners = (g.where("label is not null").groupBy("label").agg(F.min(order).alias("w")).select(F.col("w.doc_key").alias(key))
               .unionByName(g.where("label is null").select(F.col("doc_key").alias(key))))
    winners = stored(winners.distinct(), "winners")
    kept = docs.join(broadcast_if_small(winners, 16), F.xxhash64(docs[id_col], docs[text]) == F.col(key), "left_semi")
    unique = g.where("label is not null").groupBy("doc_key").agg(F.count(F.lit(1)).alias("k")).where("k > 1").isEmpty()
    if unique:
        return kept
    marked = kept.withColumn(key, F.xxhash64(F.col(id_col), F.col(text)))
    wordless = g.where("label is null").select("doc_key").distinct().withColumnRenamed("doc_key", key)
    return (marked.join(wordless, key, "left_anti").dropDuplicates([key]).select(*docs.columns)
            .unionByName(marked.join(wordless, key, "left_semi").select(*docs.columns)))
