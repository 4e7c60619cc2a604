"""MinHash near-duplicates by an LSH forest.

Every distinct shingle set has a label of ``DEPTH`` minimum hashes in each of ``TREES``
trees. Sorted by its labels, a tree puts sets with long common prefixes side by side; a
region is the run of all sets that share a prefix, and its members are candidates. The
depth adapts to the region: prefixes start at ``FIRST`` hashes, and only regions of more
than ``REGION`` members go on to longer prefixes, up to the whole label. At 85 % a pair
shares a prefix of three hashes with probability 0.61 per tree, a whole label with 0.44: of
the pairs at the very threshold that stand in crowded regions everywhere one in 1.3 million
is in no common region; elsewhere it is one in 10 ** 10, and fewer above the threshold.

No region is multiplied out. Its members are held against one of them (the hub), for
``ROUNDS`` rounds with another hub each in what the links so far have not joined, and only
members of different components of the same region are then held against each other, dealt
over as many tasks as the region is large. Before any text is read a pair must pass

* the sizes;
* the odd sketch: a bit per bucket, the parity of the shingles hashed to it. Two sketches
  differ in at most as many bits as the sets differ in shingles, so this loses no link;
* the agreement of one bit of each minimum hash, which a pair at the threshold fails once
  in 10 ** 8. It steers cost for sets too large for the odd sketch.

What passes is counted exactly on the whole sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipforge.llm.common import mix, slices, stored, text_bytes
from clipforge.llm.components import components
from clipforge.llm.shingles import SHINGLE, links, set_key, sets, smallest_linked

PERCENT = 85
TREES, DEPTH, FIRST = 24, 5, 3
REGION = 8
ROUNDS = 3
#: Members of a region that one task holds against the whole region.
SHARE = 512
#: Buckets of the odd sketch.
BUCKETS = 512

_HASHES = TREES * DEPTH
_RNG = np.random.default_rng(11)
_FLIP = _RNG.integers(0, 1 << 32, _HASHES, dtype=np.uint64).astype(np.uint32)
_MUL = _RNG.integers(0, 1 << 32, _HASHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_KEYS = [f"k{d}" for d in range(FIRST, DEPTH + 1)]
_BITS = [f"bits{i}" for i in range(-(-_HASHES // 64))]
_ODD = [f"odd{i}" for i in range(BUCKETS // 64)]
_ATTRIBUTES = ["n", *_BITS, *_ODD]

ROWS = (f"uid long, doc_id long, doc_key long, n long, cid binary, {', '.join(f'{b} long' for b in (*_BITS, *_ODD))}, "
        f"{', '.join(f'{k} array<long>' for k in _KEYS)}, body binary")


def signatures(own: list[np.ndarray]) -> np.ndarray:
    """The minimum hashes of non-empty sets, one row per set."""
    flat = (np.concatenate(own) >> np.uint64(32)).astype(np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in own])[:-1]])
    out = np.empty((len(own), _HASHES), np.uint32)
    for i in range(_HASHES):
        out[:, i] = np.minimum.reduceat((flat ^ _FLIP[i]) * _MUL[i], starts)
    return out


def _packed(bits: np.ndarray, words: int) -> np.ndarray:
    """Rows of 0/1 as rows of ``words`` 64-bit integers."""
    out = np.zeros((len(bits), 8 * words), np.uint8)
    packed = np.packbits(bits.astype(np.uint8), axis=1)
    out[:, :packed.shape[1]] = packed
    return out.view(np.int64)


def odd_sketches(own: list[np.ndarray]) -> np.ndarray:
    """The parity of the number of members in each of BUCKETS buckets, one row per set."""
    place = np.repeat(np.arange(len(own)) * BUCKETS, [len(s) for s in own]) + (np.concatenate(own) & np.uint64(BUCKETS - 1)).astype(np.int64)
    return np.bincount(place, minlength=len(own) * BUCKETS).reshape(len(own), BUCKETS) & 1


def bits_off(percent: int, chance: float = 1e-8) -> int:
    """The number of minimum-hash bits that a pair at the threshold loses more than with at most ``chance``."""
    p, tail, k = (1 - percent / 100) / 2, 1.0, -1
    while tail > chance:
        k += 1
        tail -= math.comb(_HASHES, k) * p ** k * (1 - p) ** (_HASHES - k)
    return k


def _prefixes(sig: np.ndarray) -> list[np.ndarray]:
    """The key of each tree's prefix of FIRST, FIRST + 1, ... DEPTH hashes: sets x trees."""
    label = sig.reshape(len(sig), TREES, DEPTH).astype(np.uint64)
    key = np.broadcast_to(mix(np.arange(1, TREES + 1, dtype=np.uint64)), label.shape[:2]).copy()
    out = []
    for d in range(DEPTH):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + label[:, :, d])
        if d + 1 >= FIRST:
            out.append(key.view(np.int64))
    return out


def _rows(percent: int, shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, serial, least = TaskContext.get().partitionId() << 32, 0, smallest_linked(percent)
        zip_ = zstandard.ZstdCompressor(level=3).compress
        for rows in (part for batch in batches for part in slices(batch, 2)):
            data, offsets = text_bytes(rows.column(2))
            whole = sets(data, offsets, shingle)
            m = len(whole)
            large = np.flatnonzero([len(s[0]) >= least for s in whole])
            own = [whole[i][0] for i in large]
            sig = signatures(own) if own else np.zeros((0, _HASHES), np.uint32)
            marks = np.zeros((m, len(_BITS) + len(_ODD)), np.int64)
            if own:
                marks[large] = np.hstack([_packed((sig >> np.uint32(7)) & np.uint32(1), len(_BITS)), _packed(odd_sketches(own), len(_ODD))])
            at = np.zeros(m + 1, np.int64)
            at[large + 1] = TREES
            keys = [pa.ListArray.from_arrays(pa.array(np.cumsum(at), pa.int32()), pa.array(k.ravel(), pa.int64())) for k in _prefixes(sig)]
            marked = set(large.tolist())
            body = [zip_(data[offsets[i]:offsets[i + 1]].tobytes()) if i in marked else None for i in range(m)]
            yield pa.RecordBatch.from_arrays([
                pa.array(task + serial + np.arange(m)), rows.column(0), rows.column(1), pa.array([len(s[0]) for s in whole], pa.int64()),
                pa.array([set_key(s) for s in whole], pa.binary()), *[pa.array(c) for c in marks.T], *keys, pa.array(body, pa.binary())],
                ["uid", "doc_id", "doc_key", "n", "cid", *_BITS, *_ODD, *_KEYS, "body"])
            serial += m
    return run


def regions(sets_: DataFrame) -> DataFrame:
    """key, size and member (uid) of the regions of two and more members, each at the smallest
    depth that leaves it at most REGION members, or at the full depth."""
    done = []
    at = sets_.select("uid", F.posexplode(_KEYS[0]).alias("tree", "key"))
    for k, deeper in zip(_KEYS, [*_KEYS[1:], None], strict=True):
        sizes = at.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        at = stored(at.join(sizes, "key"), "regions")
        done.append(at.select("key", "size", "uid") if deeper is None else at.where(F.col("size") <= REGION).select("key", "size", "uid"))
        crowded = at.where(F.col("size") > REGION).select("uid", "tree")
        if deeper is None or crowded.isEmpty():
            break
        at = crowded.join(sets_.select("uid", deeper), "uid").select("uid", "tree", F.element_at(deeper, F.col("tree") + 1).alias("key"))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return stored(out, "regions")


def _alike(percent: int, a: str, b: str) -> Column:
    """Whether sizes and sketches leave a link between the rows with columns of suffixes ``a`` and ``b`` possible."""
    off = lambda names: sum((F.bit_count(F.col(c + a).bitwiseXOR(F.col(c + b))) for c in names), F.lit(0))
    n, m = F.col("n" + a), F.col("n" + b)
    return ((100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * off(_ODD) <= (100 - percent) * (n + m))
            & (off(_BITS) <= bits_off(percent)))


def _named(df: DataFrame, suffix: str, *names: str) -> DataFrame:
    return df.select(*[F.col(c).alias(c + suffix) for c in names])


def _star(members: DataFrame, marks: DataFrame, labels: DataFrame, known: DataFrame | None, turn: int, percent: int) -> DataFrame:
    """Possible pairs of the regions' hubs with members of other components, without those of ``known``."""
    named = members.join(labels, "uid", "left").withColumn("label", F.coalesce("label", "uid")) if labels is not None else members.withColumn("label", F.col("uid"))
    first = F.struct(F.xxhash64("uid", F.lit(turn)), "uid", "label")
    hubs = named.groupBy("key").agg(F.min(first).alias("h")).select("key", F.col("h.uid").alias("hub"), F.col("h.label").alias("hub_label"))
    pairs = (named.join(hubs, "key").where("label <> hub_label")
             .select(F.least("uid", "hub").alias("a"), F.greatest("uid", "hub").alias("b")).distinct())
    if known is not None:
        pairs = pairs.join(known, ["a", "b"], "left_anti")
    held = pairs.join(_named(marks, "_a", "uid", *_ATTRIBUTES), F.col("a") == F.col("uid_a")).join(_named(marks, "_b", "uid", *_ATTRIBUTES), F.col("b") == F.col("uid_b"))
    return held.where(_alike(percent, "_a", "_b")).select("a", "b")


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members, with their label, of the regions whose members are in several components."""
    named = members.join(labels, "uid", "left").withColumn("label", F.coalesce("label", "uid"))
    mixed = named.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key")
    return stored(named.join(mixed, "key", "left_semi"), "mixed_regions")


def _across(mixed: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """Possible pairs between members of one region that are in different components."""
    named = mixed.where("size > 2").join(marks, "uid")
    shares = F.ceil(F.col("size") / SHARE).cast("int")
    dealt = _named(named.withColumn("share", F.pmod(F.xxhash64("uid"), shares).cast("int")), "_a", "key", "share", "uid", "label", *_ATTRIBUTES)
    others = _named(named.withColumn("share", F.explode(F.sequence(F.lit(0), shares - 1))), "_b", "key", "share", "uid", "label", *_ATTRIBUTES)
    found = dealt.join(others, (F.col("key_a") == F.col("key_b")) & (F.col("share_a") == F.col("share_b"))
                       & (F.col("label_a") < F.col("label_b")) & _alike(percent, "_a", "_b"))
    return found.select(F.least("uid_a", "uid_b").alias("a"), F.greatest("uid_a", "uid_b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, class_id per row.

    ``component_id`` is the smallest id that links reach, ``kept`` whether it is the row's own
    id; ``class_id`` names the set, rows of one class have equal sets. Null or wordless text
    has an empty set, no links, its own id as component and is kept. Repeated rows are members
    of one class and share a verdict, as they share an id. Null ids are never smallest; a
    component of null ids only has a null component_id, and its rows are kept. Equal sets are
    linked at any size, and sets too small to reach the threshold with another set are linked
    with equal ones only. Extra columns are ignored; an empty table gives no rows."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(id_col), F.col(text)).alias("doc_key"), F.col(text).cast("string").alias("text"))
    rows = stored(src.mapInArrow(_rows(percent, shingle), ROWS), "forest_sets")
    classes = stored(rows.where("n > 0").groupBy("cid").agg(F.min("uid").alias("uid"), F.min("doc_id").alias("least")), "set_classes")
    forest = rows.where("body is not null").join(classes.select("uid"), "uid", "left_semi")
    bodies = forest.select("uid", "n", "body")

    marks = forest.select("uid", *_ATTRIBUTES)

    members, left = regions(forest), None
    pairs = found = labels = None
    for turn in range(ROUNDS):
        star = stored(_star(members if left is None else left.drop("label"), marks, labels, pairs, turn, percent), "star")
        pairs = star if pairs is None else pairs.unionByName(star)
        more = stored(links(star, bodies, percent, shingle), "links")
        found = more if found is None else found.unionByName(more)
        labels = components(found).withColumnRenamed("node", "uid")
        left = _mixed(members if left is None else left.drop("label"), labels)
    rest = _across(left, marks, percent).join(pairs, ["a", "b"], "left_anti")
    more = stored(links(rest, bodies, percent, shingle), "links")
    if not more.isEmpty():
        labels = components(found.unionByName(more)).withColumnRenamed("node", "uid")

    named = classes.join(labels, "uid", "left").withColumn("label", F.coalesce("label", "uid"))
    of = named.join(named.groupBy("label").agg(F.min("least").alias("component_id")), "label").select("cid", "component_id")
    out = rows.select("doc_id", "n", "cid").join(of, "cid", "left")
    out = out.withColumn("component_id", F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), F.lower(F.hex("cid")).alias("class_id"))
