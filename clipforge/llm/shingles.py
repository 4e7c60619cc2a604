"""Word shingle sets of whole texts as hashes, whole columns at a time, and exact counts on them.

A word has two hashes of 64 bits, independent of each other. Up to 32 bytes they are
mixed from eight bytes after eight bytes, whole columns at once; longer words go through
BLAKE2b. No step is linear over the bytes, so no family of texts shares its hashes.
Shingles are sorted by the first hash; sets and pairs compare both.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipforge.llm.common import mix, stored

SHINGLE = 3

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of text hashed at once.
CHUNK = 2 << 20


_SEEDS = (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344))
_ODD = np.uint64(0x9E3779B97F4A7C15)
_LANES = 4
_LOW = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit hashes of every word data[start:end]."""
    size = end - start
    padded = np.concatenate([data, np.zeros(8 * _LANES, np.uint8)])
    eight = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
    out = [mix(size.astype(np.uint64) ^ seed) for seed in _SEEDS]
    for lane in range(_LANES):
        live = np.flatnonzero(size > 8 * lane) if lane else slice(None)
        part = eight[start[live] + 8 * lane] & _LOW[np.minimum(size[live] - 8 * lane, 8)]
        for h in out:
            h[live] = mix((h[live] ^ part) * _ODD)
    for i in np.flatnonzero(size > 8 * _LANES):
        digest = np.frombuffer(hashlib.blake2b(data[start[i]:end[i]].tobytes(), digest_size=16).digest(), np.uint64)
        out[0][i], out[1][i] = digest
    return out


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Both hashes of the words (runs without white space, A-Z lower-cased) of every text,
    and the n + 1 offsets of each text's words."""
    hashes: tuple[list, list] = ([], [])
    counts = np.zeros(len(offsets) - 1, np.int64)
    d = 0
    while d < len(offsets) - 1:
        e = max(d + 1, int(np.searchsorted(offsets, offsets[d] + CHUNK, "right")) - 1)
        part = _LOWER[data[offsets[d]:offsets[e]]]
        cuts = offsets[d:e] - offsets[d]
        inside = ~_SPACE[part]
        if len(part):
            starts = inside.copy()
            starts[1:] &= ~inside[:-1]
            stops = inside.copy()
            stops[:-1] &= ~inside[1:]
            edge = cuts[(cuts > 0) & (cuts < len(part))]  # words end with their text
            starts[edge] = inside[edge]
            stops[edge - 1] = inside[edge - 1]
            s, z = np.flatnonzero(starts), np.flatnonzero(stops) + 1
            for found, h in zip(hashes, word_hashes(part, s, z), strict=True):
                found.append(h)
            counts[d:e] = np.diff(np.concatenate([np.searchsorted(s, cuts), [len(s)]]))
        d = e
    return [np.concatenate(h) if h else np.zeros(0, np.uint64) for h in hashes], np.concatenate([[0], np.cumsum(counts)])


def shingles(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> tuple[list[np.ndarray], np.ndarray]:
    """Both hashes of all runs of ``k`` words of each text, repeats included, and their offsets.
    A text of fewer words is one shingle, a text without words has none."""
    both, at = words(data, offsets)
    n = np.diff(at)
    size = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    out_at = np.concatenate([[0], np.cumsum(size)])
    first = np.repeat(at[:-1] - out_at[:-1], size) + np.arange(out_at[-1])
    length = np.repeat(np.minimum(n, k), size)
    out = []
    for w in both:
        padded = np.concatenate([w, np.zeros(k, np.uint64)])
        h = length.astype(np.uint64)
        for j in range(k):
            h = np.where(length > j, mix(h * _ODD + padded[first + j]), h)
        out.append(h)
    return out, out_at


Set = tuple[np.ndarray, np.ndarray]


def sets(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> list[Set]:
    """The distinct shingles of each text: first hashes, sorted, and second hashes beside them."""
    (h, g), at = shingles(data, offsets, k)
    out = []
    for a, z in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        own, first = np.unique(h[a:z], return_index=True)
        out.append((own, g[a:z][first]))
    return out


def set_key(own: Set) -> bytes:
    """128 bits that equal sets share."""
    return hashlib.blake2b(own[0].tobytes() + own[1].tobytes(), digest_size=16).digest()


def common(s: Set, t: Set) -> int:
    """The exact size of the intersection."""
    if len(s[0]) > len(t[0]):
        s, t = t, s
    at = np.searchsorted(t[0], s[0])
    at[at == len(t[0])] = 0
    return int(np.count_nonzero((t[0][at] == s[0]) & (t[1][at] == s[1])))


def smallest_linked(percent: int) -> int:
    """The smallest set that can be linked with a set that differs from it."""
    n = 1
    while 100 * n < percent * (n + 1):
        n += 1
    return n


def _overlaps(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor().decompress
        known: dict[int, Set] = {}

        def own(uid, body) -> Set:
            if uid not in known:
                if len(known) >= 256:
                    known.clear()
                data = np.frombuffer(unzip(body.as_py()), np.uint8)
                known[uid] = sets(data, np.array([0, len(data)]), shingle)[0]
            return known[uid]

        for rows in batches:
            a, b = rows.column(0).to_pylist(), rows.column(1).to_pylist()
            out = [common(own(x, p), own(y, q)) for x, y, p, q in zip(a, b, rows.column(2), rows.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(out, pa.int64())], ["a", "b", "overlap"])
    return run


def reaches(overlap: Column, n: Column, m: Column, percent: int) -> Column:
    return 100 * overlap >= percent * (n + m - overlap)


def links(pairs: DataFrame, bodies: DataFrame, percent: int, shingle: int) -> DataFrame:
    """The pairs (a, b) of uids whose whole sets reach the threshold, counted exactly.
    ``bodies`` has uid, n (size of the set) and body (the text, compressed) of every row."""
    side = lambda c: bodies.select(F.col("uid").alias(c), F.col("body").alias(f"body_{c}"))
    whole = pairs.join(side("a"), "a").join(side("b"), "b")
    sizes = bodies.select("uid", "n")
    counted = whole.select("a", "b", "body_a", "body_b").mapInArrow(_overlaps(shingle), "a long, b long, overlap long")
    counted = (counted.join(sizes.select(F.col("uid").alias("a"), F.col("n").alias("n_a")), "a")
               .join(sizes.select(F.col("uid").alias("b"), F.col("n").alias("n_b")), "b"))
    return counted.where(reaches(F.col("overlap"), F.col("n_a"), F.col("n_b"), percent)).select("a", "b")


#: Sets on one side of a tile of :func:`degrees`, their shingles together, and columns multiplied at once.
TILE_SETS = 256
TILE_SHINGLES = 1 << 20
TILE_COLUMNS = 1 << 13


def _tile(percent: int, shingle: int):
    def run(rows: pa.Table) -> pa.Table:
        unzip = zstandard.ZstdDecompressor().decompress
        texts = [unzip(x.as_py()) for x in rows.column("body")]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        own = sets(np.frombuffer(b"".join(texts), np.uint8), offsets, shingle)
        n = np.array([len(h) for h, _ in own])
        h, g = (np.concatenate([s[k] for s in own]) for k in (0, 1))
        order = np.lexsort((g, h))
        row, h, g = np.repeat(np.arange(len(own)), n)[order], h[order], g[order]
        col = np.concatenate([[0], np.cumsum((h[1:] != h[:-1]) | (g[1:] != g[:-1]))])
        left = ~rows.column("right").to_numpy()
        a, b = (np.flatnonzero(x) for x in (left, ~left))
        if not len(b):  # a tile on the diagonal
            b = a
        overlap = np.zeros((len(a), len(b)), np.int64)
        for lo in range(0, int(col[-1]) + 1, TILE_COLUMNS):
            part = slice(*np.searchsorted(col, [lo, lo + TILE_COLUMNS]))
            m = np.zeros((len(own), TILE_COLUMNS), np.float32)
            m[row[part], col[part] - lo] = 1
            overlap += (m[a] @ m[b].T).astype(np.int64)
        linked = (100 * overlap >= percent * (n[a][:, None] + n[b][None, :] - overlap)) & (a[:, None] != b[None, :])
        count = np.zeros(len(own), np.int64)
        count[b] = linked.sum(0)
        count[a] = linked.sum(1)
        return pa.table({"uid": rows.column("uid"), "n_links": pa.array(count)})
    return run


def degrees(links: DataFrame, labels: DataFrame, bodies: DataFrame, percent: int, shingle: int) -> DataFrame:
    """(uid, n_links): with how many other sets each set of a component is linked, all pairs
    counted exactly on their whole sets. ``links`` are verified links that carry the components
    ``labels`` (node, label). Where they are all pairs of a component, they are the count; the
    other components are cut into tiles of ``TILE_SETS`` by ``TILE_SETS`` sets, each counted in
    a task's memory, whatever the size of the component."""
    of = labels.select(F.col("node").alias("uid"), "label")
    known = links.join(of, F.col("a") == F.col("uid")).groupBy("label").agg(F.count(F.lit(1)).alias("known"))
    size = of.join(bodies.select("uid", "n"), "uid").groupBy("label").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("total"))
    blocks = F.ceil(F.greatest(F.col("m") / TILE_SETS, F.col("total") / TILE_SHINGLES))
    partial = stored(size.join(known, "label").where(2 * F.col("known") < F.col("m") * (F.col("m") - 1)).select("label", blocks.alias("blocks")), "partial")
    members = (of.join(partial, "label").join(bodies.select("uid", "body"), "uid")
               .withColumn("block", F.pmod(F.xxhash64("uid"), F.col("blocks"))).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    tiles = members.select("uid", "body", "label", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
                           (F.col("block") > F.col("other")).alias("right"))
    counted = (tiles.groupBy("label", "lo", "hi").applyInArrow(_tile(percent, shingle), "uid long, n_links long")
               .groupBy("uid").agg(F.sum("n_links").alias("n_links")))
    whole = of.join(partial, "label", "left_anti").select("uid")
    ends = links.select(F.explode(F.array("a", "b")).alias("uid")).join(whole, "uid").groupBy("uid").agg(F.count(F.lit(1)).alias("n_links"))
    return ends.unionByName(counted)
