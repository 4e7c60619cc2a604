"""Removal of long repeated byte strings with a logarithmic family of suffix arrays.

Every byte covered by a string of ``LENGTH`` bytes that also starts anywhere else
(same document included) is removed; strings are judged on the input.

How it scales
-------------
* *Anchors.* A string's anchor is its smallest ``KMER``-byte substring by hash
  (leftmost on ties), so equal strings have equal anchors at equal places. Runs of
  neighbouring strings share an anchor; a run and the text it spans (a *context*)
  is all that is needed to judge its strings. Documents of any length are cut at any
  place without changing the result.
* *Batches and shards.* A task cuts its documents into batches. Contexts are dealt
  to shards by anchor, in one compressed block per ``GROUP`` of batches and shard (shards grow with
  the corpus, so blocks of single batches would become tiny and their number quadratic), so
  equal strings always meet. Contexts that repeat inside a batch are settled there (pre-aggregation):
  their copies are reported at once and only one goes on.
* *The index family.* A shard takes its blocks in turn, small ones together. The strings of a batch whose
  anchor occurs elsewhere get a suffix array; it is merge-scanned against every
  existing level for matches of full length, and what was not found becomes a new
  level. Levels of like size merge, so each string is merged O(log batches) times.
  Suffixes are ordered by a 64-bit fingerprint of their first ``LENGTH`` bytes: only
  the adjacency of equal prefixes is needed, and it is the same as in byte order.
* *Hot anchors* (over 1 / ``HOT_SHARE`` partitions' worth of all contexts; at most
  ``HOT_SHARE`` x partitions of them, so the list is small) would land in one shard
  with all their contexts. Their strings are dealt one by one by fingerprint instead,
  after settling repeats inside the batch.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipforge.llm.common import mix, partitions, prefix_hash, span_hash, text_bytes

LENGTH = 200
KMER = 32
#: Bytes of text in a batch.
BATCH = 2 << 20
#: Bytes of text whose contexts share a block per shard.
GROUP = 16 << 20
#: Strings that a shard takes in together, when blocks hold fewer.
STRINGS = 1 << 19
SHARDS_PER_PARTITION = 2
HOT_SHARE = 8
HOT_LEAST = 500

_POS = np.uint64((1 << 24) - 1)
SPANS = "did long, tag int, s long, e long"


def _sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    have = 1
    while have * 2 <= width:
        a = np.minimum(a[:-have], a[have:])
        have *= 2
    return np.minimum(a[:len(a) - (width - have)], a[width - have:]) if width > have else a


class Batch:
    """The runs of the strings that start in [lo, hi) of a column's bytes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lo: int, hi: int):
        self.lo, self.data, self.offsets = lo, data[lo:hi + LENGTH - 1], offsets
        n = len(self.data)
        starts = min(hi - lo, n - LENGTH + 1)
        self.akey = np.zeros(0, np.uint64)
        self.start = self.count = self.doc = np.zeros(0, np.int64)
        if starts <= 0:
            return
        d0, d1 = np.searchsorted(offsets, lo, "right") - 1, np.searchsorted(offsets, lo + n, "left")
        ends = np.clip(offsets[d0 + 1:d1 + 1] - lo, 0, n)
        begins = np.clip(offsets[d0:d1] - lo, 0, n)
        ok = np.zeros(starts + 1, np.int8)  # +1 where a document's strings begin, -1 after the last
        b, e = np.minimum(begins, starts), np.minimum(np.maximum(ends - LENGTH + 1, begins), starts)
        np.add.at(ok, b, 1)
        np.add.at(ok, e, -1)
        at = np.flatnonzero(np.cumsum(ok[:-1], dtype=np.int64))
        if not len(at):
            return
        self.prefix = prefix_hash(self.data)
        kmers = np.arange(n - KMER + 1)
        h = span_hash(self.prefix, kmers, kmers + KMER)
        least = _sliding_min((h & ~_POS) | kmers.astype(np.uint64), LENGTH - KMER + 1)[at]
        anchor = (least & _POS).astype(np.int64)
        new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)]))
        self.akey, self.start = h[anchor[new]], at[new]
        self.count = np.diff(np.concatenate([new, [len(at)]]))
        self.doc = np.searchsorted(offsets, self.start + lo, "right") - 1

    def fingerprints(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The fingerprint of each string of the runs, and the place where it starts."""
        w = _ranges(self.start[runs], self.count[runs])
        return span_hash(self.prefix, w, w + LENGTH), w


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start, start + 1, ... count times, for each pair, laid end to end."""
    total = int(count.sum())
    skip = np.repeat(start - np.concatenate([[0], np.cumsum(count)[:-1]]), count) if total else np.zeros(0, np.int64)
    return skip + np.arange(total)


def _batches(data: np.ndarray, offsets: np.ndarray) -> Iterator[Batch]:
    for lo in range(0, len(data), BATCH):
        yield Batch(data, offsets, lo, min(lo + BATCH, len(data)))


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each key occurs more than once, and the places of the first of each."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    first = np.concatenate([[True], k[1:] != k[:-1]]) if len(k) else np.zeros(0, bool)
    size = np.diff(np.concatenate([np.flatnonzero(first), [len(k)]]))
    many = np.zeros(len(k), bool)
    many[order] = np.repeat(size > 1, size)
    return many, order[first]


def _merged(doc: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping or touching spans of a document become one."""
    if not len(s):
        return doc, s, e
    order = np.lexsort((s, doc))
    doc, s, e = doc[order], s[order], e[order]
    group = np.cumsum(np.concatenate([[False], doc[1:] != doc[:-1]]))
    far = int(e.max()) + 1  # one number line for all documents
    reach = np.maximum.accumulate(e + group * far)
    new = np.concatenate([[True], (s[1:] + group[1:] * far > reach[:-1]) | (group[1:] != group[:-1])])
    at = np.flatnonzero(new)
    last = np.concatenate([at[1:], [len(s)]]) - 1
    return doc[at], s[at], reach[last] - group[last] * far


def _count_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors that occur twice or more in a batch, with counts; under null, all contexts."""
    for rows in batches:
        total = 0
        for b in _batches(*text_bytes(rows.column(0))):
            total += len(b.akey)
            keys, n = np.unique(b.akey, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys[n > 1].view(np.int64)), pa.array(n[n > 1])], ["akey", "n"])
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([total], pa.int64())], ["akey", "n"])


def hot_anchors(docs: DataFrame, text: str) -> np.ndarray:
    """Anchors of so many contexts that one shard should not hold them. Only batches that
    hold an anchor twice count it, which can make a warm anchor cold, never a result wrong."""
    n = partitions(docs.sparkSession)
    counts = (docs.select(F.col(text).alias("t")).mapInArrow(_count_anchors, "akey long, n long")
              .groupBy("akey").agg(F.sum("n").alias("n")).where(F.col("akey").isNull() | (F.col("n") > HOT_LEAST)))
    counts = counts.orderBy(F.desc("n")).limit(HOT_SHARE * n + 1).collect()
    total = sum(r["n"] for r in counts if r["akey"] is None)
    least = max(HOT_LEAST, total // (HOT_SHARE * n))
    return np.sort(np.array([r["akey"] for r in counts if r["akey"] is not None and r["n"] > least], np.int64).view(np.uint64))


def _pack(*arrays) -> bytes:
    return zstandard.ZstdCompressor(level=6).compress(pickle.dumps(arrays, protocol=5))


def _unpack(block: bytes):
    return pickle.loads(zstandard.ZstdDecompressor().decompress(block))


class _Blocks:
    """Contexts (kind 0) and hot strings (kind 1) of some batches by shard, until they are packed."""

    def __init__(self, shards: int):
        self.shards, self.bytes = shards, 0
        self.parts: dict[tuple[int, int], list] = {}
        self.spans: list[tuple] = []

    def add(self, kind: int, shard: np.ndarray, *fields, text=None) -> None:
        """Fields in the order of ``shard``, which ascends, and the texts, laid end to end, of given sizes."""
        cuts = np.searchsorted(shard, np.arange(self.shards + 1))
        ends = np.concatenate([[0], np.cumsum(text[1])]) if text else None
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            a, z = int(cuts[k]), int(cuts[k + 1])
            own = [x[a:z] for x in fields] + ([text[0][ends[a]:ends[z]]] if text else [])
            self.parts.setdefault((kind, k), []).append(own)

    def packed(self, task: int, serial: int) -> pa.RecordBatch:
        out = []
        for (kind, k), own in sorted(self.parts.items()):
            key, did, *rest = [np.concatenate(x) for x in zip(*own, strict=True)]
            # anchors only screen, so half of one will do
            head = (key >> np.uint64(32)).astype(np.uint32) if kind == 0 else key
            out.append((kind * self.shards + k, kind, head.tobytes(), _pack(np.diff(did, prepend=0), *rest)))
        if self.spans:
            did, *rest = [np.concatenate(x) for x in zip(*self.spans, strict=True)]
            out.append((2 * self.shards + (task + serial) % self.shards, 2, b"", _pack(np.diff(did, prepend=0), *rest)))
        shard, kind, keys, block = zip(*out, strict=True) if out else ([], [], [], [])
        return pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array(kind, pa.int32()), pa.array([(task << 32) + serial] * len(out), pa.int64()),
                                           pa.array(keys, pa.binary()), pa.array(block, pa.binary())], ["shard", "kind", "batch", "keys", "block"])


def _deal(hot: np.ndarray, shards: int):
    """Batches to blocks: contexts by anchor, hot strings by fingerprint, settled spans."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, serial, blocks = TaskContext.get().partitionId(), 0, _Blocks(shards)
        for rows in batches:
            did = rows.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            tag = rows.column(1).to_numpy(zero_copy_only=False).astype(np.int32)
            for b in _batches(*text_bytes(rows.column(2))):
                if not len(b.akey):
                    continue
                base = b.offsets[b.doc] - b.lo  # where a run's document begins in the batch
                is_hot = np.isin(b.akey, hot)
                runs = np.flatnonzero(~is_hot)
                ends = b.start + b.count + LENGTH - 1
                whole = mix(span_hash(b.prefix, b.start[runs], ends[runs]) ^ mix(b.akey[runs] + b.count[runs].astype(np.uint64)))
                many, first = _repeats(whole)
                settled = [(b.doc[runs[many]], (b.start - base)[runs[many]], (ends - base)[runs[many]])]
                runs = np.sort(runs[first])
                shard = (mix(b.akey[runs]) % np.uint64(shards)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                r, sizes = runs[order], b.count[runs[order]] + LENGTH - 1
                blocks.add(0, shard[order], b.akey[r], did[b.doc[r]], b.count[r].astype(np.int32), tag[b.doc[r]], (b.start - base)[r],
                           text=(b.data[_ranges(b.start[r], sizes)], sizes))
                hot_runs = np.flatnonzero(is_hot)
                if len(hot_runs):
                    fp, w = b.fingerprints(hot_runs)
                    owner = np.repeat(hot_runs, b.count[hot_runs])
                    many, first = _repeats(fp)
                    at = w - base[owner]
                    settled.append((b.doc[owner[many]], at[many], at[many] + LENGTH))
                    first = np.sort(first)
                    shard = (mix(fp[first] + np.uint64(1)) % np.uint64(shards)).astype(np.int64)
                    order = np.argsort(shard, kind="stable")
                    i = first[order]
                    d = b.doc[owner[i]]
                    blocks.add(1, shard[order], fp[i], did[d], tag[d], at[i])
                doc, s, e = _merged(*[np.concatenate(x) for x in zip(*settled, strict=True)])
                if len(s):
                    blocks.spans.append((did[doc], tag[doc], s, e))
                blocks.bytes += len(b.data)
                if blocks.bytes >= GROUP:
                    serial += 1
                    yield blocks.packed(task, serial)
                    blocks = _Blocks(shards)
        yield blocks.packed(task, serial + 1)
    return run


class SuffixFamily:
    """Levels of suffix arrays: sorted fingerprints with the number of the string each stands for."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, keys: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Take in a batch; the numbers of strings, new or old, that now have an equal."""
        order = np.argsort(keys, kind="stable")
        keys, numbers = keys[order], numbers[order]
        first = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
        size = np.diff(np.concatenate([np.flatnonzero(first), [len(keys)]]))
        found = [numbers[np.repeat(size > 1, size)]]
        group = np.cumsum(first) - 1
        keys_1, numbers_1 = keys[first], numbers[first]
        fresh = np.ones(len(keys_1), bool)
        for level_keys, level_numbers in self.levels:
            at = np.searchsorted(level_keys, keys_1)
            at[at == len(level_keys)] = 0
            hit = level_keys[at] == keys_1
            found += [level_numbers[at[hit]], numbers[hit[group]]]
            fresh &= ~hit
        if fresh.any():
            self.levels.append((keys_1[fresh], numbers_1[fresh]))
        while len(self.levels) > 1 and len(self.levels[-2][0]) <= 2 * len(self.levels[-1][0]):
            (a, x), (b, y) = self.levels.pop(), self.levels.pop()
            merged = np.concatenate([b, a])
            order = np.argsort(merged, kind="stable")
            self.levels.append((merged[order], np.concatenate([y, x])[order]))
        return np.concatenate(found)


def _scan_shard(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("batch")
    kinds = rows.column("kind").to_pylist()
    blocks = rows.column("block")
    did, tag, s, e = [], [], [], []
    if kinds and kinds[0] == 2:
        for block in blocks:
            d, t, a, z = _unpack(block.as_py())
            did.append(np.cumsum(d)), tag.append(t), s.append(a), e.append(z)
    elif kinds:
        screen = None
        heads = [np.frombuffer(x.as_py(), np.uint32 if kinds[0] == 0 else np.uint64) for x in rows.column("keys")]
        if kinds[0] == 0:  # anchors that stand in two contexts or more
            keys, n = np.unique(np.concatenate(heads), return_counts=True)
            screen = keys[n > 1]
        family, seen, waiting, strings = SuffixFamily(), 0, [], 0
        who, tags, places, found = [], [], [], []
        for last, head, block in zip([False] * (len(heads) - 1) + [True], heads, blocks, strict=True):
            pick = None
            if screen is None:
                fp = head
                d, t, at = _unpack(block.as_py())
                d = np.cumsum(d)
            elif len(pick := np.flatnonzero(np.isin(head, screen))):
                d, count, t, start, text = _unpack(block.as_py())
                d = np.cumsum(d)
                begin = np.concatenate([[0], np.cumsum(count.astype(np.int64) + LENGTH - 1)])[:-1]
                n = count[pick].astype(np.int64)
                w = _ranges(begin[pick], n)
                fp = span_hash(prefix_hash(text), w, w + LENGTH)
                d, t, at = np.repeat(d[pick], n), np.repeat(t[pick], n), _ranges(start[pick], n)
            if pick is None or len(pick):
                waiting.append(fp), who.append(d), tags.append(t), places.append(at)
                strings += len(fp)
            if strings >= STRINGS or (last and strings):
                fp = np.concatenate(waiting)
                found.append(family.add(fp, np.arange(seen, seen + len(fp))))
                seen, waiting, strings = seen + len(fp), [], 0
        if seen:
            hit = np.unique(np.concatenate(found))
            d, t, at = np.concatenate(who)[hit], np.concatenate(tags)[hit], np.concatenate(places)[hit]
            new = np.concatenate([[True], (np.diff(d) != 0) | (np.diff(t) != 0) | (np.diff(at) != 1)]) if len(hit) else np.zeros(0, bool)
            i = np.flatnonzero(new)
            last = np.concatenate([i[1:], [len(hit)]]) - 1 if len(i) else i
            did.append(d[i]), tag.append(t[i]), s.append(at[i]), e.append(at[last] + LENGTH)
    cat = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, kind)
    return pa.table({"did": cat(did, np.int64), "tag": cat(tag, np.int32), "s": cat(s, np.int64), "e": cat(e, np.int64)})


def _keyed(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """did and tag tell rows apart, also where an id is null or repeats: rows with equal
    id and equal text have equal spans. The session's rows are never numbered."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).select(
        "doc_id", F.coalesce("doc_id", F.lit(0).cast("long")).alias("did"),
        F.hash("text", F.col("doc_id").isNull()).alias("tag"), "text")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(did, tag, s, e): byte spans of repeated strings; spans of a document may overlap."""
    hot = hot_anchors(docs, text)
    shards = SHARDS_PER_PARTITION * partitions(docs.sparkSession)
    blocks = _keyed(docs, id_col, text).select("did", "tag", "text").mapInArrow(
        _deal(hot, shards), "shard int, kind int, batch long, keys binary, block binary")
    return blocks.groupBy("shard").applyInArrow(_scan_shard, SPANS)


def _cut(with_bytes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            data, offsets = text_bytes(rows.column(1))
            sizes = np.diff(offsets)
            spans = rows.column(2)
            where = np.concatenate([[0], np.cumsum(spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
            flat = spans.flatten()
            doc, s, e = _merged(np.repeat(np.arange(len(sizes)), np.diff(where)),
                                flat.field("s").to_numpy(zero_copy_only=False).astype(np.int64), flat.field("e").to_numpy(zero_copy_only=False).astype(np.int64))
            removed = np.bincount(doc, e - s, minlength=len(sizes)).astype(np.int64)
            runs = np.bincount(doc, minlength=len(sizes))
            cut = np.searchsorted(doc, np.arange(len(sizes) + 1))
            kept, digest = [], []
            for i in range(len(sizes)):
                own = data[offsets[i]:offsets[i + 1]]
                if runs[i]:
                    edges = [0, *np.stack([s[cut[i]:cut[i + 1]], e[cut[i]:cut[i + 1]]], 1).ravel().tolist(), len(own)]
                    own = b"".join(own[a:z].tobytes() for a, z in zip(edges[::2], edges[1::2], strict=True))
                else:
                    own = own.tobytes()
                digest.append(hashlib.sha256(own).hexdigest())
                if with_bytes:
                    kept.append(own)
            arrays = [rows.column(0), pa.array(sizes), pa.array(removed), pa.array(runs.astype(np.int64)), pa.array(digest)]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(kept, pa.binary())] * with_bytes, names + ["kept"] * with_bytes)
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", with_bytes: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per document, and with
    ``with_bytes`` the bytes that stay (binary: a cut may fall inside a character).

    Null text is empty. A row that repeats another row exactly is a copy like any
    other: both lose all strings. Rows that share an id but not the text, and null ids,
    are documents of their own."""
    spans = (repeated_spans(docs, id_col, text).groupBy("did", "tag")
             .agg(F.collect_list(F.struct("s", "e")).alias("spans")))
    joined = _keyed(docs, id_col, text).join(spans, ["did", "tag"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(_cut(with_bytes), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
                             + ", kept binary" * with_bytes)
