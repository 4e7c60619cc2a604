import collections
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest

from clipforge.llm import suffix_dedup
from clipforge.llm.common import text_bytes
from tests.llm.data import DOCS, corpus, frame


def brute(texts, length=suffix_dedup.LENGTH):
    blobs = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[i:i + length] for b in blobs for i in range(len(b) - length + 1))
    for b in blobs:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        edges = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        yield len(b), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest()


def _bytes(texts):
    return text_bytes(pa.array(texts, pa.string()))


@pytest.mark.parametrize("hot", [False, True])
def test_equals_brute_force(spark, monkeypatch, hot):
    """Also with every other anchor taken as hot, whose strings are dealt one by one."""
    rows = corpus() + [(None, corpus()[20][1], "en", "s1", 0)]
    if hot:
        anchors = np.unique(np.concatenate([b.akey for b in suffix_dedup._batches(*_bytes([r[1] for r in rows]))]))
        monkeypatch.setattr(suffix_dedup, "hot_anchors", lambda docs, text: anchors[::2])
    got = suffix_dedup.remove_repeats(frame(spark, rows), with_bytes=True).collect()
    want = [(r[0], *w) for r, w in zip(rows, brute([r[1] for r in rows]), strict=True)]
    assert sorted(map(repr, (tuple(g)[:5] for g in got))) == sorted(map(repr, want))
    assert all(hashlib.sha256(g["kept"]).hexdigest() == g["kept_sha256"] for g in got)


def test_hot_anchors_are_found(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_LEAST", 20)
    monkeypatch.setattr(suffix_dedup, "HOT_SHARE", 1)
    rows = [(i, "p%d " % i + " ".join(f"word{k}" for k in range(60)), "en", "s", 0) for i in range(300)]
    assert 0 < len(suffix_dedup.hot_anchors(frame(spark, rows), "text")) <= 5


def test_batches_may_cut_documents_anywhere():
    data, offsets = text_bytes(pa.array([r[1] for r in corpus()]))
    strings = lambda cut: sorted((int(b.akey[i]), b.lo + int(b.start[i]) + k) for lo in range(0, len(data), cut)
                                 for b in [suffix_dedup.Batch(data, offsets, lo, min(lo + cut, len(data)))] for i in range(len(b.akey)) for k in range(b.count[i]))
    assert strings(len(data)) == strings(777)


def test_family_finds_every_repeat_and_stays_logarithmic():
    r = np.random.default_rng(1)
    keys = r.integers(0, 3000, 5000).astype(np.uint64)
    family, found = suffix_dedup.SuffixFamily(), []
    for s in range(0, len(keys), 50):
        found.append(family.add(keys[s:s + 50], np.arange(s, s + 50)))
    unique, n = np.unique(keys, return_counts=True)
    assert set(np.concatenate(found).tolist()) == set(np.flatnonzero(np.isin(keys, unique[n > 1])).tolist())
    assert len(family.levels) <= 14


def test_empty_table_and_clashing_columns(spark):
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], DOCS)).count() == 0
    d = spark.createDataFrame([(1, "x" * 300, "k", 5)], "doc_id long, text string, did string, s int")
    assert [tuple(r)[:4] for r in suffix_dedup.remove_repeats(d).collect()] == [(1, 300, 300, 1)]


def test_a_shard_gets_a_block_per_group_of_batches(monkeypatch):
    """Not one per batch; groups, hot strings and small blocks taken in together change no span."""
    texts = [r[1] for r in corpus(5, 80)]
    rows = pa.RecordBatch.from_arrays([pa.array(range(80), pa.int64()), pa.array([0] * 80, pa.int32()), pa.array(texts, pa.string())], ["did", "tag", "text"])
    monkeypatch.setattr(suffix_dedup, "TaskContext", type("Task", (), {"get": staticmethod(lambda: type("One", (), {"partitionId": lambda self: 3})())}))
    monkeypatch.setattr(suffix_dedup, "BATCH", 1000)
    anchors = np.unique(np.concatenate([b.akey for b in suffix_dedup._batches(*_bytes(texts))]))
    want = [(x[1], x[2]) for x in brute(texts)]
    for group, strings, hot in [(1 << 24, 1 << 19, anchors[:0]), (4000, 300, anchors[::2]), (1, 1, anchors[::3])]:
        monkeypatch.setattr(suffix_dedup, "GROUP", group)
        monkeypatch.setattr(suffix_dedup, "STRINGS", strings)
        blocks = pa.Table.from_batches(suffix_dedup._deal(hot, 5)(iter([rows.slice(0, 30), rows.slice(30)])))
        if group == 1 << 24:
            assert sorted(blocks.column("shard").to_pylist()) == sorted(set(blocks.column("shard").to_pylist()))
        spans = [suffix_dedup._scan_shard(blocks.filter(pa.compute.equal(blocks.column("shard"), k))) for k in sorted(set(blocks.column("shard").to_pylist()))]
        spans = pa.concat_tables(spans)
        did, s, e = suffix_dedup._merged(*[spans.column(c).to_numpy() for c in ("did", "s", "e")])
        assert [(int((e - s)[did == i].sum()), int((did == i).sum())) for i in range(80)] == want
