import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from clipforge.llm import packing
from tests.llm.data import DOCS, corpus, frame


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


ODD = ["<|endoftext|> a", "hello <|endoftext|> world", "x<|endoftext|><|endoftext|>y <|endoftext",  "  two  spaces \n\n lines\t\ttabs ", "naïve ½ Ⅷ 東京 🙂🙂  x y　z", "'s 'S can't", "a\x1cb\x85c", "1234567890" * 5]


def test_pieces_are_the_tokenizer_s_ids(spark, tokenizer):
    rows = corpus() + [(1000 + i, t, "en", "s", 0) for i, t in enumerate(ODD)] + [(2000, "word " * 3000, "en", "s", 0), (None, "x y", "en", "s", 0)]
    got = packing.pack(frame(spark, rows)).collect()
    by = {}
    for g in got:
        by.setdefault(g["doc_id"], []).append(g)
    assert len(by) == len(rows)
    for doc, text, *_ in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        pieces = sorted(by[doc], key=lambda g: g["piece"])
        assert [g["piece"] for g in pieces] == list(range(len(pieces)))
        assert sum(g["length"] for g in pieces) == len(ids)
        assert all(g["length"] == 1024 for g in pieces[1:]) and 1 <= pieces[0]["length"] <= 1024
        at = 0
        for g in pieces:
            assert g["start"] == at and g["ids_crc32"] == zlib.crc32(ids[at:at + g["length"]].tobytes())
            at += g["length"]
    _gapless(got)
    total = sum(g["length"] for g in got)
    assert len({g["sequence_id"] for g in got}) <= -(-total // 1024) + 1


def _gapless(got):
    seqs = {}
    for g in got:
        seqs.setdefault(g["sequence_id"], []).append((g["offset"], g["length"]))
    for places in seqs.values():
        at = 0
        for off, n in sorted(places):
            assert off == at
            at += n
        assert at <= 1024


def test_rounds_merge_underfull_bins_of_many_tasks(spark):
    rows = [(i, "a " * (5 + i % 400), "en", "s", 0) for i in range(400)]
    got = packing.pack(spark.createDataFrame(rows, DOCS).repartition(40)).collect()
    assert len(got) == 400
    _gapless(got)
    total = sum(g["length"] for g in got)
    assert len({g["sequence_id"] for g in got}) <= -(-total // 1024) * 1.03 + 1


def test_the_bound_of_carried_bins_saves_their_number():
    r = np.random.default_rng(5)
    for low, high in ((1, 101), (40, 101), (51, 70), (1, 52), (10, 60)):
        tasks = [packing.best_fit(r.integers(low, high, 300), 100)[2] for _ in range(packing.FAN_IN)]
        assert all((f <= 50).sum() <= 1 for f in tasks)

        def sequences(carry, tasks=tasks):
            masks = [packing.carry_mask(f, 100, carry) for f in tasks]
            merged = packing.best_fit(np.concatenate([f[m] for f, m in zip(tasks, masks, strict=True)]), 100)[2]
            return sum(int((~m).sum()) for m in masks) + len(merged)
        assert sequences(packing.FAN_IN) == sequences(10 ** 9)


def test_best_fit_is_tight():
    r = np.random.default_rng(2)
    sizes = r.integers(1, 101, 500)
    at, off, fill = packing.best_fit(sizes, 100)
    assert fill.max() <= 100 and np.bincount(at, sizes).astype(int).tolist() == fill.tolist()
    least = max(-(-sizes.sum() // 100), (sizes > 50).sum())  # no two items over half share a bin
    assert len(fill) <= 1.02 * least + 1


def test_empty_table_and_clashing_columns(spark):
    assert packing.pack(spark.createDataFrame([], DOCS)).count() == 0
    d = spark.createDataFrame([(1, "x", 7, "b")], "doc_id long, text string, bin int, offset string")
    assert [tuple(r)[:4] for r in packing.pack(d).collect()] == [(1, 0, 0, 2)]
