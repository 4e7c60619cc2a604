import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from clipforge.llm import importance as m
from tests.llm.data import DOCS, corpus, frame


def test_target_like_documents_are_preferred(spark):
    r = random.Random(1)
    good = lambda: " ".join(r.choice("alpha beta gamma delta".split()) for _ in range(60))
    bad = lambda: " ".join(r.choice("spam ham eggs alpha".split()) for _ in range(60))
    rows = [(i, good() if i % 2 else bad(), "en", "s", 0) for i in range(200)]
    target = spark.createDataFrame([(i,) for i in range(1, 60, 2)] + [(None,), (9999,), (1,)], "doc_id long")
    got = m.resample(frame(spark, rows), target, share=0.5).collect()
    assert sum(x["kept"] for x in got) == 100
    assert sum(x["kept"] and x["doc_id"] % 2 for x in got) >= 98
    assert sorted(x["rank"] for x in got) == list(range(1, 201))
    ranked = sorted(got, key=lambda x: x["rank"])
    assert all(a["gumbel_key"] >= b["gumbel_key"] for a, b in zip(ranked, ranked[1:], strict=False))


def test_without_target_it_samples_uniformly(spark):
    rows = [(i, "same text", "en", "s", 0) for i in range(2000)]
    got = m.resample(frame(spark, rows), spark.createDataFrame([], "doc_id long"), share=0.3).collect()
    assert sum(x["kept"] for x in got) == 600 and all(x["log_ratio"] == 0 for x in got)
    low = sum(x["kept"] for x in got if x["doc_id"] < 1000)
    assert 240 < low < 360
    mean = sum(x["gumbel_key"] for x in got) / 2000
    assert abs(mean - 0.5772) < 4 * math.pi / math.sqrt(6 * 2000)


def test_odd_rows_repeats_and_empty_table(spark):
    rows = corpus() + [(None, None, None, None, None), (3, "a", "en", "s", 0), (3, "a", "en", "s", 0)]
    got = m.resample(frame(spark, rows), spark.createDataFrame([(20,)], "doc_id long")).collect()
    assert len(got) == len(rows) and sum(x["kept"] for x in got) == math.ceil(0.85 * len(rows))
    assert [x["log_ratio"] for x in got if x["doc_id"] in (0, 1, 2)] == [0, 0, 0]
    target = spark.createDataFrame([], "doc_id long")
    assert m.resample(spark.createDataFrame([], DOCS), target).count() == 0
    d = spark.createDataFrame([(1, "x", 7, "b")], "doc_id long, text string, rank int, bucket string")
    assert [x["rank"] for x in m.resample(d, target).collect()] == [1]


def brute(rows, target, least, deviations):
    """Log ratio of every text, on strings."""
    split = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for _, t, *_ in rows]
    df = Counter(w for ws in split for w in set(ws))
    grams = [{(w,) for w in ws} | {(a, b) for a, b in zip(ws, ws[1:], strict=False) if df[a] >= least and df[b] >= least} for ws in split]
    docs, good = Counter(g for gs in grams for g in gs), Counter(g for r, gs in zip(rows, grams, strict=True) if r[0] in target for g in gs)
    docs = {g: n for g, n in docs.items() if n >= least}
    p = sum(r[0] in target for r in rows) / len(rows)
    n, total, in_target = len(docs), sum(docs.values()), sum(good[g] for g in docs)
    weight = {g: math.log((good[g] + 1) / (in_target + n)) - math.log((d - good[g] + 1) / (total - in_target + n))
              for g, d in docs.items() if (good[g] - d * p) ** 2 > deviations ** 2 * d * p * (1 - p)}
    return [sum(weight.get(g, 0) for g in gs) for gs in grams], len(weight)


def test_scores_equal_brute_force_whatever_is_broadcast(spark, monkeypatch):
    monkeypatch.setattr(m, "LEAST_DOCS", 3)
    monkeypatch.setattr(m, "DEVIATIONS", 0.5)
    rows = corpus(n=150)
    rows.append(rows[40])  # a row that repeats
    target = set(range(0, 150, 4))
    want, entries = brute(rows, target, 3, 0.5)
    assert entries > 100
    ids = spark.createDataFrame([(i,) for i in target], "doc_id long")
    for head in (1 << 20, 40, 0):
        got = m.resample(frame(spark, rows), ids, head=head).collect()
        key = lambda x: (x[0], round(x[1], 9))
        assert sorted((x["doc_id"], round(x["log_ratio"], 6) + 0.0) for x in got) == sorted(
            ((r[0], round(x, 6) + 0.0) for r, x in zip(rows, want, strict=True)), key=key)


def test_counts_handed_on_in_parts_are_whole(monkeypatch):
    texts = pa.array([t for _, t, *_ in corpus(n=100)])
    rows = pa.RecordBatch.from_arrays([texts, pa.array([i % 3 == 0 for i in range(100)])], ["text", "target"])

    def summed(held, step, bits):
        monkeypatch.setattr(m, "HELD", held)
        parts = {}
        for out in m._count(bits)(iter([rows.slice(i, step) for i in range(0, 100, step)])):
            for x in out.to_pylist():
                parts.setdefault(x["part"], []).append(x["block"])
        return sorted(tuple(r.values()) for blocks in parts.values() for r in m._sum_range(1)(pa.table({"block": blocks})).to_pylist()), len(parts)

    whole, ranges = summed(1 << 20, 100, 3)
    assert ranges == 8 and len(whole) > 300 and max(n for _, n, _ in whole) > 5
    assert summed(50, 10, 3)[0] == whole and summed(50, 7, 12)[0] == whole


def test_filter_holds_every_member(spark):
    keys = [r.getrandbits(64) - (1 << 63) for r in [random.Random(5)] for _ in range(3000)]
    f = m.Filter.of(spark.createDataFrame([(k,) for k in keys], "key long"))
    assert f(np.array(keys, np.int64).view(np.uint64)).all()
    other = np.random.default_rng(1).integers(0, 1 << 63, 10_000, dtype=np.uint64)
    assert f(other).mean() < 0.2


def test_documents_with_rare_bad_words_rank_below_clean_ones(spark):
    r = random.Random(7)
    word = lambda: "".join(r.choice("aeiourstnl") for _ in range(r.randint(2, 6)))
    bad = ["scum", "moron", "trash"]
    rows = []
    for i in range(900):
        ws = [r.choice(["the", "and", "of"]) if r.random() < 0.3 else word() for _ in range(80)]
        for at in r.sample(range(80), 4) if i % 6 == 0 else []:
            ws[at] = r.choice(bad)
        rows.append((i, " ".join(ws), "en", "s", 0))
    target = spark.createDataFrame([(i,) for i in range(0, 900) if i % 6 and i % 5 < 2], "doc_id long")
    got = {x["doc_id"]: x["kept"] for x in m.resample(frame(spark, rows), target, share=5 / 6).collect()}
    assert sum(got[i] for i in got if i % 6 == 0) <= 8
    assert sum(not got[i] for i in got if i % 6) <= 8
    unknown = [i for i in got if i % 6 and i % 5 >= 2]
    assert sum(got[i] for i in unknown) >= 0.98 * len(unknown)  # clean, though not in the target
