import random
import zlib

import numpy as np
import pyarrow as pa

from clipforge.llm import language_cnn as cnn
from clipforge.llm.common import text_bytes
from tests.llm.data import DOCS

SYLLABLES = {"en": "the ing tion and er of sh wh".split(), "de": "sch ung ein der lich ü pf keit".split(), "fr": "eau que les é oi tre ment ai".split()}


def labelled(n=400, seed=1):
    r = random.Random(seed)
    out = []
    for i in range(n):
        lang = r.choice(list(SYLLABLES))
        text = " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 4))) for _ in range(r.randint(8, 120)))
        out.append((i, text, lang, "s", 0))
    return out


def test_held_out_accuracy_and_defined_cases(spark):
    rows = labelled() + [(1000, None, "en", "s", 0), (1001, "", "de", "s", 0), (1002, "12 !? 34", "fr", "s", 0), (None, "the and ing tion", None, "s", 0), (1003, "sch ung " * 20_000, None, "s", 0)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    fold = {r["doc_id"]: r["h"] for r in docs.select("doc_id", cnn.held_out().alias("h")).collect()}
    assert all(h == (d is not None and zlib.crc32(str(d).encode()) % 4 == 2) for d, h in fold.items())
    model = cnn.fit(docs.where(~cnn.held_out()))
    got = {r["doc_id"]: r for r in cnn.predict(docs, model).collect()}
    assert len(got) == len(rows)
    test = [r for r in rows[:400] if fold[r[0]]]
    assert sum(got[r[0]]["lang_pred"] == r[2] for r in test) >= 0.95 * len(test) > 50
    assert [tuple(got[k])[1:] for k in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert got[1003]["lang_pred"] == "de" and got[None]["lang_pred"] == "en"
    assert all(0 <= g["score"] <= 1 for g in got.values())


def test_tables_give_the_convolution(spark):
    net = cnn.ByteCnn(["a", "b", "c"])
    x = np.random.default_rng(1).integers(0, 256, (9, cnn.WINDOW)).astype(np.uint8)
    logits, _, _ = net._forward(x)
    p = logits - np.log(np.exp(logits).sum(1, keepdims=True))
    assert np.allclose(net.log_probabilities(x), p, atol=1e-4)


def test_gradients_by_differences():
    net = cnn.ByteCnn(["a", "b"], seed=3)
    x, y = np.random.default_rng(2).integers(97, 110, (5, 20)).astype(np.uint8), np.array([0, 1, 0, 1, 1])
    for k in net.w:
        net.w[k] = net.w[k].astype(np.float64)
    loss = lambda: -np.mean([net._forward(x)[0][i, c] - np.log(np.exp(net._forward(x)[0][i]).sum()) for i, c in enumerate(y)])
    g = net._gradients(x, y)
    for k, at in (("out", (3, 1)), ("conv3", (5, 2)), ("bias2", (4,)), ("emb", (x[0, 3], 2))):
        old = net.w[k][at]
        net.w[k][at] = old + 1e-5
        up = loss()
        net.w[k][at] = old - 1e-5
        down = loss()
        net.w[k][at] = old
        assert abs((up - down) / 2e-5 - g[k][at]) < 1e-3, k


def test_windows_cover_whole_texts():
    data, offsets = text_bytes(pa.array(["a" * 300, None, "", "b" * cnn.WINDOW, "c"]))
    x, doc = cnn.windows(data, offsets)
    assert doc.tolist() == [0] * 3 + [3, 4]
    assert [(x[doc == i] != 32).sum() for i in (0, 3, 4)] == [300, cnn.WINDOW, 1]


def test_empty_table_clashing_columns_and_no_labels(spark):
    empty = spark.createDataFrame([], DOCS)
    assert cnn.fit(empty) is None and cnn.predict(empty, None).count() == 0
    d = spark.createDataFrame([(1, "the and of", None, "p", 2)], "doc_id long, text string, lang string, pick string, known int")
    assert cnn.fit(d) is None
    assert [tuple(r) for r in cnn.predict(d, None).collect()] == [(1, "und", 0.0)]


def test_a_language_of_copies_is_learned(spark):
    rows = [r for r in labelled(900) if r[2] != "fr"]
    text = "eau les que tre ment ai oi é " * 6
    rows += [(5000 + i, text, "fr", "s", 0) for i in range(4000)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    model = cnn.fit(docs)
    got = cnn.predict(spark.createDataFrame([(1, text, None, "s", 0), *[(10 + r[0], r[1], r[2], "s", 0) for r in rows[:60]]], DOCS), model).collect()
    assert [r["lang_pred"] for r in got if r["doc_id"] == 1] == ["fr"]
    want = {10 + r[0]: r[2] for r in rows[:60]}
    assert sum(want[r["doc_id"]] == r["lang_pred"] for r in got if r["doc_id"] != 1) >= 54


def test_more_languages_than_the_sample_s_share(spark, monkeypatch):
    monkeypatch.setattr(cnn, "SAMPLE", 60)
    rows = [(i, f"text {chr(97 + i % 80 // 8)}{i}", f"l{i % 80}", "s", 0) for i in range(320)]
    docs = spark.createDataFrame(rows, DOCS)
    assert {r["lang_pred"] for r in cnn.predict(docs, cnn.fit(docs)).collect()} <= {f"l{k}" for k in range(80)}
