import numpy as np
import pytest

from clipforge.llm import jaccard_join, minhash_forest
from tests.llm.data import DOCS, corpus, frame
from tests.llm.test_jaccard_join import brute, near_copies


def _got(df):
    return sorted(repr(tuple(r)[:3]) for r in df.collect())


@pytest.mark.parametrize("percent", [85, 80])
def test_equals_brute_force(spark, percent):
    rows = corpus() + near_copies() + [(None, "a b", "en", "s", 0), (None, "lonely one here", "en", "s", 0)]
    got = minhash_forest.near_duplicates(frame(spark, rows), percent=percent)
    assert _got(got) == sorted(map(repr, brute(rows, percent)))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got.collect())


def test_crowded_regions_of_several_components(spark):
    # Two large groups whose members differ by one word each, and a third that links to nothing.
    base = [[f"{c}{i}" if i > 60 else f"w{i}" for i in range(160)] for c in "pq"]
    rows = []
    for i in range(120):
        w = list(base[i % 2])
        w[i % 50] = f"own{i}"
        rows.append((i, " ".join(w), "en", "s", 0))
    got = minhash_forest.near_duplicates(frame(spark, rows))
    assert _got(got) == sorted(map(repr, brute(rows, 85)))


def test_signatures_estimate_similarity():
    r = np.random.default_rng(1)
    x = r.integers(0, 1 << 63, 4000, dtype=np.uint64)
    sig = minhash_forest.signatures([np.sort(x[:3000]), np.sort(x[500:3500])])
    assert abs((sig[0] == sig[1]).mean() - 2500 / 3500) < 0.12


def test_texts_that_share_linear_hashes_stay_apart(spark):
    # Thue-Morse words agree under every polynomial hash modulo a power of two.
    a = "a"
    while len(a) < 1024:
        a += "".join("b" if c == "a" else "a" for c in a)
    rows = [(1, a, "en", "s", 0), (2, "".join("b" if c == "a" else "a" for c in a), "en", "s", 0), (3, a, "en", "s", 0)]
    for find in (minhash_forest.near_duplicates, jaccard_join.jaccard_classes):
        got = {r["doc_id"]: (r["component_id"], r["class_id"]) for r in find(frame(spark, rows)).collect()}
        assert got[1] == got[3] and got[2][0] == 2 and got[1][1] != got[2][1]


def test_odd_tables(spark):
    assert minhash_forest.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0
    d = spark.createDataFrame([(1, None, 7, "b", 0), (2, "", 7, "b", 0), (3, "x " * 50000, 1, "", 1), (4, "x " * 60000, 1, "", 1)],
                              "doc_id long, text string, uid int, n string, bits0 int")
    got = sorted(tuple(r)[:4] for r in minhash_forest.near_duplicates(d).collect())
    assert got == [(1, 0, 1, True), (2, 0, 2, True), (3, 1, 3, True), (4, 1, 3, False)]
