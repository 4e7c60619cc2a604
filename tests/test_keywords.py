import random

from clipforge.operators.keywords import keyword_candidates, top_keywords


def lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def greedy(cands, k=5, lim=0.5):
    kept = []
    for score, p in sorted(cands):
        if len(kept) < k and all(1 - lev(q, p) / max(len(q), len(p)) <= lim for q in kept):
            kept.append(p)
    return kept


def test_greedy_matches_brute_force(spark):
    rnd = random.Random(3)
    rows = []
    for d in range(20):
        for _ in range(rnd.randint(1, 12)):
            p = " ".join("".join(rnd.choice("abc") for _ in range(rnd.randint(2, 5))) for _ in range(rnd.randint(1, 3)))
            rows.append((d, p, rnd.random()))
    df = spark.createDataFrame(rows, "doc long, phrase string, score double").dropDuplicates(["doc", "phrase"])
    got = {r.doc: r.keywords for r in top_keywords(df, "doc").collect()}
    by_doc = {}
    for r in df.collect():
        by_doc.setdefault(r.doc, []).append((round(r.score, 12), r.phrase))
    assert got == {d: greedy(c) for d, c in by_doc.items()}


def test_candidates(spark):
    docs = spark.createDataFrame([(1, "Spark joins data. The Spark team ships NASA data!")], "id long, t string")
    stop = spark.createDataFrame([("the",)], "word string")
    c = {r.phrase: r.score for r in keyword_candidates(docs, "id", "t", stop).collect()}
    assert "spark" in c and "nasa data" in c and "the spark" not in c and "data the" not in c
    assert "data spark" not in c                     # crosses a sentence end
    kw = top_keywords(keyword_candidates(docs, "id", "t", stop), "id").first().keywords
    assert 1 <= len(kw) <= 5
