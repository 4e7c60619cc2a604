import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from clipforge.llm import source_audit
from tests.llm.data import DOCS

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least, top=10):
    docs = [(r[2] or "", r[3] or "", TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in r[1] or ""))) for r in rows]
    held = defaultdict(Counter)
    for lang, _, terms in docs:
        held[lang].update(set(terms))
    kept = {lang: sorted(t for t, n in c.items() if n >= least) for lang, c in held.items()}
    count = defaultdict(Counter)
    for lang, source, terms in docs:
        for key in ((lang, source), lang):
            count[key].update(t for t in terms if t in set(kept[lang]))

    def p(key, lang, t):
        return 1 + 10 ** 9 * (count[key][t] + 2) // (sum(count[key].values()) + 2 * len(kept[lang]))

    f = lambda a, b: (a - b) ** 2 // (a + b)
    out = []
    groups = {(lang, source) for lang, source, _ in docs}
    for lang, source in groups:
        pair = [(sum(f(p((lang, source), lang, t), p((lang, o), lang, t)) for t in kept[lang]), o) for l2, o in groups if l2 == lang and o != source]
        term = [(f(p((lang, source), lang, t), p(lang, lang, t)), t) for t in kept[lang]
                if count[lang, source][t] and p((lang, source), lang, t) > p(lang, lang, t)]
        for part, rows_, limit in (("pair", pair, None), ("term", term, top)):
            ranked = sorted(rows_, key=lambda x: (-x[0], x[1].encode()))[:limit]
            out += [(lang, source, part, item, value, k + 1) for k, (value, item) in enumerate(ranked)]
    return sorted(out)


def _rows(n=160):
    r = random.Random(8)
    voc = {s: [r.choice(["Der", "the", "été", "été2x", "ß", "_a-b", "Zz"]) + r.choice("abcdefghij") * r.randrange(3) for _ in range(40)] for s in ("p", "q", "r", None)}
    out = []
    for i in range(n):
        s = r.choice(list(voc))
        out.append((i, r.choice([None, "", " ".join(r.choice(voc[s]) for _ in range(r.randrange(40)))]), r.choice(["en", "de", None]), s, 0))
    return [*out, (900, None, "xx", "alone", 0), (901, "12 34 !", "yy", "a", 0), (902, None, "yy", "b", 0)]


def test_equals_brute_force(spark):
    rows = _rows()
    for least in (10, 3):
        got = source_audit.divergences(spark.createDataFrame(rows, DOCS).repartition(3), min_documents=least)
        assert sorted(map(tuple, got.collect())) == brute(rows, least)


def test_ties_repeated_rows_and_clashing_columns(spark):
    rows = [(1, "b a B A", "en", "s", 0)] * 12 + [(2, "c d " * 5000, "en", "t", 0)] * 10
    d = spark.createDataFrame(rows, DOCS).select("*", *[F.lit(5).alias(c) for c in ("term", "n", "docs", "v", "mass", "id", "rank")])
    got = sorted(map(tuple, source_audit.divergences(d).collect()))
    assert got == brute(rows, 10)
    assert [r[3] for r in got if r[:3] == ("en", "s", "term")] == ["a", "b"]


def test_empty_table(spark):
    assert source_audit.divergences(spark.createDataFrame([], DOCS)).count() == 0


def test_shares_are_exact_beyond_64_bit_products(spark):
    counts = [0, 1, 7 * 10 ** 11 + 3, 9 * 10 ** 14]
    total = 10 ** 15 + 37
    want = [1 + 10 ** 9 * (c + 2) // total for c in counts]
    assert source_audit._shares(np.array(counts, np.int64), total).tolist() == want
    d = spark.createDataFrame([(c,) for c in counts], "c long")
    assert sorted(r[0] for r in d.select(source_audit.share(F.col("c") + 2, F.lit(total))).collect()) == want


def test_merge_over_several_runs(spark, monkeypatch):
    monkeypatch.setattr(source_audit, "BLOCK", 4)
    rows = _rows()
    got = source_audit.divergences(spark.createDataFrame(rows, DOCS).repartition(3), min_documents=2)
    assert sorted(map(tuple, got.collect())) == brute(rows, 2)
