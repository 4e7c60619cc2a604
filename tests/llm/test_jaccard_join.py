import re

import pytest

from clipforge.llm import jaccard_join
from clipforge.llm.components import components
from tests.llm.data import DOCS, corpus, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set())


def brute(rows, percent):
    sets = [shingle_set(r[1]) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    least = {g: min((rows[i][0] for i in range(len(rows)) if group[i] == g and rows[i][0] is not None), default=None) for g in set(group)}
    return [(r[0], len(s), least[g]) for r, s, g in zip(rows, sets, group, strict=True)]


def near_copies(n=80):
    """A group of different texts, each a few edits from one of two bases; many pairs near the threshold."""
    import random
    r = random.Random(5)
    base = [[f"w{r.randrange(900)}" for _ in range(120)] for _ in range(2)]
    out = []
    for i in range(n):
        w = list(base[i % 2])
        for _ in range(r.randrange(6)):
            w[r.randrange(len(w))] = f"e{r.randrange(9)}"
        out.append((500 + i, " ".join(w), "en", "s", 0))
    return out


@pytest.mark.parametrize("percent", [90, 80])
def test_equals_brute_force(spark, percent):
    rows = corpus() + near_copies() + [(None, "a b", "en", "s", 0), (None, "lonely one here", "en", "s", 0)]
    got = jaccard_join.jaccard_classes(frame(spark, rows), percent=percent).collect()
    assert sorted(map(repr, (tuple(g)[:3] for g in got))) == sorted(map(repr, brute(rows, percent)))


@pytest.mark.parametrize("tile", [7, 256])
def test_every_link_is_counted(spark, monkeypatch, tile):
    from clipforge.llm import shingles
    monkeypatch.setattr(shingles, "TILE_SETS", tile)
    w = [f"w{i}" for i in range(200)]
    rows = near_copies() + [(i, " ".join([f"x{k}" if k < 3 * i else v for k, v in enumerate(w)]), "en", "s", 0) for i in range(12)]
    rows += [(900 + i, " ".join(f"{'y' if k == i else 'z'}{k}" for k in range(90)), "en", "s", 0) for i in range(2)]
    sets = {r[0]: frozenset(shingle_set(r[1])) for r in rows}
    linked = {s: sum(s != t and 100 * len(s & t) >= 90 * len(s | t) for t in set(sets.values())) for s in sets.values()}
    got = {r["doc_id"]: r["n_links"] for r in jaccard_join.jaccard_classes(frame(spark, rows)).collect()}
    assert got == {i: linked[s] for i, s in sets.items()}
    assert max(linked.values()) > tile or tile > 7


def test_chain_of_links_is_one_component(spark):
    w = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([f"x{k}" if k < 3 * i else v for k, v in enumerate(w)]), "en", "s", 0) for i in range(12)]
    got = jaccard_join.jaccard_classes(frame(spark, rows)).collect()
    assert sorted(map(repr, (tuple(g)[:3] for g in got))) == sorted(map(repr, brute(rows, 90)))


def test_empty_tables_and_clashing_columns(spark):
    assert jaccard_join.jaccard_classes(spark.createDataFrame([], DOCS)).count() == 0
    d = spark.createDataFrame([(1, None, 7, "b"), (2, "", 7, "b")], "doc_id long, text string, uid int, n string")
    assert sorted(tuple(r)[:3] for r in jaccard_join.jaccard_classes(d).collect()) == [(1, 0, 1), (2, 0, 2)]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, k) for k in range(20, 40)] + [(3, 3)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 100 for k in range(100, 161)}, **{k: 7 for k in [7, *range(20, 40)]}, 3: 3}
