import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from clipforge.llm import merkle
from tests.llm.data import DOCS

def tampered():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, lower=False):
    doc_id, text, lang, source, n_chars = row
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def way(levels, at):
    out = []
    for level in levels[:-1]:
        run = at - at % 16
        out.append(("".join(level[run:at]), "".join(level[at + 1:run + 16])))
        at //= 16
    return out


def brute(rows):
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    of = {s: sorted((r for r in rows if r[3] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in sources}
    trees = {s: tree([leaf(r) for r in of[s]]) for s in sources}
    top = tree([trees[s][-1][0] for s in sources])
    root = top[-1][0] if rows else None
    out = []
    for k, s in enumerate(sources):
        for i, r in enumerate(of[s]):
            path = way(trees[s], i) + way(top, k)
            lower = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            node = leaf(r, lower)
            for before, after in path:
                node = h(before, node, after)
            out.append((r[0], leaf(r), trees[s][-1][0], root, h(*(b + a for b, a in path)), node, node == root))
    return sorted(map(repr, out))


def _rows(n, sources, seed=4):
    r = random.Random(seed)
    word = lambda: r.choice(["Abc", "été", "DEF", "x", "\U0001f600", ""])
    return [(i, r.choice([None, "", " ".join(word() for _ in range(r.randrange(6)))]), r.choice(["en", None]), r.choice(sources), r.choice([None, i])) for i in range(n)]


@pytest.mark.parametrize(("n", "sources"), [(0, ["a"]), (1, ["a"]), (16, ["a"]), (17, [None]), (300, [None, "", "b", "B", "é", "z"]), (60, [f"s{i}" for i in range(40)])])
def test_equals_brute_force(spark, n, sources):
    rows = _rows(n, sources)
    got = merkle.manifest(spark.createDataFrame(rows, DOCS).repartition(3), tampered())
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute(rows)


def test_several_block_levels(spark):
    # More leaves of a source than a block holds: its paths go through two tables.
    rows = _rows(5000, ["hot", "hot", "hot", "cold"])
    got = merkle.manifest(spark.createDataFrame(rows, DOCS).repartition(3), tampered())
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute(rows)


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    rows = [(None, "A", None, "s", 1)] * 2 + [(7, "A", "en", "s", 1)] * 20 + [(7, "B", "en", "s", 1)] * 3 + [(8, "A" * 100_000, "en", "s", 1)]
    d = spark.createDataFrame(rows, DOCS)
    d = d.select("*", *[F.lit("x").alias(c) for c in ("tree", "pos", "hash", "_source", "total", "block", "changed")])
    got = merkle.manifest(d.repartition(3), tampered())
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute(rows)
