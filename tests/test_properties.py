import random

import pandas as pd

from clipforge.operators.duplicates import keep_first
from clipforge.operators.entities import resolve_mentions
from tests.test_entities import directory, orgs


def test_keep_first_idempotent_and_minimal(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.choice("abc"), rnd.choice("xy"), rnd.random()) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, k1 string, k2 string, v double")
    once = keep_first(df, ["k1", "k2"], "id")
    twice = keep_first(once, ["k1", "k2"], "id")
    a = sorted(tuple(r) for r in once.collect())
    assert a == sorted(tuple(r) for r in twice.collect())
    p = pd.DataFrame(rows, columns=["id", "k1", "k2", "v"])
    want = p.loc[p.groupby(["k1", "k2"])["id"].idxmin()]
    assert a == sorted(tuple(x) for x in want[["id", "k1", "k2", "v"]].itertuples(index=False))


def test_resolved_and_unresolved_partition_mentions(spark):
    import datetime as dt
    ts = dt.datetime(2025, 3, 12, 8, 30)
    names = ["Dina Siegel", "dina siegel ", "Jan de Vries", "Piet Jansen", "Kees Bakker", "Nobody", "Johannes Vries"]
    m = spark.createDataFrame([(1, i, n, ts) for i, n in enumerate(names)],
                              "article_id long, mention_pos int, mention string, ts timestamp_ntz")
    kept, unresolved, _ = resolve_mentions(m, directory(spark), orgs(spark))
    k = {r.mention_pos for r in kept.collect()}
    u = {r.mention_pos for r in unresolved.collect()}
    assert not (k & u)
    dropped = set(range(len(names))) - k - u
    # only repeats of an already kept (employee id, affiliation set) may be dropped
    assert dropped == {1, 6}    # "dina siegel " repeats E1; "Johannes Vries" repeats E2 (same unit set)


def test_keep_first_with_nulls_and_ties(spark):
    rows = [("a", None, 1), ("a", 3, 2), ("a", 2, 3), ("b", None, 4), ("b", None, 5), (None, 1, 6), (None, 1, 7), ("c", 1, 8)]
    got = {r.k: (r.n, r.x) for r in keep_first(spark.createDataFrame(rows, "k string, n int, x int"), ["k"], "n").collect()}
    assert got["a"] == (2, 3) and got["b"][0] is None and got["b"][1] in (4, 5) and got[None][1] in (6, 7) and got["c"] == (1, 8) and len(got) == 4
