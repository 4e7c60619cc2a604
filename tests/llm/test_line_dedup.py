import collections

from clipforge.llm import line_dedup
from tests.llm.data import DOCS


def brute(rows, ratio, z):
    total, n = collections.Counter(), collections.Counter()
    for _, t, _, host, _ in rows:
        if host is not None:
            total[host] += 1
            n.update({(host, x) for x in (t or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")} if t is not None else ())
    bad = {k for k, c in n.items() if c > 1 and c > ratio * total[k[0]] and (c - ratio * total[k[0]]) ** 2 > z * z * ratio * (1 - ratio) * total[k[0]]}
    for doc, t, _, host, _ in rows:
        lines = [] if t is None else t.split("\n")
        kept = [x for x in lines if (host, x) not in bad]
        yield doc, None if t is None else "\n".join(kept), len(lines), len(lines) - len(kept)


def test_equals_brute_force(spark):
    rows = [(i, "\n".join(["menu", f"own {i}", "", f"h{i % 3}", "menu"][: 1 + i % 5]), "en", ["a", "b", "c", None][i % 4], 0) for i in range(80)]
    rows += [(200, None, "en", "a", 0), (201, "", "en", "a", 0), (202, "menu", "en", "b", 0), (202, "menu", "en", "b", 0), (None, "\n\nmenu\n", "en", "c", 0),
             (203, "menu", "en", "rare", 0), (204, "long " * 50_000, "en", "a", 0)]
    got = line_dedup.drop_boilerplate(spark.createDataFrame(rows, DOCS).repartition(5), ratio=0.3, significance=1.0)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_lines", "n_dropped"]
    got = [(r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute(rows, 0.3, 1.0)))
    assert (202, "", 1, 1) in got and (203, "menu", 1, 0) in got


def test_small_hosts(spark):
    rows = [(i, f"menu\nown {i}\n" + ("twice" if i < 2 else ""), "en", "four", 0) for i in range(4)]
    rows += [(100 + i, "seldom" if i < 2 else f"own {i}", "en", "fifty", 0) for i in range(50)]
    got = {r["doc_id"]: r["text"] for r in line_dedup.drop_boilerplate(spark.createDataFrame(rows, DOCS)).collect()}
    assert [got[i].split("\n")[0] for i in range(4)] == [f"own {i}" for i in range(4)]
    assert "twice" not in got[0] and got[100] == "seldom" and got[149] == "own 49"


def test_helper_names_of_the_input(spark):
    rows = [(i, f"top\nx{i}", "h", "p", "q", "r", "s") for i in range(6)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, _host string, _drop string, _kept string, _KEPT_ string")
    got = line_dedup.drop_boilerplate(d).collect()
    assert sorted(tuple(r)[1:7] for r in got) == [(f"x{i}", "h", "p", "q", "r", "s") for i in range(6)]


def test_large_sides_join_without_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "broadcast_if_small", lambda df, n: df)
    rows = [(i, f"top\nx{i}", "en", f"h{i % 2}", 0) for i in range(40)]
    got = line_dedup.drop_boilerplate(spark.createDataFrame(rows, DOCS), ratio=0.5).collect()
    assert all(r["text"] == f"x{r['doc_id']}" and r["n_dropped"] == 1 for r in got) and len(got) == 40


def test_empty_table_and_clashing_columns(spark):
    assert line_dedup.drop_boilerplate(spark.createDataFrame([], DOCS)).count() == 0
    d = spark.createDataFrame([(1, "x\ny", "h", 5, "k")], "doc_id long, text string, source string, n_lines int, line_hash string")
    assert [(r["n_lines"], r["line_hash"]) for r in line_dedup.drop_boilerplate(d).collect()] == [(2, "k")]
