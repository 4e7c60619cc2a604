import random

import corpus_pipeline
from clipforge.llm import decontaminate, line_dedup, packing, quality_rules
from tests.llm.data import DOCS
from tests.llm.test_jaccard_join import brute as components
from tests.llm.test_line_dedup import brute as without_boilerplate


def rows():
    r = random.Random(8)
    voc = ["the", "of", "and", "to", "in", "is"] * 40 + ["w" + "".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(400)]
    text = lambda n: " ".join(r.choice(voc) for _ in range(n))
    out = []
    for i in range(60):
        t = "top menu of the site\n" + text(120)
        if i % 10 == 3:
            t = out[-1][1].replace(" is ", " was ", 1)
        if i % 10 == 7:
            t = out[2][1]
        if i % 15 == 4:
            t = " ".join(f"{w}***" for w in t.split())
        if i % 20 == 5:
            t += " What colour has the sky above the old harbour of Rotterdam at 6 in the morning? "
        out.append((i, t, "en", "a" if i % 3 else "b", len(t)))
    return out + [(100, None, "en", "a", 0), (101, "", None, None, 0), (102, "too short", "en", "a", 9), out[0], (None, text(200), "en", "a", 1)]


def test_stages_equal_brute_force_and_compose(spark, tmp_path):
    bench = [(1, "What colour has the sky above the old harbour of Leiden at 8 in the morning?"), (2, "unseen item of some eight words or more here")]
    spark.createDataFrame(rows(), DOCS).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "jaccard_join", "decontamination", "packing"]
    at, now = {}, spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [tuple(x) for x in now.collect()]
        now = stage(spark, now, str(tmp_path))
        assert now.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        now.write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        at[name] = (before, [tuple(x) for x in now.collect()])
    key = lambda xs: sorted(map(repr, xs))

    before, after = at["quality_rules"]
    kept = {x["doc_id"]: x["kept"] for x in quality_rules.judge(spark.createDataFrame(before, DOCS)).collect()}
    assert key(after) == key(x for x in before if kept[x[0]])
    assert not {4, 19, 34, 49, 100, 101, 102} & {x[0] for x in after} and len(after) == 62 - 4

    before, after = at["line_dedup"]
    want = list(without_boilerplate(before, line_dedup.RATIO, line_dedup.SIGNIFICANCE))
    assert key((d, t) for d, t, *_ in want) == key((x[0], x[1]) for x in after)
    assert all(x[4] == len(x[1]) and "top menu" not in x[1] for x in after if x[0] is not None)

    before, after = at["jaccard_join"]
    groups = {}
    for row, (_, _, least) in zip(before, components(before, 90), strict=True):
        groups.setdefault(least, row)
    assert sorted(map(str, (x[0] for x in after))) == sorted(map(str, groups))

    before, after = at["decontamination"]
    leaking = {x["doc_id"] for x in decontaminate.leaks(spark.createDataFrame(before, DOCS), spark.createDataFrame(bench, "item_id long, text string")).collect()}
    assert leaking and all("Rotterdam" in x[1] for x in before if x[0] in leaking)
    assert key(after) == key(x for x in before if x[0] not in leaking) and not any("Rotterdam" in x[1] for x in after)

    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    encode = packing.encoder(packing.default_tokenizer()).encode_ordinary
    assert sorted(map(str, {x["doc_id"] for x in got})) == sorted(map(str, (x[0] for x in after)))
    assert sum(x["length"] for x in got) == sum(len(encode(x[1])) + 1 for x in after)


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_copies_equal_brute_force_on_five_words_at_80_percent(spark):
    r = random.Random(11)
    base = [f"w{r.randrange(5000)}" for _ in range(200)]
    texts = [" ".join(base)]
    for edits in (2, 4, 6, 20):  # at 4 edits: 5-word Jaccard 0.81, 3-word 0.89
        w = [f"{edits}x{r.randrange(5000)}" for _ in range(200)]
        texts += [" ".join(w), " ".join(f"e{i}" if i % (200 // edits) == 10 else x for i, x in enumerate(w))]
    # A run of new words breaks fewer shingles than as many single ones.
    texts += [" ".join(base[:150]), " ".join([*base[:150], *("new%d" % i for i in range(30))]), "a b c d e", "a b c d", "A b  c d e"]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]

    def shingles(t):
        w = t.lower().split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}

    sets, group = [shingles(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    got = corpus_pipeline.near_copies(spark, spark.createDataFrame(rows, DOCS).repartition(3), "").collect()
    assert sorted(x["doc_id"] for x in got) == sorted(set(group))
    three = [x[2] for x in components(rows, 90)]
    assert len(set(group)) < len(set(three))
