import random
import re

from clipforge.llm import quality_rules as q
from tests.llm.data import DOCS, corpus, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    w = WORD.findall(text or "")
    seen = {}
    for i in range(len(w) - 4):
        seen.setdefault(tuple(w[i:i + 5]), []).append(i)
    covered = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), failed


def test_base_counts_equal_brute_force(spark):
    rows = corpus() + [(900 + i, t, "en", "s", 0) for i, t in enumerate([
        "a b c d e f a b c d e f a b c d e", "x\ny\nx\n \n \nx", "#*$ %&| <> 🙂 ñ", "one two three four five " * 9 + "z", "\r\na\x0bb\x0cc "])]
    got = {r["doc_id"]: r for r in q.judge(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    for doc, text, *_ in rows:
        g = got[doc]
        assert (g["n_words"], g["word_chars"], g["n_symbols"], g["n_dup_lines"], g["n_repeat_words"], g["base_failed"]) == base(text), text
        assert not (g["base_failed"] and g["kept"])


def test_divergent_documents_go_and_clean_ones_stay(spark):
    r = random.Random(4)
    voc = ["the", "of", "and", "to", "in", "is"] * 40 + ["w" + "".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(400)]
    clean = [" ".join(r.choice(voc) for _ in range(120)).capitalize() + "." for _ in range(60)]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(clean)]
    rows += [(100, " ".join(x + "***" for x in clean[0].split()), "en", "s", 0),
             (101, " ".join(f"q{i}zz" for i in range(120)), "en", "s", 0),
             (102, clean[1], None, "s", 0), (103, " ".join(f"q{i}" for i in range(20)), "en", "s", 0)]
    kept = {x["doc_id"]: x["kept"] for x in q.judge(frame(spark, rows)).collect()}
    assert not kept.pop(100) and not kept.pop(101)
    assert all(kept.values())  # null language: compared with all; under the minimum length: not judged


def test_empty_table_and_clashing_columns(spark):
    assert q.judge(spark.createDataFrame([], DOCS)).count() == 0
    d = spark.createDataFrame([(1, None, None, 5, "x"), (2, "a " * 60, "en", 5, "x")], "doc_id long, text string, lang string, n_words int, word string")
    assert [(x["doc_id"], x["n_words"], x["kept"]) for x in q.judge(d).orderBy("doc_id").collect()] == [(1, 0, False), (2, 60, False)]
