import re
import time

from clipforge.llm import licenses
from tests.llm.data import DOCS, corpus, frame

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    at, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        found = [i for i in range(len(w)) if w[i:i + len(p)] == p]
        at += found
        labels |= {label} if found else set()
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_base_equals_brute_force(spark):
    odd = ["CC BY cc-by ccé by cc by", "All rights reserved. all RIGHTS reserved", "GNU General\nPublic License, cc\tby", "a\x00b{c}d`e_f", "É cc by É"]
    rows = corpus() + [(900 + i, t, "en", "s", 0) for i, t in enumerate(odd)] + [(None, "cc by", "en", "s", 0), (950, "word " * 40_000 + "cc by", "en", "s", 0)]
    got = {r["doc_id"]: r for r in licenses.scan(frame(spark, rows)).collect()}
    for doc, text, *_ in rows:
        g = got[doc]
        assert (g["n_words"], g["n_base"], g["first_word"], g["last_word"], g["base_labels"]) == base(text), text
        assert set(g["base_labels"].split(",")) <= set(g["labels"].split(",")) and 0 <= g["score"] <= 1


def test_templates_are_found_in_place_and_only_there(spark):
    texts = ["intro\nLicensed under the Apache License, Version 2.0. more", "Released under the MIT License.", "the license of mit is the version 2 of apache",
             "Licensed under CC BY-NC 4.0.", "Licensed, under that Apache License; Version 2.0", "permission is hereby granted, free of charge, to every person obtaining a copy of this software",
             "permission is hereby granted with a charge to any person obtaining a copy of this software"]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.scan(frame(spark, rows)).collect()}
    assert [got[i][0] for i in range(7)] == ["apache-2.0", "mit", "", "cc-by,cc-by-nc", "apache-2.0", "mit", ""]
    assert got[0][1] == 1.0 and 0.6 <= got[4][1] < 1 and got[2][1] == 0


def test_empty_table_and_clashing_columns(spark):
    assert licenses.scan(spark.createDataFrame([], DOCS)).count() == 0
    d = spark.createDataFrame([(1, "cc by", 7, "b")], "doc_id long, text string, n_words int, word string")
    assert [r["n_base"] for r in licenses.scan(d).collect()] == [1]


def test_a_text_of_repeated_notices_takes_linear_time(spark):
    label, notice, _ = licenses.TEMPLATES[0]
    docs = spark.createDataFrame([(1, (notice + " . ") * 20_000, "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    start = time.time()
    got = licenses.scan(docs).first()
    assert label in got["labels"].split(",") and got["score"] == 1.0 and time.time() - start < 60
