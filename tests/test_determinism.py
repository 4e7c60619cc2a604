from collections import Counter

import __spark_entry__ as E

NAMES = ["unit_queries", "fuzzy_match", "resolve_entities", "dedup_first", "xml_records", "mention_cleanup",
         "language_id", "keywords_topk"]


def rows(df):
    cols = sorted(df.columns)
    return Counter(tuple(r[c] for c in cols) for r in df.collect())


def test_same_results_at_1_and_8_partitions(spark):
    q = E.queries()
    d = "/root/testdata/sf0.001"
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        out = {}
        for parts in ("1", "8"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            out[parts] = {n: rows(q[n](spark, d)) for n in NAMES}
        for n in NAMES:
            assert out["1"][n] == out["8"][n], n
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
