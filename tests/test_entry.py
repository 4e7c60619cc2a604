import __spark_entry__ as E


def test_entry_and_registry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 40


def test_small_queries_run(spark):
    qs = E.queries()
    for name in ["status_counts", "dedup_first", "org_lookup", "subsume_partials", "unit_closure"]:
        assert qs[name](spark, "/root/testdata/sf0.001").count() >= 0
