import random

from clipforge.operators.blocklists import comma_list, drop_blocked_sources, drop_blocked_titles, read_list


def test_titles_with_a_listed_word_go(spark):
    titles = spark.createDataFrame([(1, "call for papers now"), (2, "Call For Papers"), (3, "plain news"),
                                    (4, "paperswithcode"), (5, ""), (6, None)], "id long, title string")
    words = spark.createDataFrame([("papers",), ("call",), ("x y",), ("",), (None,)], "word string")
    assert {r.id for r in drop_blocked_titles(titles, words, "title", "id").collect()} == {2, 3, 5, 6}


def test_titles_equal_brute_force(spark):
    r = random.Random(1)
    text = lambda n: "".join(r.choice("abé🙂 ") for _ in range(n))
    titles = [(i, text(r.randrange(40))) for i in range(300)]
    words = [text(n) for n in (3, 4, 5, 6, 7, 8, 9, 10, 12, 15) for _ in range(40)] + [titles[5][1], titles[9][1] + "x"]
    want = {i for i, t in titles if not any(w and w in t for w in words)}
    got = drop_blocked_titles(spark.createDataFrame(titles, "id long, title string"),
                              spark.createDataFrame([(w,) for w in words], "word string"), "title", "id")
    assert {x.id for x in got.collect()} == want


def test_sources(spark):
    df = spark.createDataFrame([(1, "fd.nl"), (2, "FD.nl"), (3, None)], "id long, source string")
    bl = spark.createDataFrame([("fd.nl",), (None,)], "source string")
    assert {r.id for r in drop_blocked_sources(df, bl).collect()} == {2, 3}


def test_list_readers(spark, tmp_path):
    (tmp_path / "w.csv").write_text("Word,other\n papers ,1\n,2\ncall,3\npapers,4\n\"  \",5\n")
    assert sorted(r.word for r in read_list(spark, str(tmp_path / "w.csv"), "Word").collect()) == ["call", "papers"]
    spark.createDataFrame([("fd.nl ",), (None,)], "source string").write.parquet(str(tmp_path / "s.parquet"))
    assert [r.source for r in read_list(spark, str(tmp_path / "s.parquet"), "source", "source").collect()] == ["fd.nl"]
    assert read_list(spark, str(tmp_path / "none.csv"), "Word").count() == 0
    assert comma_list(" a, b c ,,") == ["a", "b c"] and comma_list(None) == []
