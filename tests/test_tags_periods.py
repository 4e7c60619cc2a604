import datetime as dt
import random

from clipforge.operators.entities import active_affiliations, indexed_periods
from clipforge.operators.lookups import table_tags


def test_table_tags_against_brute_force(spark):
    r = random.Random(3)
    voc = ["Geo", "Geology", "Faculteit", "xFaculteit", "van", "Bèta", "été", "a", "The", "the", "Utrechtse", "Utrecht"]
    texts = [None, "", "  ", *[r.choice([" ", "\n", "  "]).join(r.choice(voc) for _ in range(r.randrange(30))) for _ in range(60)], "van " * 20000 + "Faculteit Geo"]
    names = ["Geo", "Faculteit Geo", "Faculteit  Geo", "e", "the", " the", "Utrechtse", "trecht", "van van", "ult Geo", "Bèta\nété", "never seen", "eology Fac", "", " ", None, "Geo"]
    docs = spark.createDataFrame([*enumerate(texts), (None, "Geo"), (4, "Geo again")], "id long, t string")
    got = {(x["id"], x["name"]) for x in table_tags(docs, spark.createDataFrame([(n,) for n in names], "name string"), "id", "t").collect()}
    want = {(i, n) for i, t in [*enumerate(texts), (4, "Geo again")] for n in names if t is not None and n and n.strip() and n in t}
    assert got == want


def test_tokens_of_longer_names_meet_words_by_their_place(spark, monkeypatch):
    from clipforge.operators import lookups
    kept = {}
    real = lookups.written
    monkeypatch.setattr(lookups, "written", lambda df, name: kept.setdefault(name, real(df, name)))
    words = [f"x{k}a{k}x" for k in range(50)] + ["bx", "c", "xa"]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, "xa bx"), (3, "xa c bx"), (4, "a c  b")], "id long, t string")
    names = spark.createDataFrame([("a b",), ("a c b",)], "name string")
    assert {tuple(r) for r in table_tags(docs, names, "id", "t").collect()} == {(2, "a b"), (3, "a c b")}
    assert {r["word"] for r in kept["tag_found"].collect()} <= {"a", "xa", "b", "bx", "c"}


def test_table_tags_shuffles_no_words_of_texts_with_names_that_a_task_can_hold(spark, monkeypatch):
    from clipforge.operators import lookups
    r = random.Random(5)
    voc = ["de", "universiteit", "universiteiten", "niet-universitair", "hoogleraar", "x", "é", "één", "aan", "Utrecht", "van\u00a0de", "\u2003"]
    texts = [r.choice([" ", "\n", "\t", "  "]).join(r.choice(voc) for _ in range(r.randrange(40))) for _ in range(50)] + ["niet-universitaire", "\tde  x\n", " de", "x", ""]
    names = [*voc, "de universiteit", "universiteit de", "aan de", "aan  de", "aan\nde", "e u", "de ", " x", "x ", "één é x", "t universitair hoog", "universitair", "iversiteiten", "de\tde"]
    docs = spark.createDataFrame([(i % 50, t) for i, t in enumerate(texts)] + [(1, texts[1]), (None, "de")], "id int, t string")
    frame = spark.createDataFrame([(n,) for n in names], "name string")
    want = sorted({(i % 50, n) for i, t in enumerate(texts) for n in names if n.strip(" \t\r\n") and n in t})
    for most, routes in [(1 << 20, {"tag_names", "tag_found", "tag_hits"}), (0, {"tag_names", "tag_words", "tag_anchors", "tag_found", "tag_candidates"})]:
        kept = []
        real = lookups.written
        with monkeypatch.context() as m:
            m.setattr(lookups, "DICTIONARY_BYTES", most)
            m.setattr(lookups, "written", lambda df, name, kept=kept, real=real: (kept.append(name), real(df, name))[1])
            got = lookups.table_tags(docs, frame, "id", "t")
            assert sorted(tuple(x) for x in got.collect()) == want
        assert set(kept) == routes and got.dtypes == [("id", "int"), ("name", "string")]


def test_name_index_against_brute_force():
    from clipforge.operators.lookups import NameIndex
    r = random.Random(11)
    piece = lambda n: bytes(r.choice(b"aab\xc3 \n") for _ in range(r.randrange(n)))
    texts = [piece(60) for _ in range(300)]
    names = [(7 * i, x) for i, x in enumerate(sorted({piece(14) for _ in range(3000)})) if x.strip(b" \t\r\n")]
    at, nos = NameIndex(names).of_texts(texts)
    assert list(zip(at.tolist(), nos.tolist(), strict=True)) == [(i, no) for i, t in enumerate(texts) for no, x in names if x in t]


def test_no_names_no_tags(spark):
    docs = spark.createDataFrame([(1, "a b")], "id long, t string")
    assert table_tags(docs, spark.createDataFrame([], "name string"), "id", "t").count() == 0


def _day(n):
    return dt.datetime(1990, 1, 1) + dt.timedelta(days=n)


def test_person_with_many_periods(spark):
    r = random.Random(7)
    assocs, probes = [], []
    for k in range(400):  # one person with nearly all periods, few of which hold a day
        start = r.randrange(3000)
        end = dt.datetime(9999, 12, 31) if k % 50 == 0 else _day(start + r.randrange(-2, 25))
        assocs.append(("hot" if k % 20 else f"p{k}", k, _day(start), end, False))
    assocs += [("hot", 900, None, None, True), ("p0", 901, _day(5), None, True)]
    for i in range(300):
        probes.append((i, r.choice(["hot", "p0", "p20", "p40", "none", None]), r.choice([None, *[_day(r.randrange(3100)) + dt.timedelta(hours=r.randrange(24))] * 9])))
    a = spark.createDataFrame(assocs, "uuid string, no int, start_ts timestamp, end_ts timestamp, malformed boolean")
    p = spark.createDataFrame(probes, "id int, person string, ts timestamp")
    got = sorted((x["id"], x["no"]) for x in active_affiliations(p, a, "person", "ts").collect())
    want = sorted((i, no) for i, who, ts in probes for person, no, s, e, bad in assocs
                  if who == person and (bad or (ts is not None and s <= ts <= e)))
    assert got == want


def test_index_makes_only_pairs_of_the_same_day(spark):
    r = random.Random(9)
    periods = [("x", k, _day(s := r.randrange(2000)), _day(s + r.choice([0, 1, 2, 63, 64, 65, 1000]))) for k in range(300)]
    days = [r.randrange(2100) for _ in range(80)]
    a = spark.createDataFrame(periods, "_person string, no int, start_ts timestamp, end_ts timestamp")
    p = spark.createDataFrame([(i, "x", _day(d)) for i, d in enumerate(days)], "id int, person string, ts timestamp")
    got = sorted((x["id"], x["no"]) for x in indexed_periods(p, a, "person", "ts").collect())
    assert got == sorted((i, no) for i, d in enumerate(days) for _, no, s, e in periods if s <= _day(d) <= e)
