import random

from clipforge.llm import decontaminate as d
from tests.llm.data import DOCS

ITEMS = [
    (1, "A train leaves Boston at 9 and travels 120 miles in 3 hours, then Maria drives 40 km home. How fast does the train go over the whole way?"),
    (2, "The quick brown fox jumps over the lazy dog near the old river bank while birds sing."),
    (3, "What is two plus two?"),
    (4, "Tiny one."),
    (5, None),
    (6, "If Anna has 12 apples and gives 5 to Ben, then buys 12 more, how many apples does Anna have now?"),
]


def bench(spark, items=ITEMS):
    return spark.createDataFrame(items, "item_id long, text string")


def filler(r, n):
    return " ".join("z" + "".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(n))


def test_reparameterised_questions_are_caught_and_clean_text_is_not(spark):
    r = random.Random(1)
    f = lambda n=30: filler(r, n)
    texts = {
        10: f() + " " + ITEMS[0][1] + " " + f(),
        11: f() + " " + ITEMS[0][1].replace("Boston", "Chicago").replace("120 miles", "345 km").replace("9", "7").replace("3 hours", "8 min").replace("40 km", "11 miles").replace("Maria", "Petra") + f(),
        12: f() + "\n" + ITEMS[1][1].upper() + "\n" + f(),
        13: f() + " what is two plus two? " + f(),
        14: f(200), 15: f() + " the quick brown fox " + f(), 16: "", 17: None,
        # Same template, but one value of the item (12, twice) stands for two values and two for one.
        18: f() + ". If Anna has 7 apples and gives 9 to Anna, then buys 9 more, how many apples does Karl have now? " + f(),
        19: f() + ". If Karl has 31 apples and gives 9 to Emma, then buys 31 more, how many apples does Karl have now? " + f(),
        20: " ".join(ITEMS[1][1].split()[:14]),
    }
    rows = [(k, v, "en", "s", 0) for k, v in texts.items()] + [(10, texts[10], "en", "s", 0), (None, texts[12], "en", "s", 0)]
    got = {(x["doc_id"], x["item_id"]) for x in d.leaks(spark.createDataFrame(rows, DOCS).repartition(3), bench(spark)).collect()}
    assert got == {(10, 1), (11, 1), (12, 2), (13, 3), (19, 6), (20, 2), (None, 2)}
    kept = d.drop_leaks(spark.createDataFrame(rows, DOCS), bench(spark))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(x["doc_id"] for x in kept.collect()) == [14, 15, 16, 17, 18]


def test_templates(spark):
    text = "In 2024 Rome has 3.5 km, 10% and New York 7 apples. The Sun-god's 12:30 train"
    row = spark.range(1).select(d.template(d.F.lit(text)).alias("t"), d.slots(d.F.lit(text)).alias("s")).first()
    assert row["t"] == "in ʘd ʘn has ʘd ʘu ʘd ʘu and ʘn ʘn ʘd apples the ʘn god s ʘd train".split()
    assert row["s"] == ["2024", "rome", "3.5", "km", "10", "%", "new", "york", "7", "sun", "12:30"]


def test_shuffled_join_and_empty_tables(spark, monkeypatch):
    docs = spark.createDataFrame([(1, ITEMS[1][1], "en", "s", 0), (2, "clean text only", "en", "s", 0)], DOCS)
    assert d.leaks(spark.createDataFrame([], DOCS), bench(spark)).count() == 0
    assert d.leaks(docs, bench(spark, [])).count() == 0
    monkeypatch.setattr(d, "broadcast_if_small", lambda df, n: df)
    assert [x["doc_id"] for x in d.leaks(docs.withColumn("item", d.F.lit("x")).withColumn("pos", d.F.lit(1)), bench(spark)).collect()] == [1]


def test_a_verbatim_copy_among_variants_is_caught(spark):
    r = random.Random(4)
    item = ITEMS[5][1]
    swapped = "If Ben has 5 apples and gives 12 to Anna, then buys 5 more, how many apples does Ben have now?"
    # No variant agrees with the item on its own: one value of the item (12, or Anna) stands for several.
    broken = lambda: f"If Karl has {r.randint(20, 40)} apples and gives 9 to Karl, then buys 9 more, how many apples does {r.choice(['Otto', 'Emma'])} have now?"
    texts = {
        1: f"{item} {broken()}", 2: " ".join([*(broken() for _ in range(20)), item, *(broken() for _ in range(30))]),
        3: f"{filler(r, 40)} {swapped} {filler(r, 9)} {item}", 4: broken(), 5: " ".join(broken() for _ in range(20)),
        # Words put in inside the copy move the rest of it.
        6: f"{broken()} {item.replace('then buys', 'then he later buys')} {broken()}",
        # Parts of one copy, far apart.
        7: f"{filler(r, 9)} {' '.join(ITEMS[0][1].split()[:10])} {filler(r, 90)} {' '.join(ITEMS[0][1].split()[10:21])} {filler(r, 9)}",
    }
    rows = [(k, v, "en", "s", 0) for k, v in texts.items()]
    got = {x["doc_id"]: x for x in d.leaks(spark.createDataFrame(rows, DOCS).repartition(3), bench(spark)).collect()}
    assert set(got) == {1, 2, 3, 6, 7} and all(x["item_id"] == (1 if k == 7 else 6) for k, x in got.items())
    assert got[2]["n_windows"] == got[2]["n_item_windows"] == 14 and got[2]["last_token"] - got[2]["first_token"] == 20


def test_placeholders_and_slots_come_from_one_pass(spark):
    texts = ["After 2 hours Tom has 5 km to go", "He ran 3 km Anna 4km, Ben 10% Carl and 12:30 h Dora", "7 Tom5 in 5 m Paul's 3m2 McDonald", "a ʘ 3 kg Eve ʘn 2 min Otto\n6 s Ida", "<$1> ʘ<9 km Max \\ $2", "", None]
    rows = spark.createDataFrame([(x,) for x in texts], "x string").select("x", d.template(d.F.col("x")).alias("t"), d.slots(d.F.col("x")).alias("s")).collect()
    assert all(sum(w.startswith("ʘ") for w in x["t"]) == len(x["s"]) for x in rows)
    assert rows[0]["t"] == "after ʘd ʘu ʘn has ʘd ʘu to go".split() and rows[0]["s"] == ["2", "hours", "tom", "5", "km"]
    item = "After 2 hours Tom has run 5 km. How far is the way that Tom runs in 3 hours Tom style?"
    asked = item.replace("Tom", "Paula").replace("2", "4").replace("5 km", "9 km").replace("3", "8")
    docs = spark.createDataFrame([(1, filler(random.Random(2), 20) + " for 6 days Zoe. " + asked, "en", "s", 0)], DOCS)
    got = d.leaks(docs, bench(spark, [(1, item)])).collect()
    assert [x["n_windows"] for x in got] == [got[0]["n_item_windows"]] and got[0]["n_slots"] == 6


def test_short_items_are_matched_with_whole_documents(spark):
    items = [(1, "Name two primes"), (2, "Maria buys 3 pens"), (3, "Yes")]
    rows = [(10, "name two primes!", "en", "s", 0), (11, "Maria buys 7 pens.", "en", "s", 0), (12, "yes", "en", "s", 0),
            (13, "please name two primes", "en", "s", 0), (14, "yes or no", "en", "s", 0)]
    got = {(x["doc_id"], x["item_id"]) for x in d.leaks(spark.createDataFrame(rows, DOCS), bench(spark, items)).collect()}
    assert got == {(10, 1), (11, 2), (12, 3)}


def test_values_stand_at_their_placeholders(spark):
    r = random.Random(6)
    parts = ["In", " 3.5km", " 10%", " New", " York", ", Bob's", " 1,000.25", " a.b", " 12:30.", "5 %", " McDonald", " the", "\n", " 7/8", " ʘ", " x1 2y", " 3 days"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(25))) for _ in range(300)]
    for row in spark.createDataFrame([(t,) for t in texts], "t string").select(d.template(d.F.col("t")).alias("a"), d.template(d.F.col("t"), True).alias("b")).collect():
        assert len(row["a"]) == len(row["b"])
        assert all(x == y if not x.startswith("ʘ") else y.startswith(x[:2]) for x, y in zip(row["a"], row["b"], strict=True))


def test_a_long_text_with_an_item_takes_linear_time(spark):
    r = random.Random(2)
    text = " ".join(f"In {i} Tom has {i % 7} km" for i in range(40_000)) + " " + ITEMS[0][1]
    rows = [(1, text, "en", "s", 0), (2, filler(r, 100), "en", "s", 0)]
    assert [x["doc_id"] for x in d.leaks(spark.createDataFrame(rows, DOCS), bench(spark)).collect()] == [1]
