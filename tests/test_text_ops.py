import random
import re

from pyspark.sql import functions as F

from clipforge.operators.language import identify_language, language_profile
from clipforge.operators.proximity import _marks, _marks_to, parsed_queries, proximity_hits, query_phrases, search_texts
from clipforge.operators.units import unit_queries


def brute_near(text, A, B, k):
    toks = re.findall(r"[^\W\d_]+", text.lower())

    def occ(ps):
        out = set()
        for p in ps:
            w = p.split()
            for i in range(len(toks) - len(w) + 1):
                if toks[i:i + len(w)] == w:
                    out.add(i)
        return out
    a, b = occ(A), occ(B)
    return sum(1 for i in a if any(abs(i - j) <= k and j != i for j in b))


def test_proximity_against_brute_force(spark):
    rnd = random.Random(11)
    vocab = ["the", "on", "and", "it", "is", "cat", "dog", "sat"]
    docs = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(0, 300)))) for i in range(40)]
    queries = {"q1": (["the", "on the"], ["and", "it is"]), "q2": (["cat", "cat cat"], ["dog sat", "the"]),
               "q3": (["it is it"], ["nowhere"]), "q4": (["the"], ["the"])}
    k = 7
    rows = [(q, side, p) for q, (A, B) in queries.items() for side, ps in (("a", A), ("b", B)) for p in ps]
    got = {(r.query, r.id): r.hits for r in proximity_hits(
        spark.createDataFrame(docs, "id long, t string"), "id", "t",
        spark.createDataFrame(rows + [("q1", "a", " "), ("q1", "a", None)], "query string, side string, phrase string"), k).collect()}
    want = {(q, i): brute_near(t, A, B, k) for q, (A, B) in queries.items() for i, t in docs}
    assert got == {x: n for x, n in want.items() if n > 0}


def test_places_of_side_a_are_marked_not_laid_beside_queries(spark):
    places = {1: [0, 5, 63, 64, 300], 2: [127]}
    rows = [(i, 9, a) for i, found in places.items() for a in found]
    marks = _marks(spark.createDataFrame(rows, "_id long, side_id long, a int"))
    at = marks.select("_id", F.explode(F.sequence(F.lit(-3).cast("long"), F.lit(500).cast("long"))).alias("at"), "bits", "marks")
    got = {(r["_id"], r["at"]): r["n"] for r in at.select("_id", "at", _marks_to(F.col("at")).alias("n")).collect()}
    assert got == {(i, x): sum(a <= x for a in found) for i, found in places.items() for x in range(-3, 501)}
    phrases = spark.createDataFrame([("q", "a", "the"), ("q", "b", "cat")], "query string, side string, phrase string")
    hits = proximity_hits(spark.createDataFrame([(1, "the cat"), (None, "the cat")], "id long, t string"), "id", "t", phrases, 5)
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Aggregate \[[^\]]*\bquery#\d+, a#\d+", plan)
    assert [(r.query, r.id, r.hits) for r in hits.collect()] == [("q", 1, 1)]


def test_written_queries_can_be_evaluated(spark):
    members = spark.createDataFrame([("Faculteit A", f"Jan Name{chr(97 + i)}", i) for i in range(5)], "faculty string, name_variant string, row_pos long")
    docs = spark.createDataFrame([(1, "At Utrecht University professor Jan Namec spoke"), (2, "Jan Namec spoke elsewhere"),
                                  (3, "Universiteit Utrecht: Jan Namea")], "id long, t string")
    hits = proximity_hits(docs, "id", "t", query_phrases(members, limit=2), 50).collect()
    assert {(r.query, r.id) for r in hits} == {("Faculteit A#1", 1), ("Faculteit A#0", 3)}


def test_query_texts_are_read_back(spark):
    names = ['Jan "Jim" Smit', "D. (Dina) OR Or", "Ex NEAR/5 (x", "plain"]
    members = spark.createDataFrame([("Faculteit A", n, i) for i, n in enumerate(names)], "faculty string, name_variant string, row_pos long")
    texts = unit_queries(members, limit=3).select("chunk", "query")
    bad = spark.createDataFrame([(7, "no query"), (8, None), (9, '("a") NEAR/x ("b")')], "chunk long, query string")
    got = {(r["query"], r["side"], r["phrase"], r["near"]) for r in parsed_queries(texts.unionByName(bad), "chunk").collect()}
    orgs = ("Utrecht University", "Universiteit Utrecht")
    assert got == ({(c, "a", o, 50) for c in (0, 1) for o in orgs} | {(i // 3, "b", n, 50) for i, n in enumerate(names)}
                   | {(c, None, None, None) for c in (7, 8, 9)})


def test_search_with_a_distance_per_query(spark):
    docs = spark.createDataFrame([(1, "alpha one two three beta"), (2, "beta alpha beta"), (3, None), (4, "Alpha-BETA " * 3000)], "id long, t string")
    texts = spark.createDataFrame([("wide", '("alpha") NEAR/4 ("beta")'), ("tight", '("alpha") NEAR/3 ("beta" OR "none such")'), ("odd", "alpha beta")],
                                  "query_id string, query string")
    got = {(r["query"], r["id"]): r["hits"] for r in search_texts(docs, "id", "t", texts).collect()}
    assert got == {("wide", 1): 1, ("wide", 2): 1, ("tight", 2): 1, ("wide", 4): 3000, ("tight", 4): 3000}


def test_language_identification(spark):
    train = spark.createDataFrame([("en", "the weather is nice and the sun shines over the hills"),
                                   ("en", "this is the house where they live with their children"),
                                   ("nl", "het weer is mooi en de zon schijnt over de heuvels"),
                                   ("nl", "dit is het huis waar zij wonen met hun kinderen")], "lang string, text string")
    prof = language_profile(train)
    probe = spark.createDataFrame([(1, "the children live in the house"), (2, "de kinderen wonen in het huis"),
                                   (3, "1234 !!")], "id long, t string")
    got = {r.id: r.lang for r in identify_language(probe, "id", "t", prof).collect()}
    assert got == {1: "en", 2: "nl"}          # no letters: detection fails, no row
