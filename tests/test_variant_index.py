import random

import pytest
from pyspark.sql import functions as F

from clipforge.operators import variant_index as v
from clipforge.operators.entities import match_mentions

PEOPLE = "pos int, uuid string, name struct<firstName string, lastName string>, names array<struct<name: struct<firstName string, lastName string>>>"


def people(spark, rows):
    return spark.createDataFrame([(i, u, (a, b), [((x, y),) for x, y in alts]) for i, u, a, b, alts in rows], PEOPLE)


def made_up(n, seed):
    r = random.Random(seed)
    word = lambda k: "".join(r.choice("aeiorst") for _ in range(k))
    return [(i, f"u{seed}-{i}", word(r.randint(4, 9)), word(r.randint(5, 32)), [(word(5), word(8))] if i % 4 == 0 else []) for i in range(n)]


def mentions_of(spark, rows, seed=9):
    r = random.Random(seed)
    out = [(None,), ("",), ("nobody at all",)]
    for _, _, a, b, alts in rows:
        for x, y in [(a, b), *alts]:
            s = f"{x} {y}"
            at = r.randrange(len(s))
            out += [(s.upper(),), (s[:at] + s[at + 1:],), (s[:at] + "é" + s[at:],)]
    return spark.createDataFrame(out, "mention string")


def found(df):
    return sorted(tuple(r) for r in df.select("mention_key", "uuid", "pos", "d", "L").collect())


def test_index_gives_the_rows_of_the_direct_match_after_every_change(spark):
    first, more = made_up(40, 1), made_up(15, 2)
    mentions = mentions_of(spark, first + more)
    index = v.build_index(people(spark, first), buckets=4)
    assert found(v.match_indexed(mentions, index)) == found(match_mentions(mentions, people(spark, first))) != []
    # new persons, one of them with a known name; one replaced under a new name; two removed, one unknown
    twin = (99, "twin", first[3][2], first[3][3], [])
    moved = (5, first[5][1], "other", "namebearer", [])
    index = v.changed(index, people(spark, [*more, twin, moved]), spark.createDataFrame([(first[3][1],), ("unknown",)], "uuid string"))
    now = [x for x in first if x[1] not in (first[3][1], first[5][1])] + [*more, twin, moved]
    assert found(v.match_indexed(mentions, index)) == found(match_mentions(mentions, people(spark, now)))
    # the removed person comes back
    index = v.changed(index, people(spark, [first[3]]))
    now.append(first[3])
    want = found(match_mentions(mentions, people(spark, now)))
    assert found(v.match_indexed(mentions, index)) == want
    one = v.compacted(index)
    assert len(one.persons) == 1 and found(v.match_indexed(mentions, one)) == want


def test_known_spellings_get_no_new_entries_and_generations_are_merged(spark, monkeypatch):
    rows = made_up(5, 3)
    index = v.changed(v.build_index(people(spark, rows), buckets=2), people(spark, [(9, "same", rows[0][2], rows[0][3], [])]))
    assert spark.table(index.variants[1]).count() == 0 and spark.table(index.persons[1]).count() == 1
    monkeypatch.setattr(v, "MAX_GENERATIONS", 3)
    index = v.changed(index, people(spark, []), spark.createDataFrame([("same",)], "uuid string"))
    assert len(index.persons) == 1 and v.living(index).where("uuid = 'same'").isEmpty()


def test_empty_directory_and_empty_mentions(spark):
    none = people(spark, [])
    index = v.build_index(none, buckets=2)
    assert v.match_indexed(spark.createDataFrame([("a b",)], "mention string"), index).isEmpty()
    full = v.changed(index, people(spark, made_up(3, 4)))
    assert v.match_indexed(spark.createDataFrame([], "mention string"), full).isEmpty()


@pytest.mark.parametrize("kind,key", [("variants", "variant"), ("grams", "g")])
def test_the_directory_is_not_shuffled(spark, kind, key):
    index = v.build_index(people(spark, made_up(20, 5)), buckets=8)
    probe = spark.range(100).select(F.col("id").cast("string").alias(key))
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = probe.join(spark.table(getattr(index, kind)[0]), key)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, x in old.items():
            spark.conf.set(k, x)
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1
