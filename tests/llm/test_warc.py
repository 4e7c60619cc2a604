import base64
import hashlib
import os
import random
import tempfile

from clipforge.llm import warc
from clipforge.llm.common import partitions

PAGES = "page_id long, url string, html string"


def expect(rows, least=0):
    out, first = [], {}
    for i, _, html in rows:
        h = (html or "").encode()
        if i is not None and len(h) >= least:
            first[h] = min(i, first.get(h, i))
    used = set()
    for i, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        h = (html or "").encode()
        revisit = i is not None and len(h) >= least and (first[h] != i or h in used)
        used |= {h} if i is not None and not revisit else set()
        out.append((i, len(h), base64.b32encode(hashlib.sha1(h).digest()).decode(), "revisit" if revisit else "response", first[h] if revisit else None))
    return out


def rows():
    fake = "<p>WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    page = "<html>" + "é🙂x" * 30
    out = [(1, "http://a/", page), (2, "http://b/ c\r\nd", page), (3, None, None), (4, "u", ""), (5, "u", fake), (6, "u", fake),
           (7, "u", fake * 3 + "tail"), (-8, "u", "neg"), (9, "u", "neg"), (None, "u", "no id"), (None, "u", page), (10, "u", "same"), (10, "u", "same"),
           (11, "u", "WARC/1.0\r\n"), (12, "u", "\r\n\r\nx\r\n\r\n"), (13, "u", "y" * 300_000), (2**40, "u", "far")]
    return out + [(100 + i, "u", f"page {i} " + "z" * (i % 50)) for i in range(120)]


def test_round_trip_equals_brute_force(spark):
    for least in (0, 20):
        path = tempfile.mkdtemp() + "/w"
        warc.write(spark.createDataFrame(rows(), PAGES).repartition(3), path, least_bytes=least)
        got = [tuple(r) for r in warc.read(spark, path).collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, expect(rows(), least)))


def test_files_are_well_formed_and_read_from_any_split(spark):
    path = tempfile.mkdtemp() + "/w"
    warc.write(spark.createDataFrame(rows(), PAGES).repartition(2), path)
    n = 0
    for name in os.listdir(path):
        data = open(f"{path}/{name}", "rb").read() if name.startswith("part-") else b""
        at = 0
        while at < len(data):
            assert data.startswith(b"WARC/1.0\r\n", at)
            head = data[at:data.index(b"\r\n\r\n", at)]
            size = int(head.split(b"\r\nContent-Length: ")[-1])
            at += len(head) + 4 + size + 4
            n += 1
            assert data[at - 4:at] == b"\r\n\r\n"
    assert n == len(rows())
    want = sorted(map(repr, expect(rows())))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("700b", "1001b", "4k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            assert sorted(map(repr, (tuple(r) for r in warc.read(spark, path).where("page_id is null or page_id <> 13").collect()))) == [w for w in want if not w.startswith("(13,")]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert partitions(spark) > 0


def test_empty_table_and_clashing_columns(spark):
    path = tempfile.mkdtemp() + "/w"
    warc.write(spark.createDataFrame([], PAGES), path)
    assert warc.read(spark, path).count() == 0
    path = tempfile.mkdtemp() + "/w"
    warc.write(spark.createDataFrame([(1, "u", "x", 5, "k")], PAGES + ", digest int, value string"), path)
    assert [r["page_id"] for r in warc.read(spark, path).collect()] == [1]


def test_places_meet_the_record_that_holds_them(spark, monkeypatch):
    """Against brute force: many split records in a file, some over several stretches."""
    monkeypatch.setattr(warc, "STRETCH", 50)
    rng = random.Random(5)
    places, split = [], []
    for file in "abc":
        at = 0
        while at < 2000:
            size = rng.choice([3, 10, 40, 400])
            inside = sorted(rng.sample(range(at + 1, at + size), rng.randrange(min(size - 1, 12)))) if size > 3 else []
            places += [(file, x) for x in [at, *inside]]
            if inside:
                split.append((file, at, at + size))
            at += size
    want = {(f, x, a) for f, x in places for g, a, z in split if f == g and a <= x < z}
    got = warc.owners(spark.createDataFrame(places, "file string, off long"), spark.createDataFrame(split, "file string, off long, next long"))
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(want) and set(rows) == want
