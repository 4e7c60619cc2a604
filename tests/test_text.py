import datetime as dt
import html
import random
import unicodedata

import pyarrow as pa
from pyspark.sql import functions as F

from clipforge.functions import text as T


def one(spark, expr, value, typ="string"):
    return spark.createDataFrame([(value,)], f"x {typ}").select(expr(F.col("x")).alias("y")).first().y


def test_clean_text_and_title(spark):
    assert one(spark, T.clean_text, " a |\n b  c ") == "a b c"
    assert one(spark, T.clean_title, "-- - Title  text") == "- Title text"
    assert one(spark, T.clean_title, "---Title") == "Title"


def test_dutch_dates(spark):
    assert one(spark, T.parse_dutch_datetime, "12 mrt 2025 08:30") == dt.datetime(2025, 3, 12, 8, 30)
    assert one(spark, T.parse_dutch_datetime, "| 3 Okt. 1998 8:05") == dt.datetime(1998, 10, 3, 8, 5)
    assert one(spark, T.parse_dutch_datetime, "12 mar 2025 08:30") is None   # English month
    assert one(spark, T.parse_dutch_datetime, "31 feb 2025 08:30") is None   # no such day
    assert one(spark, T.parse_dutch_datetime, "bad") is None


def test_org_class(spark):
    base = "/dk/atira/pure/organisation/organisationtypes/organisation/"
    assert one(spark, T.org_class, base + "003") == "dep/fac"
    assert one(spark, T.org_class, base + "004x") == "dep/fac"
    assert one(spark, T.org_class, base + "r01") == "Research organization"
    assert one(spark, T.org_class, base + "005") == "Organization"
    assert one(spark, T.org_class, base + "003r") == "Research organization"  # 'r' checked first


def test_escape_capitalize(spark):
    assert one(spark, T.html_escape, "a & <b> \"c\" 'd'") == "a &amp; &lt;b&gt; &quot;c&quot; &#x27;d&#x27;"
    assert one(spark, T.capitalize, "nATIONAL") == "National"


def test_unit_faculties(spark):
    f = T.unit_faculties
    assert one(spark, f, "Universiteit // Faculteit Geo // Dept X") == ["Faculteit Geo"]
    assert one(spark, f, "Faculteit Beta") == ["Faculteit Beta"]
    assert one(spark, f, "Dept Y") == []
    assert one(spark, f, "Faculteit // X") == ["Faculteit // X"]


def test_faculty_label(spark):
    assert one(spark, T.faculty_label_from_path, "/in/x/Alert faculteit Beta 1 - week 3.eml") == "Beta 1"
    assert one(spark, T.faculty_label_from_path, "/in/x/other.eml") is None


def test_title_key(spark):
    k = T.title_key
    assert one(spark, k, " Straße &amp; Co ") == one(spark, k, "STRASSE & co")
    assert one(spark, k, "ＡＢＣ") == "abc"   # full-width letters


def test_title_key_equals_the_standard_library(spark):
    r = random.Random(3)
    bits = ["&amp;", "&amp", "&lt", "&notit;", "&#65;", "&#x41", "&#X1F600;", "&#128;", "&#129;", "&#0;", "&#xD800;",
            "&#99999999999;", "&#7;", "&#11;", "&#13;", "&#xFFFE;", "&#x7f;", "&", "&;", "&zzz;", "&#;", "&#x;", "ß", "ﬁ",
            "İ", "A\u030a", " ", "\x85", "Ab", "&copy", "&AMPx", "\n", "#", "&acE;"]
    titles = ["".join(r.choice(bits) for _ in range(r.randrange(9))) for _ in range(2000)]
    titles += ["&" + name for name in html.entities.html5] + [f"x&#{n};y" for n in range(0x200)] + [None, ""]
    rows = spark.createDataFrame([(t,) for t in titles], "t string").select("t", T.html_unescape("t").alias("u"), T.title_key("t").alias("k"))
    assert "Python" not in rows._jdf.queryExecution().executedPlan().toString()
    for t, u, k in rows.collect():
        assert u == (None if t is None else html.unescape(t)), ascii(t)
        assert k == (None if t is None else unicodedata.normalize("NFKC", html.unescape(t.strip())).casefold()), ascii(t)


def test_title_key_of_every_character(spark):
    """All characters of the Unicode version that Python knows, alone and before a combining mark."""
    chars = [chr(c) for c in range(0x110000) if unicodedata.category(chr(c)) not in ("Cs", "Cn", "Co")]
    table = pa.table({"t": chars + [f"a{c}\u0301b" for c in chars]})
    t = spark.createDataFrame(table).select("t", T.title_key("t").alias("k")).toArrow()
    key = lambda x: unicodedata.normalize("NFKC", html.unescape(x.strip())).casefold()
    assert [x for x, k in zip(t["t"].to_pylist(), t["k"].to_pylist(), strict=True) if k != key(x)] == []
