"""Column expressions for text cleaning and parsing.

All of these are built-in Spark expressions on the JVM side. ``title_key`` calls the
Unicode library among Spark's own jars through ``java_method`` for NFKC and case folding.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from clipforge.functions import constants as C

# Python's str.split() whitespace set, written as one character class that
# Java regex and RE2 read the same way.
WS = r"[\t\n\x0b\x0c\r\x1c-\x1f \x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
# Letters (any script); the token rule shared by every text operator.
WORD = r"\p{L}+"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Python ``str.strip()``: remove leading and trailing whitespace of any kind."""
    return F.regexp_replace(col_(c), rf"^{WS}+|{WS}+$", "")


def clean_text(c) -> Column:
    """Newlines to spaces, drop ``|``, collapse whitespace runs, trim."""
    no_pipes = F.regexp_replace(col_(c), r"\|", "")
    return F.trim(F.regexp_replace(no_pipes, rf"{WS}+", " "))


def strip_leading_hyphens(c) -> Column:
    """Leading hyphens, then leading whitespace."""
    return F.regexp_replace(col_(c), rf"^-*{WS}*", "")


def clean_title(c) -> Column:
    return strip_leading_hyphens(clean_text(c))


def html_unescape_basic(c) -> Column:
    """Decode the XML entities and a few common ones natively.

    The mail and page parsers (``sources.mail``) decode every entity through the
    standard library; this native form serves regex-based extraction.
    """
    x = col_(c)
    for ent, ch in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                    ("&#x27;", "'"), ("&nbsp;", " "), ("&amp;", "&")]:
        x = F.replace(x, F.lit(ent), F.lit(ch))
    return x


def html_escape(c) -> Column:
    """``html.escape(s, quote=True)``: ``&`` first, then ``< > " '``."""
    x = F.replace(col_(c), F.lit("&"), F.lit("&amp;"))
    for ch, ent in [("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")]:
        x = F.replace(x, F.lit(ch), F.lit(ent))
    return x


def capitalize(c) -> Column:
    """Python ``str.capitalize``: first character upper, the rest lower."""
    x = col_(c)
    return F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, 2, 1 << 30)))


def words_of(c) -> Column:
    """Tokens of letters, in order."""
    return F.regexp_extract_all(col_(c), F.lit(WORD), 0)


def split_ws(c) -> Column:
    """Python ``str.split()``: whitespace-separated parts, no empties."""
    # The runs of other characters: F.split would compile its pattern anew for every row. Visible
    # ASCII comes first in the class, so that most characters are settled by one comparison.
    return F.regexp_extract_all(col_(c), F.lit(f"[!-~[^{WS[1:]}]+"), F.lit(0))


# --- dates --------------------------------------------------------------------

def _month_map() -> Column:
    pairs = []
    for i, m in enumerate(C.DUTCH_MONTHS, start=1):
        pairs += [F.lit(m), F.lit(i)]
    return F.create_map(*pairs)


def parse_dutch_datetime(c) -> Column:
    """``%d %b %Y %H:%M`` with Dutch month abbreviations; anything else is null.

    Month names match case-insensitively, a trailing dot is accepted. Invalid
    calendar dates (31 feb) give null, as a failed ``strptime`` does.
    """
    s = clean_text(c)
    pat = r"^(\d{1,2}) (\p{L}+)\.? (\d{4}) (\d{1,2}):(\d{1,2})$"
    g = lambda i: F.regexp_extract(s, pat, i)
    month = F.element_at(_month_map(), F.lower(g(2)))
    ok = s.rlike(pat)
    ts = F.try_make_timestamp_ntz(g(3).cast("int"), month, g(1).cast("int"),
                                  g(4).cast("int"), g(5).cast("int"), F.lit(0))
    return F.when(ok & month.isNotNull() & (g(4).cast("int") < 24) & (g(5).cast("int") < 60), ts)


# --- organisations ---------------------------------------------------------------

def org_class(type_uri) -> Column:
    """Class from the last URI segment: contains ``r`` first, then prefix 003/004."""
    seg = F.element_at(F.split(col_(type_uri), "/"), -1)
    return (F.when(F.instr(seg, "r") > 0, F.lit(C.ORG_RESEARCH))
            .when(seg.startswith("003") | seg.startswith("004"), F.lit(C.ORG_DEPFAC))
            .otherwise(F.lit(C.ORG_PLAIN)))


def faculty_label_from_path(path) -> Column:
    """Label between ``faculteit`` and `` -`` in the file name, else null."""
    name = F.element_at(F.split(col_(path), "/"), -1)
    label = F.trim(F.regexp_extract(name, C.FACULTY_FILE_PATTERN, 1))
    return F.when(name.rlike(C.FACULTY_FILE_PATTERN), label)


def unit_faculties(c, prefix: str = C.FACULTY_PREFIX, sep: str = C.UNIT_PATH_SEPARATOR) -> Column:
    """Parts of a ``//`` path that start with the faculty prefix; the whole value
    when no part does but the value itself does."""
    v = strip_ws(c)
    parts = F.filter(F.transform(F.split(v, F.lit(sep), -1), strip_ws), lambda p: p.startswith(prefix))
    return (F.when(v.isNull(), F.array().cast("array<string>"))
            .when(F.size(parts) > 0, parts)
            .when(v.startswith(prefix), F.array(v))
            .otherwise(F.array().cast("array<string>")))


# --- comparison key of titles ------------------------------------------------------

# A character reference as HTML reads it: decimal, hexadecimal or named.
_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
_REPLACEMENT = "\ufffd"


def _char(code: Column) -> Column:
    """The character of a code point."""
    return F.decode(F.unhex(F.lpad(F.hex(code.cast("long")), 8, "0")), "UTF-32")


def _numeric_reference(ref: Column) -> Column:
    """``&#n;``: control codes 128-159 are read as Windows-1252, what is no character becomes
    U+FFFD, and control codes and noncharacters are left out."""
    digits = F.regexp_extract(ref, r"^&#[xX]?0*([0-9a-fA-F]*);?$", 1)
    base = F.when(ref.rlike("^&#[xX]"), F.conv(digits, 16, 10)).otherwise(digits)
    code = F.when(F.length(digits) > 7, F.lit(0x110000)).otherwise(F.coalesce(base.try_cast("int"), F.lit(0)))
    windows = [bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)]
    left_out = (((code < 0x20) & ~code.isin(9, 10, 12, 13)) | (code == 0x7F) | code.between(0xFDD0, 0xFDEF)
                | (code % 0x10000 >= 0xFFFE))
    return (F.when((code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), F.lit(_REPLACEMENT))
            .when(code.between(0x80, 0x9F), F.get(F.array(*[F.lit(w) for w in windows]), code - 0x80))
            .when(left_out, F.lit("")).otherwise(_char(code)))


def html_unescape(c) -> Column:
    """Every HTML character reference decoded, on the JVM: named ones (the longest known name
    where no ``;`` ends it) and numeric ones."""
    text = col_(c)
    names = F.from_json(F.lit(json.dumps(html5)), "map<string,string>")
    open_names = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True))

    def decoded(part: Column) -> Column:
        prefix = F.regexp_extract(part, f"^&({open_names})", 1)
        named = F.coalesce(F.try_element_at(names, F.substr(part, F.lit(2))),
                           F.when(prefix != "", F.concat(F.try_element_at(names, prefix), F.substr(part, F.length(prefix) + 2))), part)
        return F.when(part.startswith("&#"), _numeric_reference(part)).when(part.startswith("&"), named).otherwise(part)

    parts = F.regexp_extract_all(text, F.lit(rf"{_REFERENCE}|[^&]+|&"), F.lit(0))
    return F.when(text.contains("&"), F.array_join(F.transform(parts, decoded), "")).otherwise(text)


def nfkc_folded(c) -> Column:
    """Unicode NFKC and full case folding by the ICU library that Spark itself ships."""
    text = col_(c)
    composed = F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(True))
    folded = F.java_method(F.lit("com.ibm.icu.lang.UCharacter"), F.lit("foldCase"), composed, F.lit(True))
    return F.when(text.isNotNull(), folded)


def title_key(c) -> Column:
    """Comparison key of a title: strip, HTML-unescape, NFKC, casefold. JVM only.

    (Escaping the folded text again, as the reference does, is injective and does
    not change which titles compare equal, so it is left out of the key.)
    """
    # one-element transform: the unescaped title is built once per row
    return F.transform(F.array(html_unescape(strip_ws(c))), nfkc_folded)[0]
