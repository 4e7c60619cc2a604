"""Person mentions of an article block.

Extraction rules are native array expressions per block (bounded by the block's
own content). Black list, subsumption and cleaning run on exploded
(article, name) rows with anti joins on (article, word), so no article or group
is gathered and the cost stays linear in the number of mentions.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipforge.functions import constants as C
from clipforge.functions.text import WS, col_, split_ws, strip_ws
from clipforge.session import written

_ELLIPSIS = rf"{WS}*\.\.\.$"


def labelled_names(labelled_texts, label: str = C.PERSONS_LABEL) -> Column:
    """``Personen: a, b, c ...`` texts -> names (label removed, comma split, trimmed,
    trailing ``...`` removed, empties dropped)."""
    t = F.transform(col_(labelled_texts), lambda s: F.regexp_replace(s, rf"{label}:{WS}*", ""))
    parts = F.flatten(F.transform(t, lambda s: F.split(s, rf",{WS}*", -1)))
    names = F.transform(parts, lambda p: F.regexp_replace(strip_ws(p), _ELLIPSIS, ""))
    return F.filter(names, lambda n: n != "")


def faculty_names(block_text, pattern: str = C.FACULTY_NAME_PATTERN) -> Column:
    """Names after ``Faculteit <x> / `` (non-overlapping matches), a swallowed
    ``\\nFaculteit ...`` tail and a trailing ``...`` removed."""
    found = F.regexp_extract_all(col_(block_text), F.lit(pattern), 1)
    names = F.transform(found, lambda m: F.regexp_replace(
        F.regexp_replace(strip_ws(m), r"\nFaculteit [^/]+", ""), _ELLIPSIS, ""))
    return F.filter(names, lambda n: n != "")


def highlight_names(tokens) -> Column:
    """Highlighted tokens -> all of them joined (when 1-6 words), each adjacent
    pair (when at most 4 words), and the last token when the count is odd."""
    t = F.filter(col_(tokens), lambda x: x.isNotNull() & (x != ""))
    n = F.size(t)
    full = F.array_join(t, " ")
    nw = F.size(split_ws(full))
    full_arr = F.when((n > 0) & (nw >= 1) & (nw <= 6), F.array(full)).otherwise(F.array().cast("array<string>"))
    # zip_with over two slices: the token array is evaluated once per row, not
    # once per element (an indexed lambda would re-evaluate it for every pair).
    pairs = F.when(n >= 2, F.zip_with(F.slice(t, 1, n - 1), F.slice(t, 2, n - 1),
                                      lambda a, b: F.concat(a, F.lit(" "), b))) \
        .otherwise(F.array().cast("array<string>"))
    pairs = F.filter(pairs, lambda c: (F.size(split_ws(c)) >= 1) & (F.size(split_ws(c)) <= 4))
    last = F.when(n % 2 == 1, F.array(F.element_at(t, -1))).otherwise(F.array().cast("array<string>"))
    return F.concat(full_arr, pairs, last)


def raw_mentions(labelled_texts=None, block_text=None, highlighted=None) -> Column:
    """Union (set) of the three extraction rules of a block."""
    empty = F.array().cast("array<string>")
    parts = [labelled_names(labelled_texts) if labelled_texts is not None else empty,
             faculty_names(block_text) if block_text is not None else empty,
             highlight_names(highlighted) if highlighted is not None else empty]
    return F.array_distinct(F.concat(*parts))


def clean_name(c, patterns=C.UNWANTED_TERM_PATTERNS) -> Column:
    """One name: remove each pattern in order (stripping after each), collapse whitespace."""
    x = col_(c)
    whole = strip_ws(x)
    for p in patterns:
        x = strip_ws(F.regexp_replace(x, "(?U)" + p, ""))
    if patterns and not any(re.search(r"\\\d|\(\?|\(", p) for p in patterns):
        # most names hold none of the terms, stripped or not, and need no pass per term
        some = "(?U)" + "|".join(patterns)
        x = F.when(col_(c).rlike(some) | whole.rlike(some), x).otherwise(whole)
    return F.array_join(split_ws(x), " ")


def _subsume_rows(df: DataFrame, id_col: str, name_col: str, against: DataFrame | None = None) -> DataFrame:
    """Exploded subsumption within each article (see :func:`subsume_partials`)."""
    src = df if against is None else against
    words = (src.select(id_col, split_ws(name_col).alias("_p")).where(F.size("_p") > 1)
             .select(id_col, F.explode(F.transform("_p", lambda w: F.lower(w))).alias("_w")).distinct())
    # the names are read once: a name of more words is looked up by what no word is
    parts = df.withColumn("_p", split_ws(name_col)).where(F.size("_p") > 0)
    parts = parts.withColumn("_w", F.when(F.size("_p") == 1, F.lower(F.col("_p")[0])).otherwise(F.concat(F.lit(" "), name_col))).drop("_p")
    return parts.join(words, [id_col, "_w"], "left_anti").drop("_w")


def clean_mentions(df: DataFrame, id_col: str, names_col: str, blacklist=C.BLACKLIST_NAMES,
                   patterns=C.UNWANTED_TERM_PATTERNS, materialise: bool = True) -> DataFrame:
    """(id, mention, first_pos): the final mentions of each article with the place (from
    0) of the first raw name that gave them.

    Black list and first subsumption (against every multi-word name of the
    article, black-listed ones too), cleaning, second subsumption (against the
    survivors). Runs on exploded rows with anti joins on (article, word), so the
    cost is linear in the mentions and no article is gathered into one row.
    The exploded names are read by two branches; with ``materialise`` they are
    written once so the upstream extraction is not run twice.
    """
    names = df.select(F.col(id_col), F.posexplode(F.array_distinct(names_col)).alias("first_pos", "mention"))
    if materialise:
        names = written(names, "mentions")
    bl = [b.lower() for b in blacklist]
    kept = names.where(~F.lower("mention").isin(bl)) if bl else names
    first = _subsume_rows(kept, id_col, "mention", against=names)
    cleaned = first.select(id_col, clean_name("mention", patterns).alias("mention"), "first_pos").where(F.col("mention") != "") \
        .groupBy(id_col, "mention").agg(F.min("first_pos").alias("first_pos"))
    if materialise:  # read for its names and for their words
        cleaned = written(cleaned, "cleaned")
    return _subsume_rows(cleaned, id_col, "mention")


def subsume_partials(df: DataFrame, group_col: str, name_col: str) -> DataFrame:
    """Exploded form of the subsumption rule over (group, name) rows: a one-word
    name is dropped when a multi-word name of the same group has it as a word
    (case-insensitive). One anti join on (group, word); no group is gathered."""
    parts = df.select(group_col, name_col, split_ws(name_col).alias("_parts"))
    words = (parts.where(F.size("_parts") > 1)
             .select(group_col, F.explode(F.transform("_parts", lambda w: F.lower(w))).alias("_w"))
             .distinct())
    single = parts.where(F.size("_parts") == 1).withColumn("_w", F.lower(F.col("_parts")[0]))
    kept_single = single.join(words, [group_col, "_w"], "left_anti")
    multi = parts.where(F.size("_parts") > 1)
    return multi.select(group_col, name_col).unionByName(kept_single.select(group_col, name_col))
