"""Source and title block lists."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipforge.functions.text import strip_ws
from clipforge.sources.sheets import read_sheet

#: Words are found in titles by their first characters: as many as the longest of these
#: lengths that the word has.
ANCHORS = (1, 2, 4, 8)


def read_list(spark: SparkSession, path: str, column: str | None = None, out_col: str = "word",
              sheet: str | None = None) -> DataFrame:
    """A one-column block list from a CSV (with header), Parquet or ``.xlsx`` file: trimmed,
    nulls and blanks dropped, distinct. Without ``column`` it is the first one; ``sheet`` names
    the sheet of a workbook (else its first). A missing file is an empty list."""
    try:
        if path.endswith(".xlsx"):
            raw = read_sheet(spark, path, sheet)
        else:
            raw = spark.read.parquet(path) if path.endswith(".parquet") else spark.read.option("header", True).csv(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{out_col} string")
    value = F.col(f"`{column if column is not None else raw.columns[0]}`").cast("string")
    return raw.select(strip_ws(value).alias(out_col)).where(F.length(out_col) > 0).distinct()


def comma_list(value: str | None) -> list[str]:
    """The trimmed, non-empty parts of a comma list."""
    return [part.strip() for part in (value or "").split(",") if part.strip()]


def drop_blocked_sources(df: DataFrame, blocked: DataFrame, source_col: str = "source",
                         blocked_col: str = "source") -> DataFrame:
    """Exact, case-sensitive equality; a hash anti join (AQE broadcasts the list
    when its measured size is small)."""
    b = blocked.select(F.col(blocked_col).alias("_blocked")).where(F.col("_blocked").isNotNull()).distinct()
    return df.join(b, df[source_col] == b["_blocked"], "left_anti")


def drop_blocked_titles(df: DataFrame, words: DataFrame, title_col: str, key_col: str,
                        word_col: str = "word") -> DataFrame:
    """Drop rows whose title contains any listed word (case-sensitive substring).

    A word's anchor is its first 1, 2, 4 or 8 characters, the most it has. Of a title the
    substrings of the lengths that occur in the list (four numbers at most) are
    equi-joined with the anchors and the few candidates verified with ``instr``, so the cost
    is linear in the titles whatever the size of the list, and no side is broadcast by hand.
    """
    w = words.select(F.col(word_col).alias("_w")).where(F.length("_w") > 0).distinct()
    w = w.withColumn("_n", F.lit(ANCHORS[0]))
    for n in ANCHORS[1:]:
        w = w.withColumn("_n", F.when(F.length("_w") >= n, n).otherwise(F.col("_n")))
    w = w.withColumn("_a", F.substr("_w", F.lit(1), "_n"))
    lengths = [r["_n"] for r in w.select("_n").distinct().collect()]
    if not lengths:
        return df

    def of_length(ch, n):
        starts = F.sequence(F.lit(1), F.greatest(F.size(ch) - n, F.lit(0)) + 1)
        return F.transform(starts, lambda i: F.array_join(F.slice(ch, i, n), ""))

    def grams(ch):
        return F.array_distinct(F.flatten(F.array(*[of_length(ch, n) for n in lengths])))

    # one-element transforms: the character array is built once per row
    chars = F.filter(F.split(F.col(title_col), ""), lambda c: c != "")
    subs = F.transform(F.array(chars), grams)[0]
    pieces = df.where(F.length(title_col) > 0).select(F.col(key_col).alias("_k"), F.col(title_col).alias("_t"), F.explode(subs).alias("_a"))
    hit = pieces.join(w, "_a").where(F.instr(F.col("_t"), F.col("_w")) > 0).select("_k").distinct()
    return df.join(hit, df[key_col] == hit["_k"], "left_anti")
