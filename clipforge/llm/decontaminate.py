"""Benchmark decontamination by canonical templates, in DataFrame expressions only.

Numbers, names and units become typed placeholders, case and punctuation go, and
runs of ``WINDOW`` tokens of the resulting templates are hash-joined with those of
the benchmark. So a question asked again with other numbers or names still matches.
A match counts when its slots are consistent: over the matched windows of one place of the
item in the document, each filled-in value of the benchmark item stands for one value of
the document and the other way round. Other variants in the same document change nothing.

Only (document, position, hash) triples meet the benchmark; its windows are broadcast
when their counted rows fit a fixed size and shuffled otherwise. The texts of matched
documents alone are read again for their slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipforge.llm.common import broadcast_if_small, stored

WINDOW = 8
#: An item of fewer tokens is matched with whole documents only: a few words stand in many texts.
MIN_ITEM = 5
#: A document leaks an item when it holds this share of the item's windows, or this many of them.
MIN_SHARE = 0.3
MIN_WINDOWS = 6
#: Hits of one place of an item may differ by this many tokens in their shift, for words put in
#: or left out; less than MIN_ITEM, so that copies end to end are places of their own.
MAX_STEP = 4

#: Fixed list of units that count as such after a number.
UNITS = ["%", "mm", "cm", "m", "km", "in", "ft", "yd", "mi", "mg", "g", "kg", "t", "oz", "lb", "lbs", "ml", "cl", "l",
         "s", "sec", "min", "h", "hr", "hrs", "second", "seconds", "minute", "minutes", "hour", "hours", "day", "days",
         "week", "weeks", "month", "months", "year", "years", "meter", "meters", "metre", "metres", "mile", "miles",
         "gram", "grams", "liter", "liters", "litre", "litres", "dollar", "dollars", "euro", "euros", "cent", "cents",
         "percent", "degree", "degrees", "mph", "kmh", "w", "kw", "v", "hz", "kb", "mb", "gb", "tb"]

NAME = r"(?<=[\p{L}\p{N},;] )\p{Lu}\p{Ll}+"
NUMBER = r"\d+(?:[.,:/]\d+)*"
UNIT = r"(?<=\d ?)(?:" + "|".join(sorted(UNITS, key=lambda u: (-len(u), u))) + r")(?![\p{L}\p{N}])"
SLOT = f"({NAME})|({NUMBER})|({UNIT})"
#: Placeholders, in letters that texts hardly use, so that they pass case folding and the split.
NAME_TOKEN, NUMBER_TOKEN, UNIT_TOKEN = "ʘn", "ʘd", "ʘu"


def _plain(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), "ʘ", " ")


def template(text: Column, values: bool = False) -> Column:
    """The canonical tokens of a text: array of strings, empty for null. Slots are marked in one
    pass over the text as it is; a marked slot then becomes its placeholder. With ``values``
    the placeholder is followed by what it stands for: the same tokens at the same places, as
    the points inside numbers stay and a ``%`` leaves nothing."""
    own = "$1" if values else ""
    t = F.regexp_replace(_plain(text), SLOT, "ʘ<$1ʘ<$2ʘ<$3ʘ>")
    t = F.regexp_replace(t, "ʘ<([^ʘ]+)ʘ<ʘ<ʘ>", NAME_TOKEN + own)
    t = F.regexp_replace(t, "ʘ<ʘ<([^ʘ]+)ʘ<ʘ>", f" {NUMBER_TOKEN}{own} ")
    t = F.regexp_replace(t, "ʘ<ʘ<ʘ<([^ʘ]+)ʘ>", f" {UNIT_TOKEN}{own} ")
    inside = r"(?!(?<=\d)[.,:/](?=\d))" if values else ""
    t = F.regexp_replace(F.lower(t), rf"(?:{inside}[!-/:-@\[-`{{-~])+", " ")
    return F.array_remove(F.split(t, r"[\x20\x09-\x0D]+", -1), "")


def slots(text: Column) -> Column:
    """The values under a text's placeholders, in order, lower-cased."""
    return F.transform(F.regexp_extract_all(_plain(text), F.lit(SLOT), F.lit(0)), lambda x: F.lower(x))


def _windows(df: DataFrame, size: Column) -> DataFrame:
    """(…, pos, h): one row per run of ``size`` tokens of ``tokens``.

    The outer form of explode: for the plain one the optimiser adds a filter on the array's
    size, for which it computes the array a second time."""
    df = df.withColumn("hashed", F.transform("tokens", lambda x: F.xxhash64(x))).drop("tokens")
    h = F.col("hashed")
    run = F.transform(F.slice(h, 1, F.greatest(F.size(h) - size + 1, F.lit(0))),
                      lambda x, i: F.xxhash64(size, *[F.when(size > k, h[F.least(i + k, F.size(h) - 1)]) for k in range(WINDOW)]))
    return df.withColumn("run", run).select(*[c for c in df.columns if c != "hashed"], F.posexplode_outer("run").alias("pos", "h")).where("h is not null")


def _doc_windows(df: DataFrame) -> DataFrame:
    df = df.withColumn("hashed", F.transform("tokens", lambda x: F.xxhash64(x))).drop("tokens")
    h = F.col("hashed")
    run = F.transform(F.slice(h, 1, F.greatest(F.size(h) - (WINDOW - 1), F.lit(0))),
                      lambda x, i: F.xxhash64(F.lit(WINDOW), *[h[i + k] for k in range(WINDOW)]))
    return df.withColumn("run", run).select(*[c for c in df.columns if c != "hashed"], F.posexplode_outer("run").alias("pos", "h")).where("h is not null")


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
          item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, doc_key, item_id, n_windows, n_item_windows, first_token, last_token, n_slots) of each
    document and item that it leaks, with tokens counted in the document's template.

    ``doc_key`` (hash of id and text) tells documents of one id, or of a null id, apart;
    rows that repeat exactly share it and their row here. Null or empty texts match
    nothing. Items of fewer than ``WINDOW`` tokens match as a whole, those of fewer than
    ``MIN_ITEM`` where they are all that a document holds. Equal items are matched each on
    their own."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(id_col), F.col(text)).alias("doc_key"), F.col(text).alias("text"))
    items = stored(benchmark.select(F.col(item_id).alias("item_id"), F.monotonically_increasing_id().alias("item"),
                                    template(F.col(item_text)).alias("tokens"), template(F.col(item_text), True).alias("values"))
                   .where(F.size("tokens") > 0), "benchmark_templates")
    size = F.least(F.size("tokens"), F.lit(WINDOW))
    sized = items.select("item", size.alias("size"), "tokens")
    wins = stored(_windows(sized, F.col("size")).select("item", "size", F.col("pos").alias("ipos"), "h"), "benchmark_windows")
    lengths = [r[0] for r in wins.select("size").distinct().collect()]  # at most WINDOW values
    counts = wins.groupBy("item").agg(F.count(F.lit(1)).alias("n_item_windows"))

    side = broadcast_if_small(wins.select("item", "ipos", "h"), 64)
    tokens = d.select("doc_id", "doc_key", template(F.col("text")).alias("tokens"))
    found = _doc_windows(tokens).join(side, "h")
    for n in (n for n in lengths if n < WINDOW):
        long_enough = F.size("tokens") >= n if n >= MIN_ITEM else F.size("tokens") == n
        found = found.unionByName(_windows(tokens.where(long_enough), F.lit(n)).join(side, "h"))
    found = stored(found.select("doc_id", "doc_key", "pos", "item", "ipos"), "window_hits")

    enough = (F.col("n_windows") >= MIN_WINDOWS) | (F.col("n_windows") >= MIN_SHARE * F.col("n_item_windows"))
    shift = F.col("pos") - F.col("ipos")
    near = (found.groupBy("doc_key", "item").agg(F.count_distinct("ipos").alias("n_windows"), F.max("doc_id").alias("doc_id"),
                                                 F.min(shift).alias("lo"), F.max(shift).alias("hi"))
            .join(counts, "item").where(enough))
    near = stored(near, "near_items")
    spots = (found.join(near.select("doc_key", "item", "lo", "hi"), ["doc_key", "item"])
             .select("doc_key", "item", "pos", "ipos", shift.alias("shift"), "lo", "hi").distinct())
    spots = stored(_places(spots), "places")
    placed = (spots.groupBy("doc_key", "item", "lo", "hi")
              .agg(F.count_distinct("ipos").alias("n_windows"), F.count(F.lit(1)).alias("n_hits"), F.max("parts").alias("parts"), F.min("pos").alias("first"), F.max("pos").alias("last"))
              .join(near.select("doc_key", "item", "doc_id", "n_item_windows"), ["doc_key", "item"])
              .where(enough & (~F.col("parts") | (F.col("n_hits") == F.col("n_windows")))))
    return _consistent(d, items, spots, stored(placed, "near_places"))


def _places(spots: DataFrame) -> DataFrame:
    """``spots`` once for each place of the item that they belong to, a range ``lo`` to ``hi`` of
    shifts between document and item: its own shift, the run of shifts around it with steps
    of up to ``MAX_STEP``, and all of the document (``parts``), for an item whose parts stand far
    apart: that counts only when each window stands there once, so it never pools variants."""
    several = spots.where("lo < hi").select("doc_key", "item", "shift").distinct()
    by = Window.partitionBy("doc_key", "item").orderBy("shift")
    starts = (F.col("shift") - F.lag("shift").over(by) > MAX_STEP).cast("int")
    runs = several.withColumn("run", F.sum(F.coalesce(starts, F.lit(0))).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    whole = Window.partitionBy("doc_key", "item", "run")
    runs = runs.select("doc_key", "item", "shift", F.min("shift").over(whole).alias("run_lo"), F.max("shift").over(whole).alias("run_hi"))
    run_lo, run_hi = F.coalesce("run_lo", "shift"), F.coalesce("run_hi", "shift")
    place = lambda lo, hi, parts=F.lit(False): F.struct(lo.alias("lo"), hi.alias("hi"), parts.alias("parts"))
    ranges = F.array_distinct(F.array(place(F.col("lo"), F.col("hi"), (F.col("lo") < run_lo) | (run_hi < F.col("hi"))),
                                      place(run_lo, run_hi), place(F.col("shift"), F.col("shift"))))
    return (spots.join(runs, ["doc_key", "item", "shift"], "left").select("doc_key", "item", "pos", "ipos", F.explode(ranges).alias("r"))
            .select("doc_key", "item", "pos", "ipos", "r.*"))


def _consistent(d: DataFrame, items: DataFrame, spots: DataFrame, near: DataFrame) -> DataFrame:
    place = ["doc_key", "item", "lo", "hi"]
    holds = lambda a: F.exists(a, lambda x: x.startswith("ʘ"))
    with_slots = items.where(holds("tokens")).select("item", F.col("tokens").alias("item_tokens"), "values")
    spots = spots.join(near.select(*place), place, "left_semi")
    spots = spots.join(broadcast_if_small(with_slots.select("item"), 16), "item")
    keys = spots.select("doc_key").distinct()
    texts = (d.join(broadcast_if_small(keys, 16), "doc_key", "left_semi").groupBy("doc_key").agg(F.first("text").alias("text"))
             .select("doc_key", template(F.col("text"), True).alias("doc_values")))
    aligned = spots.join(texts.where(holds("doc_values")), "doc_key").join(with_slots, "item")
    size = F.least(F.size("item_tokens"), F.lit(WINDOW))
    pairs = F.transform(F.sequence(F.lit(0), size - 1), lambda k: F.struct(
        F.col("item_tokens")[F.col("ipos") + k].alias("kind"),
        F.col("values")[F.col("ipos") + k].alias("theirs"),
        F.get("doc_values", F.col("pos") + k).alias("ours")))
    filled = (aligned.select(*place, F.explode(pairs).alias("p")).select(*place, "p.*")
              .where(F.col("kind").startswith("ʘ") & F.col("ours").isNotNull()).distinct())
    ours = filled.groupBy(*place, "kind", "theirs").agg(F.count(F.lit(1)).alias("n"))
    theirs = filled.groupBy(*place, "kind", "ours").agg(F.count(F.lit(1)).alias("n"))
    bad = (ours.where("n > 1").select(*place).unionByName(theirs.where("n > 1").select(*place))
           .groupBy(*place).agg(F.count(F.lit(1)).alias("n_bad")))
    filled_n = filled.groupBy(*place).agg(F.count(F.lit(1)).alias("n_slots"))
    # A few clashes are allowed as long as most filled values of a place agree. One such place
    # is enough; of several, the one with most windows is reported, then the widest, then the first.
    good = (near.join(filled_n, place, "left").join(bad, place, "left")
            .where(2 * F.coalesce("n_bad", F.lit(0)) <= F.coalesce("n_slots", F.lit(0))))
    order = F.struct("n_windows", F.col("hi") - F.col("lo"), -F.col("lo"))
    best = (good.groupBy("doc_key", "item").agg(F.max_by(F.struct("doc_id", "n_windows", "n_item_windows", "first", "last", "n_slots"), order).alias("b"))
            .select("item", "doc_key", "b.*"))
    return (best.join(items.select("item", "item_id"), "item")
            .select("doc_id", "doc_key", "item_id", "n_windows", "n_item_windows", F.col("first").cast("long").alias("first_token"),
                    (F.col("last") + F.lit(WINDOW - 1)).cast("long").alias("last_token"), F.coalesce("n_slots", F.lit(0).cast("long")).alias("n_slots")))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents that leak a benchmark item; all columns stay."""
    found = leaks(docs, benchmark, id_col, text)
    keys = stored(found.select("doc_key").distinct(), "leaking")
    side = broadcast_if_small(keys, 16)
    return docs.join(side, F.xxhash64(docs[id_col], docs[text]) == side["doc_key"], "left_anti")
