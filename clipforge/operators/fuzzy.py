"""Exact fuzzy join on the indel ratio, without a Cartesian product.

``ratio(a, b) = 100 * (1 - d / L)`` with ``L = len(a) + len(b)`` and ``d`` the
indel distance (``L - 2 * LCS``). A pair passes a threshold ``t`` when
``100 * (L - d) >= t * L`` (integer form, no floats).

Two routes find every passing pair:

* deletion neighbourhoods -- each string is expanded to its variants with up to
  ``k`` deleted characters; two strings share a variant reached with ``i`` and
  ``j`` deletions exactly when ``d <= i + j``, and the smallest ``i + j`` is ``d``.
  Candidates come from an equi-join on the variant (hash shuffle, no UDF).
  ``k`` per string is the largest distance any partner could have at the
  threshold, capped at ``MAX_DELETIONS``;
* intact pieces -- for strings whose bound D exceeds the cap: of D + 1 pieces of
  the left string one is left whole by D edits, so it stands in the right string, at
  most D places away. Left strings give one q-gram per piece, right strings all
  their q-grams; candidates from an equi-join on the q-gram, within D places and
  lengths, are screened with ``levenshtein`` (a lower bound of ``d``) and measured
  exactly by dynamic programming in a band of width 2 D + 1.

Only strings short enough to need them are expanded to variants, so the number of
variants of any string is bounded; longer ones cost their length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipforge.functions import constants as C

MAX_DELETIONS = 2


def _rate(threshold: int) -> float:
    return (100 - threshold) / 100.0


def max_distance_for_length(n: int, threshold: int = C.MATCH_THRESHOLD) -> int:
    """Largest indel distance a passing partner of a length-``n`` string can have."""
    r = _rate(threshold)
    if r <= 0:
        return 0
    return int((2 * r * n) / (1 - r) + 1e-9)


def first_long(threshold: int = C.MATCH_THRESHOLD, k: int = MAX_DELETIONS) -> int | None:
    """Smallest length whose distance bound exceeds ``k``; None if none does."""
    if _rate(threshold) <= 0:
        return None
    n = 1
    while max_distance_for_length(n, threshold) <= k:
        n += 1
    return n


def piece_length(threshold: int = C.MATCH_THRESHOLD, k: int = MAX_DELETIONS) -> int:
    """Length that each of the D + 1 pieces of a long string has at least. Pieces grow
    with the string while D does not, so the steps of D decide."""
    n = first_long(threshold, k) or 1
    lengths = []
    for _ in range(64):
        D = max_distance_for_length(n, threshold)
        lengths.append(n // (D + 1))
        while max_distance_for_length(n, threshold) == D:
            n += 1
    return max(min(lengths), 1)


def _deletions_expr(s: Column, n: Column, k: int) -> Column:
    """Array of struct(v, k) for 0..k deletions (distinct within each level)."""
    levels = [F.array(F.struct(s.alias("v"), F.lit(0).alias("k")))]
    if k >= 1:
        one = F.array_distinct(F.transform(
            F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
            lambda i: F.concat(F.substring(s, F.lit(1), i - 1), F.substring(s, i + 1, F.lit(1 << 30)))))
        levels.append(F.transform(F.when(n >= 1, one).otherwise(F.array().cast("array<string>")),
                                  lambda v: F.struct(v.alias("v"), F.lit(1).alias("k"))))
    if k >= 2:
        two = F.array_distinct(F.flatten(F.transform(
            F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))),
            lambda i: F.transform(
                F.sequence(i + 1, F.greatest(n, i + 1)),
                lambda j: F.concat(F.substring(s, F.lit(1), i - 1),
                                   F.substring(s, i + 1, j - i - 1),
                                   F.substring(s, j + 1, F.lit(1 << 30)))))))
        levels.append(F.transform(F.when(n >= 2, two).otherwise(F.array().cast("array<string>")),
                                  lambda v: F.struct(v.alias("v"), F.lit(2).alias("k"))))
    return F.flatten(F.array(*levels))


def deletion_variants(df: DataFrame, id_col: str, str_col: str,
                      threshold: int = C.MATCH_THRESHOLD, max_deletions: int = MAX_DELETIONS,
                      with_length: bool = False) -> DataFrame:
    """(id, variant, k[, n]): each string with its variants of up to min(bound, cap)
    deletions (``n`` = length of the string, when asked for)."""
    s = F.col(str_col)
    n = F.length(s)
    r = _rate(threshold)
    bound = F.floor(F.lit(2 * r / (1 - r)) * n + F.lit(1e-9)) if r > 0 else F.lit(0)
    k = F.least(bound, F.lit(max_deletions))
    arr0 = _deletions_expr(s, n, 0)
    arr1 = _deletions_expr(s, n, 1)
    arr2 = _deletions_expr(s, n, 2)
    arr = F.when(k <= 0, arr0).when(k == 1, arr1).otherwise(arr2) if max_deletions >= 2 else \
        F.when(k <= 0, arr0).otherwise(arr1)
    out = df.select(F.col(id_col).alias("_id"), n.alias("_n"), F.explode(arr).alias("_x"))
    cols = [F.col("_id").alias(id_col), F.col("_x.v").alias("variant"), F.col("_x.k").alias("k")]
    if with_length:
        cols.append(F.col("_n").alias("n"))
    return out.select(*cols)


def indel_distance(a: Column, b: Column, limit: Column) -> Column:
    """Indel distance of two strings if it is at most ``limit``, else some larger number:
    dynamic programming over the diagonals within ``limit`` of the main one, native."""
    far = F.lit(1 << 28)

    def chars(x):
        return F.filter(F.split(x, ""), lambda c: c != "")

    def solve(s):
        A, B, D = s["a"], s["b"], s["d"]
        la, lb = F.size(A), F.size(B)
        places = F.sequence(F.lit(0), 2 * D)
        start = F.transform(places, lambda k: F.when((k < D) | (k - D > lb), far).otherwise(k - D))

        def row(prev, i):
            def cell(cur, k):
                j = i - D + k
                up = F.coalesce(F.get(prev, k + 1), far) + 1
                left = F.coalesce(F.get(cur, k - 1), far) + 1
                same = F.when((j >= 1) & (F.get(A, i - 1) == F.get(B, j - 1)), F.get(prev, k)).otherwise(far)
                value = F.when((j < 0) | (j > lb), far).when(j == 0, i).otherwise(F.least(up, left, same))
                return F.concat(cur, F.array(value))
            return F.aggregate(places, F.array().cast("array<int>"), cell)

        last = F.when(la == 0, start).otherwise(F.aggregate(F.sequence(F.lit(1), F.greatest(la, F.lit(1))), start, row))
        return F.coalesce(F.get(last, lb - la + D), far)

    packed = F.struct(chars(a).alias("a"), chars(b).alias("b"), limit.cast("int").alias("d"))
    return F.transform(F.array(packed), solve)[0]


def _passes(d: Column, L: Column, threshold: int) -> Column:
    return (F.lit(100) * (L - d)) >= F.lit(threshold) * L


def _bound(n: Column, threshold: int) -> Column:
    """Largest indel distance a passing partner of a string of length ``n`` can have."""
    r = _rate(threshold)
    return F.floor(F.lit(2 * r / (1 - r)) * n + F.lit(1e-9)).cast("int")


def variant_entries(strings: DataFrame, id_col: str, str_col: str, threshold: int = C.MATCH_THRESHOLD,
                    max_deletions: int = MAX_DELETIONS) -> DataFrame:
    """(id, variant, k, n) of the strings that can have a partner with a bound within the cap: such
    a pair's lengths are within the cap of each other, so longer ones need no variants."""
    n_long = first_long(threshold, max_deletions)
    short = strings if n_long is None else strings.where(F.length(str_col) < n_long + max_deletions)
    return deletion_variants(short, id_col, str_col, threshold, max_deletions, with_length=True)


def gram_entries(strings: DataFrame, id_col: str, str_col: str, threshold: int = C.MATCH_THRESHOLD,
                 max_deletions: int = MAX_DELETIONS) -> DataFrame:
    """(id, m, j, g): every q-gram of a long string with its place."""
    q = piece_length(threshold, max_deletions)
    n_long = first_long(threshold, max_deletions)
    m = F.length(str_col)
    long = strings.where(F.lit(False) if n_long is None else m >= n_long)
    grams = F.transform(F.sequence(F.lit(1), F.greatest(m - q + 1, F.lit(1))), lambda j: F.struct(j.alias("j"), F.substring(str_col, j, F.lit(q)).alias("g")))
    return long.select(id_col, m.alias("m"), F.explode(grams).alias("x")).select(id_col, "m", F.col("x.j").alias("j"), F.col("x.g").alias("g"))


def pairs_with(ls: DataFrame, variants: DataFrame, grams: DataFrame, threshold: int = C.MATCH_THRESHOLD,
               max_deletions: int = MAX_DELETIONS, rs: DataFrame | None = None) -> DataFrame:
    """(_lid, _rid, d, L) of the strings ``ls`` (_lid, _ls) that pass with strings of which the
    entries are given: :func:`variant_entries` and :func:`gram_entries` with id ``_rid``.
    ``rs`` (_rid, _rs) are the strings themselves; without it the ids are the strings."""
    # lengths ride along with the variants, so no join back to the strings is needed
    lv = variant_entries(ls, "_lid", "_ls", threshold, max_deletions).withColumnsRenamed({"k": "_i", "n": "_nl"})
    rv = variants.select("_rid", "variant", F.col("k").alias("_j"), F.col("n").alias("_nr"))
    pairs = (lv.join(rv, "variant")
             .groupBy("_lid", "_rid").agg(F.min(F.col("_i") + F.col("_j")).alias("d"),
                                          F.max("_nl").alias("_nl"), F.max("_nr").alias("_nr")))

    n_long = first_long(threshold, max_deletions)
    if n_long is not None:
        q = piece_length(threshold, max_deletions)
        long_l = ls.where(F.length("_ls") >= n_long).withColumn("_n", F.length("_ls")).withColumn("_D", _bound(F.col("_n"), threshold))
        # piece i of D + 1 starts at floor(i n / (D + 1)) and has at least q characters
        starts = F.transform(F.sequence(F.lit(0), F.col("_D")), lambda i: F.floor(i * F.col("_n") / (F.col("_D") + 1)).cast("int") + 1)
        lg = long_l.select("_lid", "_n", "_D", F.explode(F.transform(starts, lambda i: F.struct(i.alias("i"), F.substring("_ls", i, F.lit(q)).alias("g")))).alias("x")) \
            .select("_lid", "_n", "_D", F.col("x.i").alias("_i"), F.col("x.g").alias("g"))
        rg = grams.select("_rid", "g", F.col("m").alias("_m"), F.col("j").alias("_j"))
        near = (F.abs(F.col("_i") - F.col("_j")) <= F.col("_D")) & (F.abs(F.col("_n") - F.col("_m")) <= F.col("_D"))
        cand = lg.join(rg, "g").where(near).select("_lid", "_rid").distinct().join(ls, "_lid")
        cand = cand.withColumn("_rs", F.col("_rid")) if rs is None else cand.join(rs, "_rid")
        L = F.length("_ls") + F.length("_rs")
        dmax = F.floor(L * F.lit(100 - threshold) / F.lit(100)).cast("int")
        cand = cand.where((F.abs(F.length("_ls") - F.length("_rs")) <= dmax) & (F.levenshtein("_ls", "_rs") <= dmax))
        measured = cand.select("_lid", "_rid", indel_distance(F.col("_ls"), F.col("_rs"), dmax).alias("d"),
                               F.length("_ls").alias("_nl"), F.length("_rs").alias("_nr"))
        pairs = pairs.unionByName(measured).groupBy("_lid", "_rid").agg(
            F.min("d").alias("d"), F.max("_nl").alias("_nl"), F.max("_nr").alias("_nr"))

    L = F.col("_nl") + F.col("_nr")
    return pairs.where(_passes(F.col("d"), L, threshold)).select("_lid", "_rid", F.col("d").cast("int").alias("d"), L.cast("int").alias("L"))


def fuzzy_pairs(left: DataFrame, right: DataFrame, left_id: str, left_str: str,
                right_id: str, right_str: str, threshold: int = C.MATCH_THRESHOLD,
                max_deletions: int = MAX_DELETIONS) -> DataFrame:
    """All (left_id, right_id) whose strings reach the ratio threshold, with the
    exact indel distance ``d`` and total length ``L``.

    Strings are compared as given; callers lower-case them first when the
    comparison is case-insensitive. Ids must be unique per string on each side.
    """
    ls = left.select(F.col(left_id).alias("_lid"), F.col(left_str).alias("_ls")).where(F.length("_ls") > 0)
    rs = right.select(F.col(right_id).alias("_rid"), F.col(right_str).alias("_rs")).where(F.length("_rs") > 0)
    pairs = pairs_with(ls, variant_entries(rs, "_rid", "_rs", threshold, max_deletions),
                       gram_entries(rs, "_rid", "_rs", threshold, max_deletions), threshold, max_deletions, rs)
    return pairs.select(F.col("_lid").alias(left_id), F.col("_rid").alias(right_id), "d", "L")


def best_match(pairs: DataFrame, left_id: str, right_id: str, rank_cols: list) -> DataFrame:
    """Per left id, the right id with the highest ratio; ties go to the smallest
    ``rank_cols`` (e.g. the person's position in the directory).

    The smallest loss per left id is a hash aggregate; only the pairs that reach it (ties)
    are then compared on the rank columns, one at a time: nothing of a left id is gathered.
    """
    loss = F.col("d") / F.col("L")
    least = pairs.groupBy(left_id).agg(F.min(loss).alias("_loss")).withColumnRenamed(left_id, "_left")
    tied = pairs.join(least, (F.col(left_id) == F.col("_left")) & (loss == F.col("_loss")), "left_semi")
    key = F.struct(*[F.col(c) for c in rank_cols], F.col(right_id), F.col("d"), F.col("L"))
    best = tied.groupBy(left_id).agg(F.min(key).alias("_b"))
    return best.select(left_id, *[F.col(f"_b.{c}").alias(c) for c in rank_cols],
                       F.col(f"_b.{right_id}").alias(right_id), F.col("_b.d").alias("d"),
                       F.col("_b.L").alias("L"))


def ratio(d: Column, L: Column) -> Column:
    return F.lit(100.0) * (F.lit(1.0) - d / L)
