import random

from clipforge.operators.fuzzy import deletion_variants, fuzzy_pairs, max_distance_for_length


def lcs(a, b):
    prev = [0] * (len(b) + 1)
    for ca in a:
        cur = [0]
        for j, cb in enumerate(b, 1):
            cur.append(prev[j - 1] + 1 if ca == cb else max(prev[j], cur[j - 1]))
        prev = cur
    return prev[-1]


def brute(L, R, t=95):
    out = set()
    for i, a in L:
        for j, b in R:
            tot = len(a) + len(b)
            d = tot - 2 * lcs(a, b)
            if tot and 100 * (tot - d) >= t * tot:
                out.add((i, j, d))
    return out


def run(spark, L, R):
    l = spark.createDataFrame(L, "lid int, ls string")
    r = spark.createDataFrame(R, "rid int, rs string")
    return {(x.lid, x.rid, x.d) for x in fuzzy_pairs(l, r, "lid", "ls", "rid", "rs").collect()}


def test_boundaries(spark):
    # one letter missing: total length 19 fails, 21 and 39 pass
    cases = [("abcdefghij", "abcdefghi"), ("abcdefghijk", "abcdefghij"),
             ("abcdefghijklmnopqrst", "abcdefghijklmnopqrs"),
             # one letter substituted: total 38 fails, 40 passes (score exactly 95)
             ("abcdefghijklmnopqrs", "abcdefghijklmnopqrz"), ("abcdefghijklmnopqrst", "abcdefghijklmnopqrsz"),
             # three letters missing: total 59 fails, 61 passes
             ("abcdefghijklmnopqrstuvwxyzabcde", "abcdefghijklmnopqrstuvwxyzab"),
             ("abcdefghijklmnopqrstuvwxyzabcdef", "abcdefghijklmnopqrstuvwxyzabc")]
    L = [(i, a) for i, (a, _) in enumerate(cases)]
    R = [(i, b) for i, (_, b) in enumerate(cases)]
    got = {(i, j) for i, j, _ in run(spark, L, R) if i == j}
    assert got == {(1, 1), (2, 2), (4, 4), (6, 6)}


def test_against_brute_force(spark):
    rnd = random.Random(7)
    alpha = "abé"
    base = ["".join(rnd.choice(alpha) for _ in range(rnd.randint(1, 40))) for _ in range(60)]

    def mut(s):
        s = list(s)
        for _ in range(rnd.randint(0, 3)):
            op = rnd.random()
            if op < 0.4 and s:
                s.pop(rnd.randrange(len(s)))
            elif op < 0.8:
                s.insert(rnd.randrange(len(s) + 1), rnd.choice(alpha))
            elif s:
                s[rnd.randrange(len(s))] = rnd.choice(alpha)
        return "".join(s)
    L = list(enumerate(base))
    R = [(i, mut(rnd.choice(base))) for i in range(100)]
    assert run(spark, L, R) == brute(L, R)


def test_bound():
    assert max_distance_for_length(9) == 0
    assert max_distance_for_length(19) == 2
    assert max_distance_for_length(29) == 3


def test_long_names_against_brute_force(spark):
    rnd = random.Random(9)
    word = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    base = [word(n) for n in (28, 29, 30, 31, 40, 57, 58, 90, 130, 400, 400)]
    base += ["van der " * 50, "van der " * 49 + "van den "]

    def mut(s, n):
        s = list(s)
        for _ in range(n):
            i = rnd.randrange(len(s))
            s[i:i + 1] = rnd.choice([[], [s[i], "z"], ["y"]])
        return "".join(s)
    L = list(enumerate(base))
    R = [(i, mut(b, rnd.randint(0, max(2, len(b) // 18)))) for i, b in enumerate(base * 3)]
    assert run(spark, L, R) == brute(L, R)


def test_variants_of_long_strings_are_not_made(spark):
    rows = [(1, "x" * 5000), (2, "y" * 5000)]
    assert run(spark, rows, rows) == {(1, 1, 0), (2, 2, 0)}
    n = deletion_variants(spark.createDataFrame([(1, "abcdefghijklmnopqrstuvwxyzabcd")], "i int, s string"), "i", "s").count()
    assert n == 1 + 30 + 30 * 29 // 2
