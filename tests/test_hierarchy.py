from clipforge.operators.hierarchy import unit_closure


def brute(edges):
    best = {}
    for start in {c for c, _ in edges}:
        seen, at, depth = {}, {start}, 0
        while at:
            depth += 1
            at = {p for c, p in edges if c in at} - set(seen)
            seen |= {p: depth for p in at}
        best |= {(start, p): d for p, d in seen.items()}
    return best


def closure(spark, edges):
    return {(r.unit, r.ancestor): r.depth for r in unit_closure(spark, spark.createDataFrame(edges, "child string, parent string")).collect()}


def test_deep_chain(spark):
    edges = [(f"u{i}", f"u{i + 1}") for i in range(150)]
    got = closure(spark, edges)
    assert len(got) == 150 * 151 // 2 and got[("u0", "u150")] == 150


def test_cycles_and_diamonds(spark):
    assert closure(spark, [("a", "b"), ("b", "a")]) == {("a", "b"): 1, ("b", "a"): 1, ("a", "a"): 2, ("b", "b"): 2}
    edges = [("a", "b"), ("a", "c"), ("b", "d"), ("c", "e"), ("e", "d"), ("d", "f"), ("f", "c"), ("x", "a"), ("a", "b"), ("n", None)]
    assert closure(spark, edges) == brute([e for e in set(edges) if e[1]])


def test_many_units_under_one_root(spark):
    edges = spark.range(1_200_000).selectExpr("cast(id as string) child", "'root' parent")
    assert unit_closure(spark, edges).count() == 1_200_000
