import random

from cohort.operators.graph import connected_components


def _cc(spark, nodes, edges):
    n = spark.createDataFrame([(x,) for x in nodes], ["id"])
    e = spark.createDataFrame(edges, ["src", "dst"]) if edges else spark.createDataFrame([], "src string, dst string")
    return {r["id"]: r["component"] for r in connected_components(n, e).collect()}


def test_two_components_and_isolated_node(spark):
    comp = _cc(spark, list("abcdef"), [("a", "b"), ("b", "c"), ("d", "e")])
    assert comp == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "d", "f": "f"}


def test_direction_is_ignored(spark):
    comp = _cc(spark, list("xyz"), [("y", "x"), ("z", "y")])
    assert comp == {"x": "x", "y": "x", "z": "x"}


def test_long_path_converges_past_30_rounds(spark):
    ids = list(range(40))
    random.Random(1).shuffle(ids)
    edges = [(ids[i], ids[i + 1]) for i in range(39)]
    n = spark.createDataFrame([(i,) for i in range(40)], "id long")
    e = spark.createDataFrame(edges, "src long, dst long")
    comp = {r["id"]: r["component"] for r in connected_components(n, e).collect()}
    assert set(comp.values()) == {0}


def test_self_loop_duplicate_and_unknown_endpoint(spark):
    # a-a self loop, duplicate (b,c)/(c,b), and a-q-d where q is not a node
    comp = _cc(spark, list("abcd"), [("a", "a"), ("b", "c"), ("c", "b"), ("a", "q"), ("q", "d")])
    assert comp == {"a": "a", "b": "b", "c": "b", "d": "d"}


def _union_find(n, edges):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return {i: min(j for j in range(n) if find(j) == find(i)) for i in range(n)}


def test_matches_union_find_on_random_graphs(spark):
    rng = random.Random(7)
    for n_nodes, n_edges in [(60, 40), (80, 120), (50, 10)]:
        edges = [(rng.randrange(n_nodes), rng.randrange(n_nodes)) for _ in range(n_edges)]
        n = spark.createDataFrame([(i,) for i in range(n_nodes)], "id long")
        e = spark.createDataFrame(edges, "src long, dst long").repartition(5)
        got = {r["id"]: r["component"] for r in connected_components(n, e).collect()}
        assert got == _union_find(n_nodes, edges)


def test_merge_components_equals_full_recompute(spark):
    from cohort.operators.graph import merge_components
    rng = random.Random(11)
    n_nodes = 120
    old = [(rng.randrange(n_nodes), rng.randrange(n_nodes)) for _ in range(60)]
    new = [(rng.randrange(n_nodes), rng.randrange(n_nodes)) for _ in range(40)]
    n = spark.createDataFrame([(i,) for i in range(n_nodes)], "id long")
    e_old = spark.createDataFrame(old, "src long, dst long")
    e_new = spark.createDataFrame(new, "src long, dst long")
    merged = {r["id"]: r["component"] for r in merge_components(connected_components(n, e_old), e_new).collect()}
    assert merged == _union_find(n_nodes, old + new)
