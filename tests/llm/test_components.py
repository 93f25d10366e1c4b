import random

from shelfwise.llm.components import components


def brute(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


def found(spark, edges):
    rows = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    out = {r["node"]: r["component"] for r in rows}
    assert len(out) == len(rows)
    return out


def test_path_star_and_random_graphs(spark):
    rng = random.Random(5)
    path = [(i, i + 1) for i in range(60)]
    rng.shuffle(path)
    star = [(1000, 1000 + i) for i in range(1, 40)]
    loose = [(rng.randrange(-500, 0), rng.randrange(-500, 0)) for _ in range(150)]
    edges = path + star + [(a, b) for a, b in loose if a != b]
    assert found(spark, edges) == brute(edges)


def test_no_edges_and_repeated_edges(spark):
    assert found(spark, []) == {}
    assert found(spark, [(2, 1), (1, 2), (2, 1)]) == {1: 1, 2: 1}
