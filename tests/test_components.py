from sieveline.operators.components import connected_components


def roots(spark, pairs):
    df = spark.createDataFrame(pairs, "u long, v long")
    return {r.node: r.root for r in connected_components(df).collect()}


def test_chain_and_hub(spark):
    chain = [(i, i + 1) for i in range(1, 40)]
    hub = [(1000, i) for i in range(1001, 1100)]
    got = roots(spark, chain + hub)
    assert all(got[i] == 1 for i in range(1, 41))
    assert all(got[i] == 1000 for i in range(1000, 1100))


def test_nulls_loops_and_none(spark):
    assert roots(spark, [(None, 1), (2, 2), (3, None)]) == {}
    assert roots(spark, [(7, 5), (5, 7), (7, 5)]) == {5: 5, 7: 5}


def test_random_graphs_and_small_chunks(spark, monkeypatch):
    import random

    from sieveline.operators import components

    monkeypatch.setattr(components, "LOCAL_EDGES", 5)
    rng = random.Random(1)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    parent = list(range(300))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert roots(spark, pairs) == {n: find(n) for p in pairs for n in p if p[0] != p[1]}
    words = spark.createDataFrame([("b", "a"), ("c", "b")], "u string, v string")
    assert {r.node: r.root for r in connected_components(words).collect()} == {"a": "a", "b": "a", "c": "a"}
