import random

from tidewatch.llm.components import connected_components


def test_random_graphs_chains_loops_and_nulls(spark):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, 7), (None, 3), (5, None)]
    edges += [(rnd.randrange(200, 300), rnd.randrange(200, 300)) for _ in range(60)]
    edges += [(1000, x) for x in range(1001, 1300)] + [(150, 149), (149, 150)]
    got = {r.node: r.component for r in connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    near = {}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    expected = {}
    for n in near:
        seen, stack = {n}, [n]
        while stack:
            for m in near[stack.pop()] - seen:
                seen.add(m)
                stack.append(m)
        expected[n] = min(seen)
    assert got == expected


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a string, b string")).count() == 0
