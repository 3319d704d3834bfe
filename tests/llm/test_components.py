import random

from quarterlens.llm.components import connected_components
from tests.llm.helpers import components


def test_random_graph_chain_star_loops_and_nulls(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    pairs += [(1000 + i, 1001 + i) for i in range(60)]            # a chain
    pairs += [(2000 - i, 5000) for i in range(80)]                # a star with a large centre
    pairs += [(7, 7), (3, 4), (3, 4), (4, 3)]
    rows = [(a, b) for a, b in pairs] + [(None, 1), (1, None)]
    got = dict(map(tuple, connected_components(
        spark.createDataFrame(rows, "x long, y long"), "x", "y").collect()))
    want = components(5001, pairs)
    in_edges = {v for a, b in pairs if a != b for v in (a, b)}
    assert got == {v: want[v] for v in in_edges}


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0
