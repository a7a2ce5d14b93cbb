import random

import pytest

from tidegate.operators.hierarchy import descendants

SCHEMA = "id int, parent int"


def closure(spark, edges, seeds, **options):
    nodes = spark.createDataFrame(edges, SCHEMA)
    result = descendants(nodes, spark.createDataFrame([(s,) for s in seeds], "id int"), "id", "parent", **options)
    found = [r.id for r in result.collect()]
    assert len(found) == len(set(found))
    return set(found)


def by_hand(edges, seeds):
    ids = {i for i, _ in edges}
    found = frontier = {s for s in seeds if s in ids}
    while frontier:
        frontier = {i for i, p in edges if p in frontier} - found
        found = found | frontier
    return found


@pytest.mark.parametrize("rounds", [0, 6])
def test_cycles_and_orphans(spark, rounds):
    edges = [(1, None), (2, 1), (3, 2), (4, 4), (5, 6), (6, 5), (7, 99)]
    assert closure(spark, edges, [1, 4, 5, 98], level_rounds=rounds) == {1, 2, 3, 4, 5, 6}


@pytest.mark.parametrize("rounds", [0, 2])
def test_deep_chain(spark, rounds):
    edges = [(i, i - 1 if i else None) for i in range(300)]
    assert closure(spark, edges, [40], level_rounds=rounds) == set(range(40, 300))


@pytest.mark.parametrize("seed", range(3))
def test_random_single_parent(spark, seed):
    rng = random.Random(seed)
    edges = [(i, rng.choice([None, rng.randrange(70), rng.randrange(60)])) for i in range(60)]
    seeds = rng.sample(range(60), 4)
    assert closure(spark, edges, seeds, level_rounds=seed) == by_hand(edges, seeds)


@pytest.mark.parametrize("seed", range(2))
def test_random_many_parents(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(70)]
    seeds = rng.sample(range(60), 3)
    assert closure(spark, edges, seeds, level_rounds=1) == by_hand(edges, seeds)


def test_no_seeds(spark):
    assert closure(spark, [(1, None), (2, 1)], []) == set()



def test_deep_graph_with_several_parents(spark):
    edges = [(i, p) for i in range(1, 30) for p in {i - 1, max(0, i - 3)}] + [(0, None)]
    assert closure(spark, edges, [0], level_rounds=2) == set(range(30))
    assert closure(spark, edges, [25], level_rounds=2) == set(range(25, 30))
