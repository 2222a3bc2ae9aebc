"""Connected components: tasks contract what they read, shuffles do the rest."""

import random

import pytest

from reelspark.llm import components


def roots_by_force(edges):
    parent = {x: x for e in edges for x in e}

    def top(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        parent[y] = x
    return {x: top(x) for x in parent}


@pytest.mark.parametrize("tasks,held", [(1, 1 << 19), (7, 1 << 19), (7, 1)])
def test_chain_star_and_random_edges(spark, monkeypatch, tasks, held):
    r = random.Random(tasks + held)
    edges = [(k, k + 1) for k in range(40)] + [(1000 + k, 1000) for k in range(1, 200)] + [(r.randrange(2000, 2200), r.randrange(2200, 2400)) for _ in range(180)] + [(-5, 3000), (3000, -9)]
    r.shuffle(edges)
    monkeypatch.setattr(components, "EDGES", held)
    got = components.components(spark.createDataFrame(edges, "a long, b long").repartition(tasks)).collect()
    assert len(got) == len({x.node for x in got}) and {x.node: x.root for x in got} == roots_by_force(edges)


def test_what_one_task_reads_takes_no_round_of_shuffles(spark, monkeypatch):
    rounds = []
    star = components._star
    monkeypatch.setattr(components, "_star", lambda *a, **k: rounds.append(1) or star(*a, **k))
    edges = spark.createDataFrame([(k, k + 1) for k in range(300)] + [(900, 500), (500, 700)], "a long, b long").coalesce(1)
    got = {x.node: x.root for x in components.components(edges).collect()}
    assert not rounds and got == {k: 0 for k in range(301)} | {500: 500, 700: 500, 900: 500}
    assert components.components(edges.limit(0)).count() == 0 and not rounds
