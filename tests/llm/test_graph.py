import random

import pytest

from brute import Classes
from feedweave.llm import graph


def edges_of(seed):
    """A chain, a hub with many leaves, random links, repeats, both directions, loops and nulls."""
    rnd = random.Random(seed)
    chain = list(range(1000, 1060))
    rnd.shuffle(chain)
    edges = list(zip(chain, chain[1:])) + [(2000, i) for i in range(1900, 2100)] + [(3000 + i, 3000) for i in range(40)]
    edges += [(rnd.randrange(200), rnd.randrange(200)) for _ in range(130)] + [(-5, 7), (7, -5), (-9, -5)]
    edges += edges[::7] + [(b, a) for a, b in edges[::5]] + [(5000, 5000), (None, 1), (2, None)]
    rnd.shuffle(edges)
    return edges


def wanted(edges):
    real = [(a, b) for a, b in edges if a is not None and b is not None and a != b]
    classes = Classes({i for e in real for i in e})
    for a, b in real:
        classes.link(a, b)
    return {i: classes.find(i) for i in classes.parent}


@pytest.mark.parametrize("seed", [0, 1])
def test_components_are_those_of_union_and_find(table, seed):
    edges = edges_of(seed)
    found = graph.components(table(edges, "a long, b long")).collect()
    assert len(found) == len({r.id for r in found}) and {r.id: r.component for r in found} == wanted(edges)


def test_few_rounds_give_parts_of_components(table):
    edges = edges_of(2)
    whole = wanted(edges)
    for rounds in (1, 2):
        found = graph.components(table(edges, "a long, b long"), rounds=rounds).collect()
        assert len(found) == len({r.id for r in found}) and {r.id for r in found} == set(whole)
        part = {r.id: r.component for r in found}
        assert all(whole[i] == whole[c] for i, c in part.items())


def test_rounds_broadcast_nothing_and_the_result_is_read(table, monkeypatch):
    plans, stage = {}, graph.stage

    def watched(df, label, folder=None):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return stage(df, label, folder)

    monkeypatch.setattr(graph, "stage", watched)
    found = graph.components(table(edges_of(3), "a long, b long"))
    rounds = [plan for label, plan in plans.items() if label.isdigit() and label != "0"]
    assert len(rounds) > 1
    # However small the sides are: the driver holds two megabytes or more for each that is broadcast.
    assert all("Broadcast" not in plan and plan.count("FileScan") <= 4 for plan in rounds)
    read = found._jdf.queryExecution().executedPlan().toString()
    assert read.count("FileScan") == 1 and "Exchange" not in read
