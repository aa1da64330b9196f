"""Connected components against a plain version, and how many turns they take."""

import numpy as np
import pytest

from meterlane import session
from meterlane.llm import components
from meterlane.session import materialize


@pytest.mark.parametrize("pairs, turns", [([(2, 1), (3, 1), (5, 4)], 1), ([(3, 2), (2, 1)], 1), ([], 1), ([(7, 7)], 1)])
def test_components_end_with_the_turn_that_makes_stars(spark, monkeypatch, pairs, turns):
    made = []
    monkeypatch.setattr(components, "materialize", lambda df, label: made.append(label) or materialize(df, label))
    found = components.connected(spark.createDataFrame(pairs, "u long, v long"))
    assert len(made) == turns
    nodes = {n for pair in pairs if pair[0] != pair[1] for n in pair}
    assert {r.node for r in found.collect()} == nodes and found.count() == len(nodes)


def test_components_of_random_graphs(spark):
    draw = np.random.default_rng(11)
    for nodes, edges in ((30, 20), (60, 60), (200, 150)):
        pairs = [(int(a), int(b)) for a, b in draw.integers(0, nodes, (edges, 2))] + [(n, n + 1) for n in range(1000, 1040)]
        root = {n: n for pair in pairs for n in pair if pair[0] != pair[1]}
        changed = True
        while changed:
            changed = False
            for a, b in pairs:
                if a != b and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
        found = components.connected(spark.createDataFrame(pairs, "u long, v long")).collect()
        assert sorted((r.node, r.root) for r in found) == sorted(root.items())


def test_the_plan_of_the_edges_is_not_repeated(spark, monkeypatch):
    """The driver keeps memory for each exchange it plans, and edges may take joins to make."""
    plans = []

    def written(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return materialize(df, label)

    monkeypatch.setattr(components, "materialize", written)
    monkeypatch.setattr(session, "materialize", written)
    ends = spark.range(0, 40, 2).selectExpr("id AS u", "id + 1 AS k")
    edges = ends.join(spark.range(1, 61, 2).selectExpr("id AS k", "id + 1 AS v").hint("merge"), "k").select("u", "v")
    found = components.connected(edges).collect()
    assert {r.node for r in found} == set(range(0, 41, 2)) and {r.root for r in found} == {0}
    assert sum(plan.count("SortMergeJoin [k") for plan in plans) == 1
    assert max(plan.count("Exchange hashpartitioning") for plan in plans) <= 4
