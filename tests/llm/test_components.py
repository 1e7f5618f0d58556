"""Connected components against a plain union of sets, below and above a task's bound."""

import random

import pytest

from regiocast.llm import components as c


def brute(edges):
    root = {n: n for e in edges for n in e if e[0] != e[1]}
    for _ in root:
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    return root


@pytest.mark.parametrize("bound", [100_000, 7])
def test_equals_brute_force(spark, monkeypatch, bound):
    monkeypatch.setattr(c, "TASK_EDGES", bound)
    rng = random.Random(5)
    path = [(i, i + 1) for i in range(1000, 1040)]
    edges = [(rng.randrange(-60, 60), rng.randrange(-60, 60)) for _ in range(50)] + path * 2
    rng.shuffle(edges)
    found = c.components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()
    assert sorted((r.node, r.root) for r in found) == sorted(brute(edges).items())


def test_no_edges(spark):
    assert c.components(spark.createDataFrame([(3, 3)], "a long, b long")).isEmpty()


def test_few_edges_take_few_jobs(spark):
    """A table that fits one task is solved without rounds of joins."""
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
    context = spark.sparkContext
    context.setJobGroup("few edges", "few edges")
    try:
        assert c.components(edges).where("root <> 0").count() == 0
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert len(context.statusTracker().getJobIdsForGroup("few edges")) <= 12
