"""What a task holds, or a job moves, does not grow faster than the tables."""

from __future__ import annotations

import pytest

from brightloom.operators import graph
from brightloom.session import partitions_for


def test_page_rank_has_a_task_for_so_many_links(spark, monkeypatch):
    """F11."""
    pairs = [(i, (7 * i + j) % 50) for i in range(50) for j in range(4)]
    edges, seen, made = spark.createDataFrame(pairs, "src long, dst long"), [], graph.bucketed

    def counted(df, name, *keys):
        seen.append(int(spark.conf.get("spark.sql.shuffle.partitions")))
        return made(df, name, *keys)

    monkeypatch.setattr(graph, "bucketed", counted)
    few = {r["id"]: r["rank"] for r in graph.page_rank(edges, 3).collect()}
    many = {r["id"]: r["rank"] for r in graph.page_rank(edges, 3, per_task=10).collect()}
    assert many == pytest.approx(few) and seen == [8, 20]
    with partitions_for(spark, 0) as n:
        assert n == 8
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
