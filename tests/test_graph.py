"""Connected components take few rounds."""

import pytest

from linkloom import graph

STAR = [(0, i) for i in range(1, 3001)]
CHAIN = [(i, i + 1) for i in range(5000, 6000)]


@pytest.mark.parametrize(("edges", "most"), [(STAR, 1), (CHAIN, 7), ([(7, 8)], 1), (STAR + CHAIN + [(0, 9000), (9000, 9001)], 8)])
def test_rounds(spark, monkeypatch, edges, most):
    """A star of 3,000 took as many rounds as the logarithm of its size: a hub moved to its first leaf, but a leaf only to the hub."""
    written = []

    def counted(df, label, write=graph.materialize):
        written.append(label)
        return write(df, label)

    monkeypatch.setattr(graph, "materialize", counted)
    found = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {n: 0 if n < 5000 or n >= 9000 else 5000 if n <= 6000 else None for e in edges for n in e} if edges[0] != (7, 8) else found == {7: 7, 8: 7}
    assert written.count("moves") <= most and written.count("labels") <= 1
