"""Components and levels against a plain walk of the graph, on random graphs, chains and rings."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from macroseries.operators import catalog, graph


def frames(spark, nodes, edges):
    return (spark.createDataFrame([(n,) for n in nodes], "node long"),
            spark.createDataFrame(edges, "src long, dst long"))


def components(nodes, edges):
    """(smallest node, size) of each node's component: nodes that reach each other."""
    out, back = defaultdict(list), defaultdict(list)
    for a, b in edges:
        out[a].append(b)
        back[b].append(a)

    def walk(start, step, inside):
        seen, todo = {start}, [start]
        while todo:
            for m in step[todo.pop()]:
                if m in inside and m not in seen:
                    seen.add(m)
                    todo.append(m)
        return seen
    left, got = set(nodes), {}
    while left:
        n = min(left)
        comp = walk(n, out, left) & walk(n, back, left)
        got.update((m, (n, len(comp))) for m in comp)
        left -= comp
    return got


@pytest.mark.parametrize("n, m", [(2, 0), (30, 30), (150, 200)])
def test_components_of_random_graphs(spark, n, m):
    rng = random.Random(n)
    edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
    got = graph.scc(*frames(spark, range(n), edges + edges[:5]))
    assert {r["node"]: (r["comp"], r["size"]) for r in got.collect()} == components(range(n), edges)


def test_components_of_a_chain_and_a_ring_take_few_jobs(spark):
    """Depth 4000; far fewer jobs, since chains are crossed by doubling."""
    n = 4000
    edges = [(k, k + 1) for k in range(n - 1)] + [(n + k, n + (k + 1) % n) for k in range(n)]
    nodes, table = frames(spark, range(2 * n), edges + [(n // 2, n + 7), (3, None), (None, 4)])
    sc = spark.sparkContext
    sc.setJobGroup("chain and ring", "")
    got = graph.scc(nodes, table).groupBy("comp", "size").agg(F.count(F.lit(1)).alias("n"))
    got = {(r["comp"], r["size"]): r["n"] for r in got.collect()}
    jobs = len(sc.statusTracker().getJobIdsForGroup("chain and ring"))
    sc.setJobGroup("", "")
    assert got == {(n, n): n, **{(k, 1): 1 for k in range(n)}}
    assert jobs < n / 10


def test_text_nodes(spark):
    nodes = spark.createDataFrame([(c,) for c in "abcdx"], "node string")
    edges = spark.createDataFrame([tuple(e) for e in ("ab", "bc", "ca", "cd", "dd")], "src string, dst string")
    got = {r["node"]: (r["comp"], r["size"]) for r in graph.scc(nodes, edges).collect()}
    assert got == {"a": ("a", 3), "b": ("a", 3), "c": ("a", 3), "d": ("d", 1), "x": ("x", 1)}


def test_no_round_broadcasts_a_table(spark, monkeypatch):
    """Joins of every round are merge joins: a broadcast would pass the graph through the driver."""
    plans = []
    put, cp = graph.Rounds.put, graph._cp

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df
    monkeypatch.setattr(graph.Rounds, "put", lambda r, name, df: put(r, name, seen(df)))
    monkeypatch.setattr(graph, "_cp", lambda df: cp(seen(df)))
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(80)]
    tables = frames(spark, range(60), edges)
    comps = graph.scc(*tables)
    seen(graph.block_order(*tables, comps))
    seen(graph.in_degree(*tables))
    assert {r["node"]: (r["comp"], r["size"]) for r in comps.collect()} == components(range(60), edges)
    assert any("SortMergeJoin" in p for p in plans)
    assert not [p for p in plans if "BroadcastHashJoin" in p]


def test_edges_and_used_inputs_broadcast_nothing(spark):
    eqs = spark.createDataFrame([("va", "va=0.5*vb+xc"), ("vb", "vb=va(-1)+xd")],
                                "name string, equation string")
    tok = catalog.tokens(eqs)
    edges = catalog.edges(tok, eqs.select("name"))
    used = catalog.used_inputs(spark.createDataFrame([("xc",), ("xe",), (None,)], "name string"), tok)
    assert [tuple(r) for r in edges.collect()] == [("vb", "va")]
    assert [tuple(r) for r in used.collect()] == [("xc",)]
    for df in (edges, used):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
