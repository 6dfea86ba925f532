"""Dependency graphs as edge tables.

A graph is ``nodes(node)`` and ``edges(src, dst)``.  The iterative algorithms run a driver loop of
joins.  Every round is written to the shared ``spark.checkpoint.dir`` (never a local checkpoint: an
executor may be lost), and components delete the rounds they are done with; each round's stop test
is one tiny action.  Neither one task nor the driver ever holds a graph: joins are merge joins at
every size (:func:`_join`), since a broadcast passes through the driver, and rounds times joins of
them add up to several times the graph.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Rounds, checkpoint_dir


def _cp(df: DataFrame) -> DataFrame:
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """A join that is never turned into a broadcast, however small a side looks."""
    return left.join(right.hint("merge"), on, how)


def in_degree(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(node, in_degree)``, zero for nodes without incoming edges (A4)."""
    cnt = edges.groupBy(F.col("dst").alias("node")).agg(F.count(F.lit(1)).alias("in_degree"))
    return _join(nodes.select("node"), cnt, "node", "left") \
        .select("node", F.coalesce("in_degree", F.lit(0)).cast("long").alias("in_degree"))


def _clean(edges: DataFrame) -> DataFrame:
    return edges.select("src", "dst").dropna().distinct()


def topo_levels(nodes: DataFrame, edges: DataFrame,
                compact_every: int = 8) -> DataFrame:
    """Peel nodes of in-degree 0 round after round (E4): ``(node, level)``.

    ``level`` is the round a node was peeled in (= longest path from a
    source); nodes in a cycle, or downstream of one, are never peeled and
    get NULL.  Each round writes only its layer; the remaining graph is the
    original minus the layers, compacted to a checkpoint every
    ``compact_every`` rounds so plans stay small.
    """
    rn = _cp(nodes.select("node").distinct())
    re = _cp(edges.select("src", "dst").distinct())
    layers, pending = [], []
    for k in count():
        cur_n, cur_e = rn, re
        for z in pending:
            cur_n = _join(cur_n, z.select("node"), "node", "left_anti")
            cur_e = _join(cur_e, z.select(F.col("node").alias("src")), "src", "left_anti")
        fed = cur_e.select(F.col("dst").alias("node")).distinct()
        zero = _cp(_join(cur_n, fed, "node", "left_anti").withColumn("level", F.lit(k)))
        if zero.isEmpty():
            break
        layers.append(zero)
        pending.append(zero)
        if len(pending) >= compact_every:
            rn, re = _cp(_join(cur_n, zero.select("node"), "node", "left_anti")), _cp(
                _join(cur_e, zero.select(F.col("node").alias("src")), "src", "left_anti"))
            pending = []
    out = nodes.select("node").distinct()
    if not layers:
        return out.withColumn("level", F.lit(None).cast("int"))
    lv = layers[0]
    for z in layers[1:]:
        lv = lv.unionByName(z)
    return _join(out, lv, "node", "left")


def _smallest_labels(r: Rounds, e: DataFrame, nodes: DataFrame, name: str) -> DataFrame:
    """``(way, node, label)``: the smallest label of a node that reaches ``node`` (way 0) and of one
    that ``node`` reaches (way 1), along ``e``.  ``nodes`` has ``(node, label)``, labels are unique
    structs that end with their node.

    Every round, nodes whose label changed send it along their edges.  And since whoever reaches the
    node a label names reaches all that carry it, a label is also replaced by its own node's label
    (pointer jumping), which about doubles the distance that labels have come in every round.
    """
    both = e.select(F.lit(0).alias("way"), "src", "dst").unionByName(
        e.select(F.lit(1).alias("way"), F.col("dst").alias("src"), F.col("src").alias("dst")))
    state = r.put(f"{name}-0", nodes.withColumn("way", F.explode(F.array(F.lit(0), F.lit(1))))
                  .select("way", "node", "label", F.lit(True).alias("changed")))
    for k in count(1):
        changed = state.filter("changed").select("way", "node", "label")
        sent = _join(both, changed.withColumnRenamed("node", "src"), ["way", "src"]).select(
            "way", F.col("dst").alias("node"), "label")
        ahead = state.select("way", F.col("node").alias("at"), "label", F.col("changed").alias("news"))
        jumped = _join(state.select("way", "node", F.col("label.node").alias("at"), "changed"),
                       ahead, ["way", "at"]).filter("changed OR news")
        every = state.select("way", "node", "label", F.col("label").alias("own"))
        for more in (sent, jumped):
            every = every.unionByName(more.select("way", "node", "label"), allowMissingColumns=True)
        # labels and messages meet in one exchange, with partial minima before it
        state = r.put(f"{name}-{k}", every.groupBy("way", "node").agg(
            F.min("label").alias("label"), F.max("own").alias("own")).select(
            "way", "node", "label", (F.col("label") < F.col("own")).alias("changed")))
        r.drop(f"{name}-{k - 1}")
        if state.filter("changed").isEmpty():
            return state


def _shorten(r: Rounds, e: DataFrame, name: str) -> DataFrame:
    """``e`` without what hangs from a node that nothing reaches by a chain, and with shortcuts.

    A chain is a run of nodes with one incoming edge each.  Pointers to the node 1, 2, 4, ... steps
    up the chain are found by doubling, in as many rounds as the longest chain's logarithm.  Each
    pointer becomes an edge, which changes no component (its ends are connected anyway), and lets
    labels cross a chain or ring in logarithmic rounds.  A chain below a node without incoming edges
    lies on no cycle and goes at once."""
    into = e.groupBy("dst").agg(F.count(F.lit(1)).alias("n"), F.min("src").alias("up"))
    one = r.put(f"{name}-chain-0", into.filter("n = 1").select(F.col("dst").alias("node"), "up",
                                                               F.lit(True).alias("more")))
    out, steps = e, one.count()
    chain, k = one, 0
    while steps and (1 << k) < 2 * steps:
        ahead = chain.select(F.col("node").alias("up"), F.col("up").alias("next"))
        k += 1
        chain = r.put(f"{name}-chain-{k}", _join(chain, ahead, "up", "left").select(
            "node", F.coalesce("next", "up").alias("up"), F.col("next").isNotNull().alias("more")))
        more = chain.filter("more")
        if more.isEmpty():
            break
        out = out.unionByName(more.select(F.col("up").alias("src"), F.col("node").alias("dst")))
    # a pointer that can't move on has come to the top of its chain
    tops = _join(chain, e.select(F.col("dst").alias("up")).distinct(), "up", "left_anti").select("node")
    for c in ("src", "dst"):
        out = _join(out, tops.withColumnRenamed("node", c), c, "left_anti")
    out = r.put(f"{name}-short", out.select("src", "dst").filter(F.col("src") != F.col("dst")).distinct())
    r.drop(*[f"{name}-chain-{j}" for j in range(k + 1)])
    return out


def scc(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Strongly connected components (E5): ``(node, comp, size)`` for every node; ``comp`` is the
    smallest node of the component.

    Every iteration gives the nodes a new random order (a hash) and finds, for each node at once, the
    first node that reaches it and the first node it reaches.  Nodes of one component agree in both.
    Where the two are the same node, it reaches the node and is reached by it: so all first nodes are
    pivots of one iteration and their components are settled.  Edges between nodes that disagree lie
    in no component and go, as do edges from nodes nothing reaches and to nodes that reach nothing.
    What is left falls apart at random places, so few iterations are needed, and shortcuts along
    chains (both ways) and pointer jumping keep their rounds far below the depth of the graph.
    """
    r = Rounds(nodes.sparkSession, "scc")
    every = nodes.select("node").distinct()
    e = r.put("down-0", _clean(edges).filter(F.col("src") != F.col("dst")))
    for name in ("up", "edges-0"):
        # the second time along the reversed edges, which turns them back
        short = _shorten(r, e, name)
        e = r.put(name, short.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        r.drop(f"{name}-short")
    r.drop("down-0", "up")
    settled = None
    for k in count(1):
        ends = _join(e, e.select(F.col("dst").alias("src")).distinct(), "src", "left_semi")
        ends = _join(ends, e.select(F.col("src").alias("dst")).distinct(), "dst", "left_semi")
        live = r.put(f"live-{k}", ends.select("src", "dst"))
        if live.isEmpty():
            break
        v = live.select(F.col("src").alias("node")).union(live.select("dst")).distinct()
        labels = _smallest_labels(r, live, v.withColumn(
            "label", F.struct(F.xxhash64(F.col("node"), F.lit(k)).alias("rank"), "node")), f"label-{k}")
        pair = r.put(f"pair-{k}", labels.groupBy("node").agg(
            *[F.max(F.when(F.col("way") == w, F.col("label.node"))).alias(c)
              for w, c in ((0, "first"), (1, "last"))]))
        same = pair.filter(F.col("first") == F.col("last"))
        r.add("settled", same.select("node", F.col("first").alias("root")))
        settled = r.get("settled", f"node {(t := v.schema['node'].dataType.simpleString())}, root {t}")
        left = pair.filter(F.col("first") != F.col("last"))
        at_src, at_dst = (left.select(F.col("node").alias(c), F.col("first").alias(f"first_{c}"),
                                      F.col("last").alias(f"last_{c}")) for c in ("src", "dst"))
        e2 = r.put(f"edges-{k}", _join(_join(live, at_src, "src"), at_dst, "dst").filter(
            (F.col("first_src") == F.col("first_dst")) & (F.col("last_src") == F.col("last_dst")))
            .select("src", "dst"))
        r.drop(f"edges-{k - 1}", f"live-{k}", f"pair-{k}")
        e = e2
    if settled is None:
        return every.select("node", F.col("node").alias("comp"), F.lit(1).cast("long").alias("size"))
    comps = settled.groupBy("root").agg(F.min("node").alias("comp"), F.count(F.lit(1)).alias("size"))
    comps = _join(settled, comps, "root").select("node", "comp", "size")
    return _join(every, comps, "node", "left").select(
        "node", F.coalesce("comp", "node").alias("comp"),
        F.coalesce("size", F.lit(1).cast("long")).alias("size"))


def smallest_source_component(nodes: DataFrame, edges: DataFrame, comps: DataFrame,
                              levels: DataFrame) -> DataFrame:
    """The smallest simultaneous block with no edge from outside it (E6, O3),
    in the graph left after peeling (nodes without a level); ties go to the
    smallest component id.  ``(node, comp, size)`` of that block."""
    rest = levels.filter(F.col("level").isNull()).select("node")
    big = _join(comps.filter(F.col("size") > 1), rest, "node", "left_semi")
    e = _join(edges, rest.select(F.col("node").alias("src")), "src", "left_semi")
    ce = _join(e, comps.select(F.col("node").alias("src"), F.col("comp").alias("cs")), "src")
    ce = _join(ce, comps.select(F.col("node").alias("dst"), F.col("comp").alias("cd")), "dst")
    fed = ce.filter(F.col("cs") != F.col("cd")).select(F.col("cd").alias("comp")).distinct()
    src_blocks = _join(big.select("comp", "size").distinct(), fed, "comp", "left_anti")
    best = src_blocks.agg(F.min_by("comp", F.struct("size", "comp")).alias("comp"))
    # one row, the smallest block's: the only broadcast
    return big.join(F.broadcast(best), on="comp", how="left_semi").select("node", "comp", "size")


def block_order(nodes: DataFrame, edges: DataFrame, comps: DataFrame | None = None) -> DataFrame:
    """Order of blocks (E7): ``(node, block, block_level, simultaneous)``.

    Every strongly connected component is a block (a single node otherwise);
    ``block_level`` is the longest path to the block in the condensation,
    so solving blocks level by level respects every edge.  A valid order,
    not the reference's tie order.
    """
    comps = comps if comps is not None else scc(nodes, edges)
    c = comps.select("node", "comp", "size")
    ce = _join(edges, c.select(F.col("node").alias("src"), F.col("comp").alias("s")), "src")
    ce = _join(ce, c.select(F.col("node").alias("dst"), F.col("comp").alias("d")), "dst") \
        .filter(F.col("s") != F.col("d")) \
        .select(F.col("s").alias("src"), F.col("d").alias("dst")).distinct()
    lv = topo_levels(c.select(F.col("comp").alias("node")).distinct(), ce)
    return _join(c, lv.select(F.col("node").alias("comp"), F.col("level").alias("block_level")),
                 "comp").select("node", F.col("comp").alias("block"), "block_level",
                                    (F.col("size") > 1).alias("simultaneous"))


__all__ = ["in_degree", "topo_levels", "scc", "smallest_source_component", "block_order"]
