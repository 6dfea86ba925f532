"""Sharding by a k-d tree: nodes are split at distributed weighted medians along their widest
dimension until each holds its share of the bytes.

A row's place along a dimension is a 64-bit key: the dimension's value, then a hash of the text, then
a hash of the id and of the row's position in the table, so equal texts are neighbours and a hot value
can still be cut, even one of rows that repeat a document. The weighted
median of all nodes of a level is found by radix selection: four aggregations of at most 65,536 bins
a node, whatever the number of rows. A cut moves to the border of its group of equal texts when that
costs at most ``SNAP`` of the node's bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from macroseries.llm.common import number_rows, write_once

DIGIT, DIGITS = 16, 4
SNAP = 0.0005


@dataclass
class Node:
    """``leaves`` shards from ``first`` on; ``cut`` (dimension, largest key on the left) if split."""
    first: int
    leaves: int
    cut: tuple[str, int] | None = None
    left: Node | None = None
    right: Node | None = None


def _key(dim: str) -> Column:
    """Dimension value (0 .. 2**31 - 1), 16 bits of the text's hash, 16 bits of the row's."""
    return (F.shiftleft(F.col(dim), 32) + F.shiftleft(F.col("tie_text"), 16) + F.col("tie_id"))


def _leaf(node: Node) -> Column:
    """The first shard of the lowest node a row falls in."""
    if node.cut is None:
        return F.lit(node.first)
    dim, key = node.cut
    return F.when(_key(dim) <= F.lit(key), _leaf(node.left)).otherwise(_leaf(node.right))


def _open(node: Node) -> list[Node]:
    if node.cut is None:
        return [node] if node.leaves > 1 else []
    return _open(node.left) + _open(node.right)


def build(rows: DataFrame, dims: list[str], leaves: int) -> Node:
    """The tree over ``rows`` (size, tie_text, tie_id and the dimensions)."""
    root = Node(0, leaves)
    full: dict[str, int] = {}
    while todo := _open(root):
        at = rows.withColumn("node", _leaf(root)).filter(
            F.col("node").isin([n.first for n in todo]))
        stats = {r["node"]: r for r in at.groupBy("node").agg(
            F.sum("size").alias("w"), *[f(d).alias(f"{a}_{d}") for d in dims
                                        for a, f in (("lo", F.min), ("hi", F.max))]).collect()}
        if not full:
            full = {d: max(1, stats[0][f"hi_{d}"] - stats[0][f"lo_{d}"]) if stats else 1
                    for d in dims}
        dim, want, weight = {}, {}, {}
        for n in todo:
            r = stats.get(n.first)
            weight[n.first] = r["w"] if r else 0
            want[n.first] = weight[n.first] * (n.leaves // 2) / n.leaves
            dim[n.first] = max(dims, key=lambda d: (
                (r[f"hi_{d}"] - r[f"lo_{d}"]) / full[d] if r else 0, -dims.index(d)))
        cuts = _medians(at, dim, want, weight)
        for n in todo:
            half = n.leaves // 2
            n.cut = (dim[n.first], cuts.get(n.first, -1))
            n.left, n.right = Node(n.first, half), Node(n.first + half, n.leaves - half)
    return root


def _pick(column: str, of: dict[int, object]) -> Column:
    out = None
    for node, v in of.items():
        c = F.lit(v) if not isinstance(v, Column) else v
        out = F.when(F.col(column) == node, c) if out is None else out.when(
            F.col(column) == node, c)
    return out


def _medians(at: DataFrame, dim: dict[int, str], want: dict[int, float],
             weight: dict[int, int]) -> dict[int, int]:
    """Per node, the key up to which the rows weigh ``want``, as nearly as one row allows."""
    keyed = at.select("node", "size", _pick("node", {n: _key(d) for n, d in dim.items()})
                      .alias("key"))
    prefix = dict.fromkeys(dim, 0)
    below = dict.fromkeys(dim, 0)
    order = Window.partitionBy("node").orderBy("digit")
    for k in range(DIGITS):
        shift = 64 - DIGIT * (k + 1)
        part = keyed if k == 0 else keyed.filter(
            F.shiftright("key", shift + DIGIT) == _pick("node", prefix))
        hist = (part.groupBy("node", F.shiftright("key", shift).bitwiseAND(F.lit((1 << DIGIT) - 1))
                             .alias("digit")).agg(F.sum("size").alias("w")))
        run = hist.withColumn("upto", F.sum("w").over(order)).withColumn(
            "need", _pick("node", {n: float(want[n] - below[n]) for n in dim}))
        hit = run.filter("upto >= need").groupBy("node").agg(
            F.min(F.struct("digit", "upto", "w")).alias("v"))
        for r in hit.collect():
            n = r["node"]
            prefix[n] = (prefix[n] << DIGIT) + r["v"]["digit"]
            below[n] += r["v"]["upto"] - r["v"]["w"]
    # the key reached; or the last before it, or a border of its group of equal texts, if as good
    low = {n: (p >> DIGIT) << DIGIT for n, p in prefix.items()}
    key, lo = _pick("node", prefix), _pick("node", low)
    got = keyed.groupBy("node").agg(
        F.sum(F.when(F.col("key") <= key, F.col("size"))).alias("upto"),
        F.sum(F.when(F.col("key") < key, F.col("size"))).alias("under"),
        F.sum(F.when(F.col("key") < lo, F.col("size"))).alias("before"),
        F.sum(F.when(F.col("key") < lo + (1 << DIGIT), F.col("size"))).alias("through")).collect()
    out = {}
    for r in got:
        n = r["node"]
        miss = {c: abs((r[c] or 0) - want[n]) for c in ("upto", "under", "before", "through")}
        best = min(("upto", "under"), key=miss.get)
        group = min(("before", "through"), key=miss.get)
        if miss[group] <= max(miss[best], SNAP * weight[n]):
            best = group
        out[n] = {"upto": prefix[n], "under": prefix[n] - 1, "before": low[n] - 1,
                  "through": low[n] + (1 << DIGIT) - 1}[best]
    return out


def shard(docs: DataFrame, target_bytes: int | None = None, shards: int = 16) -> DataFrame:
    """Put every row of ``docs`` (doc_id, text) into a shard: doc_id, size (UTF-8 bytes plus 1, a
    NULL text has none), text_crc32, shard, slot (gapless from 0 in each shard).

    Dimensions are the size (on a log scale) and the text's checksum. With ``target_bytes`` the
    number of shards is the total by it. A NULL id hashes like a value of its own; rows that repeat a
    document are placed each, in several shards where one can't hold them; which of them goes where
    depends on the order of the table; an empty table gives an empty result; extra columns are ignored."""
    raw = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (F.octet_length(raw) + 1).cast("long").alias("size"),
                       F.crc32(raw).alias("text_crc32"))
    rows = rows.withColumn("dim_size", (F.log2("size") * (1 << 25)).cast("long"))
    rows = rows.withColumn("dim_text", F.shiftright(F.col("text_crc32"), 1))
    rows = rows.withColumn("tie_text", F.col("text_crc32").bitwiseAND(F.lit(0xFFFF)))
    # the position is fixed once the sizes are written
    rows = rows.withColumn("tie_id", F.xxhash64("doc_id", F.monotonically_increasing_id())
                           .bitwiseAND(F.lit(0xFFFF)))
    rows = write_once(rows, "sizes")
    if target_bytes:
        total = rows.agg(F.sum("size")).first()[0] or 0
        shards = max(1, round(total / target_bytes))
    tree = build(rows, ["dim_size", "dim_text"], shards)
    placed = rows.select("doc_id", "size", "text_crc32", _leaf(tree).cast("int").alias("shard"))
    return number_rows(placed, ["shard"], ["text_crc32", "doc_id"], "slot")
