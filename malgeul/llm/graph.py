"""Connected components of an edge table by contraction.

Each round hooks every node to the least of its neighbours and itself, follows the hooks one step further, and
replaces the ends of all edges by what they hook to; edges within one node go.  No edge is left when every
component is one node.  A hub has many edges: all joins are between two written tables, so that adaptive execution
splits its partition, and what is counted for a node is aggregated before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from malgeul.llm.common import discard, materialize


def roots(edges: DataFrame, parts: int | None = None) -> DataFrame:
    """``node, label`` for every node of ``edges(a long, b long)`` that has an edge to another one; nodes of a component
    share a label, its least node.  Nodes whose numbers are spread at random take few rounds."""
    now = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges", parts=parts)
    hooks = []
    while now.limit(1).count():
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "hooks", parts=parts)
        up = hook.select(F.col("node").alias("label"), F.col("label").alias("up"))
        hooks.append(materialize(hook.join(up, "label").select("node", F.col("up").alias("label")), "hooks", parts=parts))
        at_a, at_b = (hooks[-1].select(F.col("node").alias(c), F.col("label").alias(f"{c}_to")) for c in "ab")
        moved = now.join(at_a, "a").join(at_b, "b").select(F.greatest("a_to", "b_to").alias("a"), F.least("a_to", "b_to").alias("b"))
        before, now = now, materialize(moved.filter("a <> b").distinct(), "edges", parts=parts)
        discard(before, hook)
    if not hooks:
        return now.select(F.col("a").alias("node"), F.col("b").alias("label"))
    discard(now)
    out = hooks.pop()
    while hooks:  # a node's label is that of what it hooks to, if that has hooked on
        last, own = out, hooks.pop()
        further = last.select(F.col("node").alias("label"), F.col("label").alias("up"))
        out = materialize(own.join(further, "label", "left").select("node", F.coalesce("up", "label").alias("label")), "labels", parts=parts)
        discard(last, own)
    return out


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node that it is connected to, for every node of ``edges(a long, b long)``.

    Self loops count as nodes; nulls are not allowed; repeated edges count once; an empty table gives no rows."""
    ends = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    nodes = materialize(ends.withColumn("spread", F.xxhash64("node")), "nodes")  # of a long, a permutation of all longs
    found = roots(edges.select(F.xxhash64("a").alias("a"), F.xxhash64("b").alias("b"))).withColumnRenamed("node", "spread")
    named = nodes.join(found, "spread", "left").select("node", F.coalesce("label", "spread").alias("root"))
    named = materialize(named, "named")
    least = materialize(named.groupBy("root").agg(F.min("node").alias("label")), "least")
    return named.join(least, "root").select("node", "label")
