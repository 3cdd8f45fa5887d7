"""Connected components of a link table, as Spark joins and aggregates."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import stage

# Rounds, counted from 1, that contract by the order of the nodes; of the later ones every other does.
NATURAL_ROUNDS = 2
# Links that a task ties together at a time.
TIED_LINKS = 200_000


def _tie(batches):
    """Each link's ends, tied to the smallest node that the links read with it reach."""
    def tied(root, schema):
        nodes, roots = list(root), []
        for x in nodes:
            while root[x] != x:
                x = root[x]
            roots.append(x)
        return pa.RecordBatch.from_arrays([pa.array(nodes, schema.field("a").type), pa.array(roots, schema.field("a").type)], names=["a", "b"])

    root, links, schema = {}, 0, None
    for batch in batches:
        schema = batch.schema
        for x, y in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            root.setdefault(x, x), root.setdefault(y, y)
            while root[x] != x:
                root[x] = x = root[root[x]]
            while root[y] != y:
                root[y] = y = root[root[y]]
            if x != y:
                root[max(x, y)] = min(x, y)
        links += batch.num_rows
        if links >= TIED_LINKS:
            yield tied(root, schema)
            root, links = {}, 0
    if root:
        yield tied(root, schema)


def _lowest(edges: DataFrame, turn: int | None) -> DataFrame:
    """(node, low): the least of a node and its neighbours, in the nodes' own
    order or in a random one drawn for this ``turn``. Links read by one task are
    tied together first."""
    ends = edges.mapInArrow(_tie, edges.schema).select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.a", "e.b")

    def rank(name: str) -> Column:
        return F.struct(*([] if turn is None else [F.xxhash64(F.lit(turn), name).alias("h")]), F.col(name).alias("node"))

    return (ends.groupBy(F.col("a").alias("node")).agg(F.min(rank("b")).alias("low"))
            .select("node", F.least("low", rank("node")).getField("node").alias("low")))


def _contracted(edges: DataFrame, low: DataFrame) -> DataFrame:
    """The links between different ``low`` of the ends of ``edges``."""
    return (edges.filter("a != b")
            .join(low.select(F.col("node").alias("a"), F.col("low").alias("x")), "a")
            .join(low.select(F.col("node").alias("b"), F.col("low").alias("y")), "b")
            .filter("x != y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for the undirected links (a, b): ``root`` is the smallest
    node of the component. Self-links make a component of one node; rows with
    a null end are ignored. Nodes may be of any ordered type.

    Contraction: every node is merged into the least of itself and its
    neighbours, and only links between the merged nodes go on, until none are
    left. Tasks tie the links they read, so links that fit one task need one round;
    orders drawn at random keep the rounds few on any graph. The low tables are staged, so that a join
    on them may split a hub's rows over tasks; no neighbour list is ever gathered.
    """
    edges = stage(links.filter("a is not null and b is not null").select("a", "b"), "cc-links")
    lows, turns = [], 0
    while True:
        turns += 1
        natural = turns <= NATURAL_ROUNDS or turns % 2 == 0
        lows.append(stage(_lowest(edges, None if natural else turns), "cc-low"))
        edges = stage(_contracted(edges, lows[-1]), "cc-edges")
        if edges.isEmpty():
            break
    roots = lows.pop().withColumnRenamed("low", "root")
    while lows:  # the last tables are the smallest
        roots = (lows.pop().join(roots.select(F.col("node").alias("low"), "root"), "low", "left")
                 .select("node", F.coalesce("root", "low").alias("root")))
    if turns <= NATURAL_ROUNDS:
        return roots
    roots = stage(roots, "cc-roots")
    least = stage(roots.groupBy("root").agg(F.min("node").alias("least")), "cc-least")
    return roots.join(least, "root").select("node", F.col("least").alias("root"))
