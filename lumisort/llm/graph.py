"""Connected components of a link table, in Spark joins and partial aggregates.

First every task joins the nodes of the links that it reads into a forest of its own, so that long paths
are short before anything is shuffled; what it sends on are links from nodes to their smallest known
node.  Then every node holds a parent, at first itself.  In each round a node and its parent
both take the smallest grandparent among the node's neighbours, and nodes skip to
their grandparents, until nothing changes; the number of rounds grows with the
logarithm of the longest path.  Nodes with very many links are ordinary rows: each
step is a join with a table of one row per node and a ``min`` that is combined on
the map side.  Each round is checkpointed in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lumisort.llm.common import shared_checkpoint


#: Nodes that a task holds before it sends its forest on.
LOCAL_NODES = 500_000


def local_forests(links: DataFrame) -> DataFrame:
    """(u, v) with the same components as ``links`` (u, v): in every task, each node and the smallest that it is linked
    to by the links seen there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict = {}

        def root(x):
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = parent[up]
                x = up
            return x

        def forest() -> pa.RecordBatch:
            out = [(x, r) for x in list(parent) if (r := root(x)) != x]
            parent.clear()
            return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], kind) for i in (0, 1)], ["u", "v"])

        for b in batches:
            for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                a, c = root(x), root(y)
                if a != c:
                    parent[max(a, c)] = min(a, c)
            if len(parent) > LOCAL_NODES:
                yield forest()
        yield forest()

    kind = to_arrow_type(links.schema["u"].dataType)
    return links.mapInArrow(run, f"u {links.schema['u'].dataType.simpleString()}, v {links.schema['v'].dataType.simpleString()}")


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node that has a link; the component is its smallest node."""
    both = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where(F.col("u") != F.col("v"))
    both = local_forests(both)
    both = shared_checkpoint(both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    # the first round needs no join: the smallest neighbour or oneself
    parent = shared_checkpoint(both.groupBy("u").agg(F.min("v").alias("m"))
                               .select(F.col("u").alias("node"), F.least("u", "m").alias("parent")))
    for _ in range(max_rounds):
        up = parent.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        grand = parent.join(up, "parent").select("node", "parent", "grand")
        near = (both.join(grand.select(F.col("node").alias("v"), F.col("grand").alias("g")), "v")
                .groupBy("u").agg(F.min("g").alias("g")))
        seen = grand.join(near.withColumnRenamed("u", "node"), "node")
        offers = (seen.select("node", F.least("g", "grand").alias("to"))
                  .unionByName(seen.select(F.col("parent").alias("node"), F.col("g").alias("to"))))
        best = offers.groupBy("node").agg(F.min("to").alias("to"))
        now = shared_checkpoint(parent.join(best, "node").select(
            "node", F.least("parent", "to").alias("parent"), (F.col("to") < F.col("parent")).alias("moved")))
        moved = now.where("moved").limit(1).count()
        parent = now.select("node", "parent")
        if not moved:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return parent.select("node", F.col("parent").alias("component"))
