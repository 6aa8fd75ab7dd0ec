"""Connected components of a graph of whole-number nodes, as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightrank.session import written_once


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a, b``): the smallest node it reaches.

    Every round takes the smallest root among a node and its neighbours, then
    the root of that root, so long chains shrink by halves. A round is written
    to the shared folder and the rounds end when one changes nothing. The
    minimum is taken map-side, so a node with a large share of the edges sends
    one row per task.
    """
    one_way = edges.filter("a <> b").select("a", "b")
    both = one_way.unionByName(one_way.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = written_once(both.distinct(), "links")
    roots = written_once(
        links.groupBy("a").agg(F.min("b").alias("b")).select(
            F.col("a").alias("node"), F.least("a", "b").alias("root")
        ),
        "roots",
    )
    while True:
        around = links.join(roots.withColumnRenamed("node", "b"), "b").groupBy("a").agg(
            F.min("root").alias("near")
        )
        near = roots.join(around, roots["node"] == around["a"]).select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("via")
        )
        # The root of the root; one of the table's own nodes, so the join finds it.
        heads = roots.select(F.col("node").alias("via"), F.col("root").alias("head"))
        moved = written_once(
            near.join(heads, "via").select("node", "old", F.least("via", "head").alias("root")),
            "roots",
        )
        roots = moved.select("node", "root")
        if moved.filter("old <> root").isEmpty():
            return roots
