"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from aduana.llm.common import written


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root (the smallest node reachable) for every node of an edge.

    Each round hooks every node's larger neighbours to its smallest neighbour, then its smaller neighbours likewise,
    until no edge changes; a component of diameter d takes about log(d) rounds, and a node with many neighbours sends
    one partial minimum per map task. Edges between rounds are written to the shared folder.
    """
    current = written(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct(), "edges")
    signature = None
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(smallest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").select(
            F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        current = written(small.select("e.u", "e.v").where("u != v").distinct(), "edges")
        row = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (row[0], row[1]) == signature:
            break
        signature = (row[0], row[1])
    roots = current.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    tops = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return written(roots.unionByName(tops), "components")
