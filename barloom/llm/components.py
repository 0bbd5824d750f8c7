"""Connected components of links in Spark, by alternating stars. Nothing goes to the driver."""

from pyspark.sql import DataFrame, functions as F

from barloom.operators.keyed import landed


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Tie the neighbours of every node to its least neighbour: the larger ones, or the others."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if larger else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    tied = both.join(landed(least, "least"), "u")
    if larger:
        return tied.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    # Here u > v: v and u itself go to the least.
    own = least.select("u", F.col("m").alias("v"))
    return tied.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the least node it is tied to.

    Large and small stars in turn, until every node points at the least of its
    component. A node with very many links is reduced in the tasks that read its links;
    the join back to them is one that adaptive execution can split.
    """
    edges = links.filter(F.col("a") != F.col("b"))
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = landed(edges, "edges"), None
    while True:
        edges = landed(_star(edges, larger=True).distinct(), "edges")
        edges = landed(_star(edges, larger=False).distinct(), "edges")
        sums = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")
        now = tuple(edges.agg(F.count("*").alias("n"), sums).first())
        if now == before:
            break
        before = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots)
