"""Connected components of a graph given by edges, by alternating star steps on tables.

Neither edges nor labels ever reach the driver. Each round is two joins whose right side, the smallest
neighbour of each node, is written first: a join that reads an aggregate of its own key is not split, this one
is where a node has very many edges. The round's edges are written to the shared folder, which ends the lineage.
"""

from pyspark.sql import functions as F

from ledgerloom.llm.common import staged


def _star(edges, large):
    """Link the larger (else the smaller) neighbours of each node to its smallest one."""
    ends = edges.select("a", "b")
    both = ends.unionByName(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else ends
    least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    least = staged(least, "least")
    linked = both.join(least.hint("merge"), "a")
    if large:
        out = linked.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        out = linked.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select("a", F.col("least").alias("b"))
        )
    return out.where("a <> b").distinct()


def components(edges):
    """(node, root) of each node of the edges (columns a, b), roots included; ``root`` is the smallest node."""
    edges = staged(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges"
    )
    if edges.isEmpty():
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    before = None
    while True:
        edges = staged(_star(staged(_star(edges, True), "stars"), False), "stars")
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.hash("a", "b").cast("long"))
        ).first()
        if now == before:
            break
        before = now
    roots = edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
