"""Connected components of a link table, as joins and aggregates.

Alternating large-star and small-star steps: each node's neighbours are linked
to the smallest node it sees, until every component is a star around its
smallest member. Before the first step and after each, every task replaces a block
of some ``BLOCK_LINKS`` links by stars with the same components (no shuffle), so that
few steps are left. Edges are de-duplicated in every step, so a
component of k nodes never holds more than its links, and a hub's rows are ordinary
join rows that adaptive execution may split. Each round is written to the shared
folder, which also cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitext.session import written_table

from ._common import map_rows

#: Links that a task contracts together; bounds its memory.
BLOCK_LINKS = 50_000


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, component)`` of every node in ``links(a, b)``; the component is
    the smallest node reachable. Self-links and NULLs are ignored."""
    edges = _contracted(links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    while not _settled(edges):
        edges = _contracted(_small_star(_large_star(edges)))
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return leaves.unionByName(roots).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether each node has one smaller neighbour and no larger one, or none smaller."""
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("up"), F.lit(0).alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(None).cast(edges.schema["v"].dataType).alias("up"),
                     F.lit(1).alias("root")))
    return ends.groupBy("node").agg(F.min("up").alias("lo"), F.max("up").alias("hi"), F.max("root").alias("root")).where(
        "lo < hi OR (lo IS NOT NULL AND root = 1)").isEmpty()


def _contracted(edges: DataFrame) -> DataFrame:
    """The edges of each block of a task as stars around their smallest nodes. Written
    first, so that the small parts left by a shuffle can be read as whole blocks."""
    edges = written_table(edges, "edges")
    tasks = max(1, -(-edges.count() // BLOCK_LINKS))
    kind = edges.schema["u"].dataType.simpleString()

    def make():
        up: dict = {}
        held = 0

        def root(x):
            up.setdefault(x, x)
            while up[x] != x:
                up[x] = x = up[up[x]]
            return x

        def stars():
            nonlocal held
            held = 0
            found = [(x, top) for x, top in ((x, root(x)) for x in up) if x != top]
            up.clear()
            return {"u": [x for x, _ in found], "v": [top for _, top in found]}

        def work(us, vs):
            nonlocal held
            held += len(us)
            for u, v in zip(us, vs):
                a, b = root(u), root(v)
                if a != b:
                    up[max(a, b)] = min(a, b)
            if held >= BLOCK_LINKS:
                yield stars()

        work.flush = lambda: [stars()]
        return work

    return written_table(map_rows(edges.coalesce(tasks), ["u", "v"], f"u {kind}, v {kind}", make), "stars")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u is linked to the smallest node around u."""
    around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return around.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        # u's own link down is what its smaller neighbour's step emits for it
        edges.groupBy("u").agg(F.min("v").alias("v"))).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """The smaller neighbours of u, and u, are linked to the smallest of them."""
    lowest = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()
