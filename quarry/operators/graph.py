"""Link graph and bounded BFS.

Edges come from the pages (``href`` values, G2). The page -> href -> page
graph is bipartite: a page links to the hrefs it contains and an href leads
to every page containing it, so pages sharing a link are two hops apart.

Each node keeps only its first ``links_per_page`` sorted out-links (W8),
computed as a per-source top-k (partial/final window limit), so a node with
a huge out-degree never becomes one array or one task's worth of rows.

BFS is multi-source (``query_id`` per start) and level-synchronous: each
level joins the frontier with the capped edges, drops nodes already visited
for that query (anti join), and is checkpointed to the shared checkpoint
folder to cut lineage. Depth is bounded by ``max_depth``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import html as H


def page_links(pages: DataFrame) -> DataFrame:
    """``src (page url), dst (href)``, distinct."""
    return pages.select(F.col("url").alias("src"), F.explode(H.hrefs("html")).alias("dst")).distinct()


def bipartite_edges(links: DataFrame) -> DataFrame:
    """Both directions of page -> href links: ``src, dst``."""
    back = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return links.unionByName(back).distinct()


def capped_edges(edges: DataFrame, links_per_page: int) -> DataFrame:
    """First ``links_per_page`` destinations of each source in sorted order."""
    w = Window.partitionBy("src").orderBy("dst")
    return edges.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= links_per_page).drop("_r")


def bfs(starts: DataFrame, edges: DataFrame, max_depth: int, links_per_page: int,
        nodes: DataFrame | None = None, checkpoint: bool = True) -> DataFrame:
    """``query_id, node, depth`` for every node within ``max_depth``
    hops of the query's start node over the capped edges (depth = BFS level).

    ``nodes`` (a ``node`` column) lists the nodes that exist; a missing node
    is neither returned nor expanded. Default: every node that has edges.
    """
    capped = capped_edges(edges, links_per_page)
    if nodes is not None:
        starts = starts.join(nodes.select("node"), "node", "left_semi")
    visited = starts.select("query_id", "node", F.lit(0).alias("depth"))
    if checkpoint:
        visited = visited.checkpoint()
    frontier = visited
    for d in range(1, max_depth + 1):
        nxt = (frontier.join(capped, frontier.node == capped.src)
                       .select("query_id", F.col("dst").alias("node")).distinct())
        if nodes is not None:
            nxt = nxt.join(nodes.select("node"), "node", "left_semi")
        nxt = nxt.join(visited.select("query_id", "node"), ["query_id", "node"], "left_anti") \
                 .withColumn("depth", F.lit(d))
        if checkpoint:
            nxt = nxt.checkpoint()
        visited = visited.unionByName(nxt)  # a level is written once, never the levels before it
        frontier = nxt
    return visited.withColumn("depth", F.col("depth").cast("long"))


def merge_graphs(*sources: DataFrame, key: str = "title", order_col: str = "ord") -> DataFrame:
    """Union node tables; for a repeated key the later source (and,
    within a source, the row with the larger ``order_col``) wins. A max over
    a struct keyed by (source, order) is a partial/final aggregate, so a key
    repeated by a third of the rows is still combined map-side."""
    tagged = None
    for i, s in enumerate(sources):
        t = s.withColumn("_src", F.lit(i))
        tagged = t if tagged is None else tagged.unionByName(t)
    rest = [c for c in tagged.columns if c not in (key, "_src", order_col)]
    best = tagged.groupBy(key).agg(F.max(F.struct("_src", order_col, *rest)).alias("_b"))
    return best.select(key, *[F.col("_b")[c].alias(c) for c in ["_src", order_col, *rest]]) \
               .withColumnRenamed("_src", "source")
