"""Connected components of undirected links, by joins on tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from notesight.llm.common import staged


def connect(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """For each of `nodes` (node, rank; distinct nodes, null ranks last) the smallest (rank, node) it reaches over
    `links` (a, b), as columns node, root_rank, root.

    Each round takes the smallest root among a node and its neighbours, then that root's own root, so
    the number of rounds grows with the logarithm of the longest path. No neighbourhood is gathered: minima
    are combined per task before they are shuffled, and each round's table is read back from the shared
    folder, where joins on a root that many nodes share can be split."""
    both = staged(links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct(), "links")
    last = F.lit((1 << 63) - 1)
    roots = staged(nodes.select("node", F.coalesce("rank", last).cast("long").alias("root_rank"), F.col("node").alias("root")), "roots")
    while True:
        told = (
            both.join(roots, both["a"] == roots["node"])
            .groupBy(F.col("b").alias("node"))
            .agg(F.min(F.struct("root_rank", "root")).alias("told"))
        )
        own = F.struct(roots["root_rank"], roots["root"])
        step = staged(
            roots.join(told, "node", "left")
            .select("node", F.least(own, F.coalesce("told", own)).alias("best"), F.col("root").alias("before"))
            .select("node", "best.root_rank", "best.root", (F.col("best.root") != F.col("before")).alias("moved")),
            "roots",
        )
        if not step.filter("moved").limit(1).count():
            return step.drop("moved")
        above = step.filter("root <> node").select(
            F.col("node").alias("root"), F.col("root_rank").alias("up_rank"), F.col("root").alias("up")
        )
        roots = staged(
            step.join(above, "root", "left").select(
                "node", F.coalesce("up_rank", "root_rank").alias("root_rank"), F.coalesce("up", "root").alias("root")
            ),
            "roots",
        )
