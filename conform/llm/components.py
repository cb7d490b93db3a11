"""Connected components of links between nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conform.llm.tables import stored


def components(links: DataFrame) -> DataFrame:
    """For each node of the links ``a, b`` the least node it is connected to (``node, root``).

    Each round takes the least root among neighbours and then the root of that root,
    so the rounds grow with the logarithm of a chain's length. Each is written down.
    """
    both = links.select("a", "b").unionByName(
        links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    )
    both = stored(both.where("a <> b").distinct(), "links")
    roots = stored(
        both.groupBy("a").agg(F.min("b").alias("_least")).select(
            F.col("a").alias("node"), F.least("a", "_least").alias("root")
        ),
        "roots",
    )
    while True:
        near = (
            both.join(roots.select(F.col("node").alias("b"), F.col("root").alias("_near")), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("_near").alias("_near"))
        )
        moved = stored(
            roots.join(near, "node").select(
                "node", F.least("root", "_near").alias("root"), F.col("root").alias("_was")
            ),
            "moved",
        )
        jumped = moved.join(
            moved.select(F.col("node").alias("_of"), F.col("root").alias("_root")),
            F.col("root") == F.col("_of"),
        ).select("node", F.col("_root").alias("root"), "_was")
        jumped = stored(jumped, "roots")
        if jumped.where("root <> _was").isEmpty():
            return jumped.select("node", "root")
        roots = jumped.select("node", "root")
