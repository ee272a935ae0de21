"""Connected components of links between nodes, as a table job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.workspace import materialize


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node it is linked with, for links ``a``, ``b``.

    Each round every node takes the least root among its neighbours and itself, then the root of
    that root; rounds end when no root changes. Each round is written once, so a lost executor
    costs a read. Only counts reach the driver.
    """
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct()
    both = materialize(both, "links")
    roots = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")), "roots")
    while True:
        near = (
            both.join(roots.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        least = roots.join(near, "node").select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("step")
        )
        jump = roots.select(F.col("node").alias("step"), F.col("root").alias("far"))
        stepped = least.join(jump, "step", "left").select(
            "node", "old", F.least("step", F.coalesce("far", "step")).alias("root")
        )
        written = materialize(stepped, "roots")
        roots = written.select("node", "root")
        if written.filter(F.col("root") != F.col("old")).isEmpty():
            return roots
