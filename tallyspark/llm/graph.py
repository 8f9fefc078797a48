"""Connected components over a table of links."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` (smallest node that can be reached) of all nodes
    in ``links`` (a, b). Labels take the least of their neighbours' and then
    their label's own label, so paths halve in each round; every round is
    written to the shared folder."""
    both = common.store(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label"))
    labels = common.store(labels, "labels")
    before = None
    while True:
        total = labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        if total == before or total is None:
            return labels
        before = total
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("m"))
        step = labels.join(near, labels.node == near.a).select("node", F.least("label", "m").alias("label"))
        jump = step.select(F.col("node").alias("k"), F.col("label").alias("next"))
        labels = common.store(step.join(jump, step.label == jump.k).select("node", F.col("next").alias("label")), "labels")
