"""Connected components of a table of links, by smallest label with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.workspace import Workspace


def components(links: DataFrame, workspace: Workspace, name: str = "components") -> DataFrame:
    """(v, component) for each end of the links (a, b); component is the smallest end reachable.

    Every round takes the smallest label among a vertex and its neighbours, then the label of that label,
    and is written, so a lost executor costs one round at most. The labels never reach the driver.
    """
    both = workspace.save(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        f"{name}-links",
    )
    labels = workspace.save(
        both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("v"), F.least("a", "m").alias("component")),
        f"{name}-0",
    )
    step = 0
    while True:
        step += 1
        near = (
            both.join(labels, both["b"] == labels["v"])
            .groupBy(both["a"].alias("u"))
            .agg(F.min("component").alias("m"))
        )
        lowered = labels.join(near, labels["v"] == near["u"]).select(
            "v", F.least("component", "m").alias("low"), F.col("component").alias("was")
        )
        target = labels.select(F.col("v").alias("t"), F.col("component").alias("jump"))
        jumped = lowered.join(target, lowered["low"] == target["t"]).select(
            "v", F.least("low", "jump").alias("component"), (F.least("low", "jump") != F.col("was")).alias("moved")
        )
        saved = workspace.save(jumped, f"{name}-{step}")
        done = not saved.where("moved").limit(1).count()
        workspace.drop(f"{name}-{step - 1}")
        labels = saved.select("v", "component")
        if done:
            workspace.drop(f"{name}-links")
            return labels
