"""Connected components of an edge table, entirely as Spark joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleetlens.llm.common import stage


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, label (smallest node reachable) for every node of ``edges`` (columns u, v: long).

    Every round a node's label becomes the smallest label among its own and its neighbours', and
    then that label's label: stars collapse at once and chains halve. Labels only fall, the
    smallest node of a component keeps its own, and without a change all of a component's
    labels are equal. Minima are aggregated map-side, so a hub's neighbours never meet in one
    task. Each round is written to the shared folder. Raises if it has not converged.
    """
    both = stage(edges.select("u", "v").union(edges.select("v", "u")).where("u <> v").distinct(), "cc-edges")
    labels = stage(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m"))
                   .select("node", F.least("node", "m").alias("label"), F.lit(True).alias("changed")), "cc-labels")
    for _ in range(max_rounds):
        near = (both.join(labels.select(F.col("node").alias("v"), "label"), "v")
                .groupBy(F.col("u").alias("node")).agg(F.min("label").alias("near")))
        low = labels.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("low"))
        up = low.select(F.col("node").alias("low"), F.col("low").alias("top"))
        labels = stage(low.join(up, "low").select("node", F.col("top").alias("label"), (F.col("top") < F.col("was")).alias("changed")), "cc-labels")
        if not labels.where("changed").limit(1).count():
            return labels.select("node", "label")
    raise RuntimeError(f"components did not converge in {max_rounds} rounds")
