"""Connected components of a link table, for graphs of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import stored


def connected_components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """node, component (the least node of it) for every node that occurs in ``links``.

    Each round takes the least label among a node's neighbours and itself, then
    jumps to the label of that label, so long chains need a logarithmic number
    of rounds.  Rounds are written to the shared folder; only one count per round
    comes to the driver.  Null ends are dropped; self-links make a component of one.
    """
    both = links.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    edges = both.select(F.col(a).alias("u"), F.col(b).alias("v")).union(both.select(F.col(b), F.col(a))).distinct()
    edges = stored(edges, "cc-edges")
    labels = stored(edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("l")), "cc-labels")
    for _ in range(max_rounds):
        near = edges.join(labels.toDF("v", "lv"), "v").groupBy("u").agg(F.min("lv").alias("m"))
        step = labels.join(near, "u").select("u", F.least("l", "m").alias("n"), "l")
        jump = step.select(F.col("u").alias("t"), F.col("n").alias("tn"))
        new = step.join(jump, F.col("n") == F.col("t"), "left").select("u", F.least("n", F.coalesce("tn", "n")).alias("n"), "l")
        new = stored(new, "cc-labels")
        labels = new.select("u", F.col("n").alias("l"))
        if new.where("n <> l").isEmpty():
            break
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    return labels.toDF("node", "component")
