"""Connected components of a link table by contraction, all in DataFrames.

Each round every vertex hooks onto its smallest neighbour (or itself), pointer jumps lead
each to its root, and links are rewritten to the new labels; links inside one label
disappear.  Nothing is gathered on the driver but one count and one test per jump; every round's
tables are cut off with a reliable checkpoint, so a lost executor costs no recomputation
of earlier rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from loomkit.session import cut_lineage


#: rows of one partition of the small tables between rounds
ROWS = 100_000


def connected_components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """``links(a, b)`` -> ``(id, label)``: the smallest id reachable, for every linked id.

    With ``rounds`` it stops early: equal labels then still mean connected, different ones
    nothing.  Self links, repeated links and either orientation are fine; nulls are
    dropped.  An empty link table gives an empty result.
    """
    edges = cut_lineage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                        .where("u <> v").distinct())
    labels, done = None, 0
    while done != rounds:
        done += 1
        left = edges.count()
        if not left:
            break
        parts = -(-left // ROWS)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hook = both.groupBy("u").agg(F.min("v").alias("v")).select(
            F.col("u").alias("id"), F.least("u", "v").alias("label"))
        jump = hook
        while True:  # pointers double until every one ends at a root
            up = jump.select(F.col("id").alias("label"), F.col("label").alias("above"))
            hop = cut_lineage(jump.join(up, "label").select("id", "label", "above").coalesce(parts))
            jump = hop.select("id", F.col("above").alias("label"))
            if hop.where("label <> above").isEmpty():
                break
        if labels is None:
            labels = jump
        else:
            step = jump.select(F.col("id").alias("label"), F.col("label").alias("new"))
            labels = cut_lineage(labels.join(step, "label", "left").select(
                "id", F.coalesce("new", "label").alias("label")).coalesce(
                    max(parts, labels.rdd.getNumPartitions())))
        left = jump.select(F.col("id").alias("u"), F.col("label").alias("lu"))
        right = jump.select(F.col("id").alias("v"), F.col("label").alias("lv"))
        edges = cut_lineage(edges.join(left, "u").join(right, "v").where("lu <> lv").select(
            F.greatest("lu", "lv").alias("u"), F.least("lu", "lv").alias("v")).distinct().coalesce(parts))
    if labels is None:
        return edges.select(F.col("u").alias("id"), F.col("v").alias("label"))
    return labels
