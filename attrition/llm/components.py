"""Distributed connected components by min-label propagation with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.session import drop_table, write_table


def connected_components(links: DataFrame) -> DataFrame:
    """``links(a long, b long)`` → ``(id long, component long)``: the smallest id
    reachable, for every id that has a link.

    Each round gives an id the smallest label among itself and its neighbours,
    then the label of that label (pointer jumping), so a chain of length n takes
    about log n rounds.  A round is two joins and map-side combined minima on
    tables of the links' size; labels are written to the shared folder.  Null
    ids and self links are ignored.
    """
    both = links.where("a <> b").select("a", "b")
    both = write_table(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = write_table(both.groupBy("a").agg(F.min("b").alias("m"))
                         .select(F.col("a").alias("id"), F.least("a", "m").alias("component")), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "component"), "b").groupBy("a").agg(F.min("component").alias("m"))
        stepped = (labels.join(near.withColumnRenamed("a", "id"), "id")
                   .select("id", F.col("component").alias("old"), F.least("component", "m").alias("component")))
        up = labels.select(F.col("id").alias("component"), F.col("component").alias("up"))
        jumped = write_table(stepped.join(up, "component", "left")
                             .select("id", "old", F.least("component", F.coalesce("up", "component")).alias("component")), "labels")
        drop_table(labels)
        labels = jumped
        if not jumped.where("component <> old").limit(1).count():
            drop_table(both)
            return labels.select("id", "component")
