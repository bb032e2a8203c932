"""Connected components of links, by the smallest id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, discard

def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b), the component being its smallest id.

    Each round takes the least label among an id and its neighbours and then
    the label's own label, so long chains halve; it ends when nothing changes.
    """
    both = cut(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "links")
    labels = cut(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("a"), F.min("b")).alias("component")), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), F.col("component").alias("l")), "b").groupBy(F.col("a").alias("id")).agg(F.min("l").alias("l"))
        least = labels.join(near, "id").select("id", F.least("component", "l").alias("component"), F.col("component").alias("old"))
        heads = labels.select(F.col("id").alias("component"), F.col("component").alias("up"))
        moved = cut(least.join(heads, "component", "left").select("id", F.least("component", F.coalesce("up", "component")).alias("component"), "old"), "labels")
        discard(labels)
        labels = moved
        if moved.where("component <> old").isEmpty():
            discard(both)
            return labels.select("id", "component")
