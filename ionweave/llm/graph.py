"""Connected components of links, by hooking to the lowest neighbour, pointer jumping and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): for each node of the links the lowest id that it is connected with. Links of nulls are left out.

    Each round stores what it made in the shared folder. Aggregates combine on the map side and joins carry no
    aggregate, so a node with very many links is neither gathered in a task nor sent to the driver."""
    edges = stored(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct(), "edges")
    label = None
    while True:
        both = edges.select("a", "b").union(edges.select("b", "a")).toDF("id", "other")
        parent = stored(both.groupBy("id").agg(F.least("id", F.min("other")).alias("parent")), "parents")
        while True:
            up = parent.toDF("parent", "above")
            jumped = stored(parent.join(up, "parent").select("id", F.col("above").alias("parent"), (F.col("above") != F.col("parent")).alias("moved")), "jumped")
            parent = jumped.select("id", "parent")
            if jumped.where("moved").isEmpty():
                break
        if label is None:
            label = parent.withColumnRenamed("parent", "component")
        else:
            moved = parent.toDF("component", "root")
            label = label.join(moved, "component", "left").select("id", F.coalesce("root", "component").alias("component"))
        to_a, to_b = parent.toDF("a", "ra"), parent.toDF("b", "rb")
        mapped = edges.join(to_a, "a").select("ra", "b").join(to_b, "b").where("ra <> rb")
        edges = stored(mapped.select(F.greatest("ra", "rb").alias("a"), F.least("ra", "rb").alias("b")).distinct(), "edges")
        if edges.isEmpty():
            return label
