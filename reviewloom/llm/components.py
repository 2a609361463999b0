"""Connected components of a link table, by contraction along smallest neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.session import land


def _roots(edges: DataFrame) -> DataFrame:
    """``node``, ``root``: each node's smallest neighbour (or itself), followed to the end.

    Pointers only go down, so they form trees; each jump halves their depth.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    pointer = land(
        both.groupBy(F.col("u").alias("node")).agg(F.least("node", F.min("v")).alias("root")),
        "pointers",
    )
    while True:
        nxt = pointer.select(F.col("node").alias("__node"), F.col("root").alias("to"))
        jumped = land(pointer.join(nxt, F.col("root") == F.col("__node")).select("node", "root", "to"), "pointers")
        if jumped.where("to <> root").isEmpty():
            return pointer
        pointer = jumped.select("node", F.col("to").alias("root"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id``, ``component``: for each id in a link the smallest id it reaches.

    A round points every node at the root of its tree of smallest neighbours and contracts the
    links to roots; each root left has taken in another node, so rounds are few, on long chains too.
    Groups are only reduced to their minimum, so a hot node combines in the map tasks. Tables are
    landed each round.
    """
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    labels = None
    while True:
        roots = _roots(edges)
        if labels is None:
            labels = roots.select(F.col("node").alias("id"), F.col("root").alias("component"))
        else:
            labels = labels.join(roots, F.col("component") == F.col("node"), "left").select(
                "id", F.coalesce("root", "component").alias("component")
            )
        labels = land(labels, "labels")
        u = roots.select(F.col("node").alias("u"), F.col("root").alias("root_u"))
        v = roots.select(F.col("node").alias("v"), F.col("root").alias("root_v"))
        crossing = edges.join(u, "u").join(v, "v").where("root_u <> root_v")
        edges = land(
            crossing.select(F.col("root_u").alias("u"), F.col("root_v").alias("v")).distinct(), "edges"
        )
        if edges.isEmpty():
            return labels


def merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """``labels`` (``id``, ``component``) after further ``links`` (``a``, ``b``); landed."""
    if labels is None:
        return components(links)
    ends = links
    for end in ("a", "b"):
        own = labels.select(F.col("id").alias("__id"), F.col("component").alias("__c"))
        ends = ends.join(own, F.col(end) == F.col("__id"), "left").withColumn(
            end, F.coalesce("__c", end)
        )
        ends = ends.drop("__id", "__c")
    between = components(land(ends.where("a <> b").distinct(), "between")).select(
        F.col("id").alias("old"), F.col("component").alias("new")
    )
    known = labels.join(between, F.col("component") == F.col("old"), "left").select(
        "id", F.coalesce("new", "component").alias("component")
    )
    fresh = between.join(labels, F.col("old") == F.col("id"), "left_anti").select(
        F.col("old").alias("id"), F.col("new").alias("component")
    )
    return land(known.unionByName(fresh), "labels")
