"""Connected components of a graph too large for one task: edges are contracted until none is left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id that occurs in ``edges`` (a, b): the smallest id that it reaches.

    Each round, every vertex takes its smallest neighbour (or itself); the map is flattened by following it
    through itself, the edges are rewritten to the new vertices, and loops and repeats are dropped. Rounds are
    stored in the shared folder, so a lost executor costs one round. No edges give no rows.
    """
    edges = stored(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges"
    )
    found: DataFrame | None = None
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("to"))
        step = stored(step.select("id", F.least("id", "to").alias("to")), "step")
        while True:
            onward = step.select(F.col("id").alias("to"), F.col("to").alias("next")).where("`to` <> next")
            jumped = step.join(onward, "to", "left")
            if onward.join(step, "to", "left_semi").isEmpty():
                break
            step = stored(jumped.select("id", F.coalesce("next", "to").alias("to")), "step")
        moved = step.where("id <> to")
        if found is None:
            found = step.select("id", F.col("to").alias("component"))
        else:
            found = stored(
                found.join(moved.select(F.col("id").alias("component"), "to"), "component", "left").select(
                    "id", F.coalesce("to", "component").alias("component")
                ),
                "components",
            )
        rewritten = edges
        for end in ("a", "b"):
            rewritten = rewritten.join(moved.select(F.col("id").alias(end), "to"), end, "left").select(
                F.coalesce("to", end).alias(end), *[c for c in ("a", "b") if c != end]
            )
        edges = stored(
            rewritten.where("a <> b")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .distinct(),
            "edges",
        )
    if found is None:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return found
