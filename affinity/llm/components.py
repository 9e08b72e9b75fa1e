"""The smallest id that each node reaches over links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.operators.graph import connected_components
from affinity.sources.scratch import materialize


def smallest_reachable(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """(fp, component_id, component) for each of ``nodes`` (fp, least), over ``links`` (src, dst) between fingerprints.

    component_id is the smallest ``least`` of the component, which another one
    may share; component, its smallest fp, belongs to it alone. Only linked
    nodes enter the rounds; the rest are their own component.
    """
    part = materialize(connected_components(links).select(F.col("id").alias("fp"), "component"), "components")
    held = nodes.join(part, "fp")
    least = held.groupBy("component").agg(F.min("least").alias("component_id"))
    linked = part.join(least, "component").select("fp", "component_id", "component")
    return nodes.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"), F.coalesce("component", "fp").alias("component"))
