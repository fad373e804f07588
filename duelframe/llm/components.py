"""Connected components of a link table, as DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.llm.common import written

JUMPS = 2


def _mapped(column: str, labels: DataFrame, frame: DataFrame) -> DataFrame:
    """``frame`` with ``column`` replaced by its label, where it has one."""
    to = labels.select(F.col("id").alias("dfx_from"), F.col("lab").alias("dfx_to"))
    out = frame.join(to, F.col(column) == F.col("dfx_from"), "left")
    return out.withColumn(column, F.coalesce("dfx_to", column)).drop("dfx_from", "dfx_to")


def _contracted(links: DataFrame, labels: DataFrame) -> DataFrame:
    links = _mapped("v", labels, _mapped("u", labels, links)).filter("u <> v")
    return links.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def connected_components(links: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """(id, lab): the smallest id reachable from every end of the links (u, v).

    ``before`` holds the components of earlier links; only what the new ones
    join is worked on.  In a round every node points to its smallest
    neighbour, pointers are followed twice, and the links are drawn anew
    between what the pointers lead to, so they shrink from round to round
    and a star is gone after one.  Rounds are written to the shared folder;
    only the question whether links are left reaches the driver.
    """
    links = links.select("u", "v").filter("u <> v")
    if before is not None:
        links = _contracted(links, before)
    links, found = written(links, "cc-links"), before
    while not links.isEmpty():
        ends = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        step = ends.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("m")).select("id", F.least("id", "m").alias("lab"))
        step = written(step, "cc-step")
        for _ in range(JUMPS):
            step = written(_mapped("lab", step, step), "cc-jump")
        if found is None:
            found = step
        else:
            fresh = step.join(found.select("id"), "id", "left_anti")
            found = written(_mapped("lab", step, found).unionByName(fresh), "cc-labels")
        links = written(_contracted(links, step), "cc-links")
    return found if found is not None else links.select(F.col("u").alias("id"), F.col("v").alias("lab"))
