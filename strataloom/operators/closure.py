"""All descendants in a relation of children and parents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.runtime import materialise


def descendants(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """(id) of everything below ``roots`` (id) in ``pairs`` (child, parent), the roots left out unless a cycle leads back to one.

    Level by level: each level is written, and holds only what no level before it had, so cycles end. Null ids are nobody.
    """
    links = materialise(pairs.select("child", "parent").where("child is not null and parent is not null").distinct(), "pairs")
    level = roots.select("id").where("id is not null").distinct()
    found = None
    while True:
        below = links.join(level, links["parent"] == level["id"]).select(F.col("child").alias("id")).distinct()
        level = materialise(below if found is None else below.join(found, "id", "left_anti"), "level")
        if level.isEmpty():
            return level if found is None else found
        found = level if found is None else found.unionByName(level)
