"""Named objects and registered classes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert_objects(objects: DataFrame) -> DataFrame:
    """The current value of each name: the last write wins."""
    return objects.groupBy("name").agg(
        F.max_by("value", "version").alias("value"), F.max("version").alias("version")
    )


def lookup_objects(names: DataFrame, objects: DataFrame) -> DataFrame:
    """Fetch objects by name; a name nobody wrote has ``found`` false."""
    current = upsert_objects(objects).withColumn("found", F.lit(True))
    return names.join(current, "name", "left").na.fill(False, ["found"])


def missing_refs(tasks: DataFrame, registry: DataFrame, name: str = "class_name") -> DataFrame:
    """Tasks that name a class nobody registered."""
    return tasks.join(registry.select(name).distinct(), name, "left_anti")
