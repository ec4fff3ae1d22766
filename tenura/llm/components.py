"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.frames import forget, written


def components(edges: DataFrame) -> DataFrame:
    """``id, component_id`` for every vertex of ``edges`` (``a, b``, both long, not null).

    ``component_id`` is the smallest id reachable. Each round maps every vertex to the smallest
    scrambled name among itself and its neighbours and joins the edges with that map, so the
    number of vertices falls by a constant factor, whatever the shape of the graph. A hub is
    one key of a partial aggregate and of a join that adaptive execution splits. Edges, maps and
    labels live in the shared folder; the driver only learns whether edges are left.
    """
    spark = edges.sparkSession
    ends = edges.where("a <> b")
    links, path = written(
        ends.select(F.xxhash64("a").alias("u"), F.xxhash64("b").alias("v")).distinct(), "links"
    )
    vertices = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    labels = vertices.select("id", F.xxhash64("id").alias("name"))
    while not links.isEmpty():
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        parents, _ = written(
            both.groupBy(F.col("u").alias("child"))
            .agg(F.min("v").alias("least"))
            .select("child", F.least("child", "least").alias("parent")),
            "parents",
        )
        one = parents.select(F.col("child").alias("u"), F.col("parent").alias("pu"))
        two = parents.select(F.col("child").alias("v"), F.col("parent").alias("pv"))
        contracted, next_path = written(
            links.join(one, "u")
            .join(two, "v")
            .where("pu <> pv")
            .select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v"))
            .distinct(),
            "links",
        )
        labels = labels.join(parents, labels["name"] == parents["child"], "left").select(
            "id", F.coalesce("parent", "name").alias("name")
        )
        forget(spark, path)
        links, path = contracted, next_path
    forget(spark, path)
    labels, _ = written(labels, "named")
    least = labels.groupBy("name").agg(F.min("id").alias("component_id"))
    return labels.join(least, "name").select("id", "component_id")
