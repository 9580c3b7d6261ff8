"""Connected components of a link table, by contraction.

Each round every node moves to its smallest neighbour in a random but fixed
order, links are rewritten to the new nodes, and links inside one node go.
A random order shrinks chains by a constant factor a round, so the rounds
grow with the logarithm of the longest path. All tables stay distributed;
the driver learns only whether links are left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.llm.shared import is_empty, written


def _ordered(node: str):
    return F.struct(F.xxhash64(node).alias("h"), F.col(node).alias("id"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v); equal roots mean connected.

    The root is some node of the component. Links to itself, repeated links
    and links with a null end add nothing. ``links`` is read more than once,
    so it should be a written table.
    """
    links = links.where("u != v").select("u", "v")
    labels = links.select(F.explode(F.array("u", "v")).alias("node")).distinct().withColumn("root", F.col("node"))
    while not is_empty(links):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        step = both.groupBy("u").agg(F.min(_ordered("v")).alias("low"))
        step = written(step.select("u", F.least(F.col("low"), _ordered("u"))["id"].alias("to")), "step")
        labels = labels.join(step.withColumnRenamed("u", "root"), "root", "left").select(
            "node", F.coalesce("to", "root").alias("root")
        )
        links = written(
            links.join(step.withColumnRenamed("to", "a"), "u")
            .select("a", F.col("v").alias("u"))
            .join(step.withColumnRenamed("to", "b"), "u")
            .where("a != b")
            .select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))
            .distinct(),
            "links",
        )
    return written(labels, "labels")
