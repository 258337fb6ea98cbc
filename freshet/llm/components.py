"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.common import free, stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(
        least.select("u", F.col("m").alias("v"))
    )


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component_id) for every node with an edge; the id is its component's least node.

    ``edges`` has long columns u and v. Null ends and loops are ignored; repeated
    edges count once; no edges give no rows. Every round is written to the shared
    folder. Raises if the stars have not settled after ``max_rounds`` rounds
    (the rounds needed grow with the logarithm of the nodes).
    """
    now = stored(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(),
        "edges",
    )
    print_of = [F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")]
    before = now.agg(*print_of).first()
    if not before["n"]:
        return now.select(F.col("u").alias("node"), F.col("v").alias("component_id"))
    for _ in range(max_rounds):
        last, now = now, stored(_small_star(_large_star(now)).distinct(), "edges")
        free(last)
        after = now.agg(*print_of).first()
        if after == before:
            roots = now.select(F.col("v").alias("node")).distinct().withColumn("component_id", F.col("node"))
            return now.select(F.col("u").alias("node"), F.col("v").alias("component_id")).union(roots)
        before = after
    raise RuntimeError(f"components have not settled after {max_rounds} rounds")
