"""Connected components of an edge table, in few rounds of joins (hooking and pointer jumping)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import stage


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node of ``edges`` (u, v: long).

    Each round every tree of parents hooks onto the smallest parent next to it
    and halves its height, so chains shrink like a logarithm. Rounds are written
    to the shared folder; only a count of changes reaches the driver.
    """
    e = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u"))).where("u <> v").distinct()
    e = stage(spark, e, "edges")
    f = stage(spark, e.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("p")), "parents")
    while True:
        g = f.join(f.select(F.col("u").alias("p"), F.col("p").alias("gp")), "p").select("u", "p", "gp")
        m = e.join(g.select(F.col("u").alias("v"), "gp"), "v").groupBy("u").agg(F.min("gp").alias("m"))
        h = g.join(m, "u")
        new = (h.select("u", F.least("p", "gp", "m").alias("p"), F.col("p").alias("was"))
               .unionByName(h.select(F.col("p").alias("u"), F.col("m").alias("p"), F.lit(None).cast("long").alias("was")))
               .groupBy("u").agg(F.min("p").alias("p"), F.max("was").alias("was")))
        new = stage(spark, new, "parents")
        f = new.select("u", "p")
        if new.where("p <> was").isEmpty():
            return f.select(F.col("u").alias("node"), F.col("p").alias("component"))
