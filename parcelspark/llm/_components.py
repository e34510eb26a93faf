"""Connected components of a distributed edge table (alternating large-star and small-star steps)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.llm._blocks import checkpoint_dir


def _star(edges: DataFrame) -> DataFrame:
    """``edges(u, v)``: every v of u, and u itself, to the least of them; one row per u is joined back."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return edges.join(least, "u")


def _step(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` with a < b; the same components, closer to stars around the least id."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    large = _star(both).where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a < b")
    down = _star(large.select(F.col("b").alias("u"), F.col("a").alias("v")))
    small = down.select(F.col("m").alias("a"), F.explode(F.array("u", "v")).alias("b")).where("a < b")
    return small.distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the least id of the component) for every id in ``edges(a, b)``; each step is a written table."""
    spark = edges.sparkSession
    base = f"{checkpoint_dir(spark)}/components-{uuid.uuid4().hex}"
    edges = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    seen, step = None, 0
    while True:
        edges.write.parquet(f"{base}/{step}")
        edges = spark.read.parquet(f"{base}/{step}")
        # stars around least ids: no id is both a centre and a leaf, and no leaf has two centres
        now = edges.agg(F.count("*").alias("n"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31))).alias("h")).first()
        if (now["n"], now["h"]) == seen or not now["n"]:
            break
        seen, step = (now["n"], now["h"]), step + 1
        edges = _step(edges)
    leaves = edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return leaves.union(edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
