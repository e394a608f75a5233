"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marlstone.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """`node` and `component` for columns `a` and `b` of long ids; the least id names a component.

    Large-star and small-star steps in turn: every node hands its neighbours on to the least node
    it knows of, until each hangs on the least of its component. Steps are written tables, so
    nothing but two numbers per step comes to the driver. A node that is the least of its component
    is left out of the result. No edges give an empty result.
    """
    stars = staged(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    before = None
    while True:
        both = stars.unionAll(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = staged(
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct(),
            "large-star",
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        stars = staged(
            small.select("u", F.col("m").alias("v"))
            .unionAll(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
            .distinct(),
            "small-star",
        )
        now = tuple(
            stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        )
        if now == before:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = now
