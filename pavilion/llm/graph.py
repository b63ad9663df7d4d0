"""Connected components of a link table, by joins and grouping only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pavilion.session import discard, materialize, new_folder


def components(links: DataFrame, folder: str) -> DataFrame:
    """(node, component) for every end of ``links`` (a, b); a component is named by its least node.

    Alternating stars: each round hangs every node's larger neighbours, then its smaller
    ones, on the least neighbour, until nothing moves; the number of rounds grows with
    the logarithm of the longest chain. Nodes with very many links are only ever counted
    and joined, never gathered. Rounds are written under ``folder`` and the one before
    is deleted.
    """
    spark = links.sparkSession
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    state, before = None, None
    while True:
        path = f"{folder}/round-{new_folder(spark, 'x').rsplit('-', 1)[1]}"
        written = materialize(edges, "edges", path)
        now = written.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if before:
            discard(spark, before)
        if now == state:
            return written.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                written.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        state, before = now, path
        both = written.unionByName(written.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = small.unionByName(low.select("u", F.col("m").alias("v"))).distinct()
