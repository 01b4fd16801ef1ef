"""Connected components of links, in rounds of joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliozone.session import stage


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every id that has a link; ``links``: two columns of one type; root: the smallest id.

    Alternating stars: every id hands its larger neighbours, then itself and its smaller ones, to
    its smallest neighbour. Each half is one combinable minimum and one join, so an id with a third
    of all links is met by the split of skewed joins. Every round is written to the shared folder.
    """
    first, second = links.columns
    edges = links.select(F.greatest(first, second).alias("u"), F.least(first, second).alias("v")).filter("u <> v").distinct()
    edges, before = stage(edges, "links"), None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or mark[0] == 0:
            break
        before = mark
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = stage(small.select("e.*").filter("u <> v").distinct(), "links")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())
