"""Connected components by alternating large-star and small-star rounds.

Kiveris et al., "Connected Components in MapReduce and Beyond", SoCC 2014. All
rounds are joins and partial aggregates, so a vertex with many edges is combined
before the shuffle and split by the skew join; nothing is gathered on the driver
but one fingerprint row for each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from runloom.session import checkpointed


#: Edges of one partition: few edges in many partitions would be as many files for every shuffle of every round.
PARTITION_EDGES = 50_000


def _large_star(edges: DataFrame, parts: int) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
    return moved.coalesce(parts).distinct().coalesce(parts)


def _small_star(edges: DataFrame, parts: int) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).filter("u <> v").coalesce(parts).distinct().coalesce(parts)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node that some edge names; component is its smallest node.

    Self loops and null ends are ignored; no edges give no rows. Raises if
    ``max_rounds`` do not suffice, rather than return unfinished components.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(f"{a} is not null and {b} is not null and u <> v").distinct()
    e = checkpointed(e)
    last = None
    for _ in range(max_rounds):
        mark = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if mark["n"] == 0 or mark == last:
            break
        last = mark
        parts = max(1, -(-mark["n"] // PARTITION_EDGES))
        e = checkpointed(_small_star(_large_star(e.coalesce(parts), parts), parts))
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
