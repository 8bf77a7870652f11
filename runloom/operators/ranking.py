"""Row numbers over a whole table without one task that sees every row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from runloom.session import checkpointed


def global_rank(df: DataFrame, name: str, *order: Column | str) -> DataFrame:
    """``df`` with its rows' numbers from 1 in the given order, which must be total.

    Rows are range-partitioned, numbered inside each partition, and shifted by the
    counts of the partitions before; only those counts, one row a partition,
    meet in one task.
    """
    ranged = checkpointed(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    before = ranged.groupBy("__part").agg(F.count("*").alias("__n"))
    shift = before.select("__part", (F.sum("__n").over(Window.partitionBy(F.lit(0)).orderBy("__part")) - F.col("__n")).alias("__before"))
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return ranged.join(F.broadcast(shift), "__part").withColumn(name, (inside + F.col("__before")).cast("long")).drop("__part", "__before")
