"""Run folders and conversation imports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def _there(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder))


def write_runs(cards: DataFrame, events: DataFrame, path: str) -> None:
    """Scorecards and traces as Parquet, partitioned by suite so that a suite is read alone."""
    cards.write.mode("overwrite").partitionBy("suite_id").parquet(f"{path}/scorecards")
    events.write.mode("overwrite").parquet(f"{path}/traces")


def read_runs(spark: SparkSession, path: str, suite: str | None = None) -> DataFrame:
    """Runs that have both a scorecard and a trace, with their lineage and state diff where those tables are there."""
    cards = spark.read.parquet(f"{path}/scorecards")
    cards = cards.filter(F.col("suite_id") == suite) if suite is not None else cards
    traced = spark.read.parquet(f"{path}/traces").groupBy("run_id").agg(F.count("*").alias("n_events"))
    out = cards.join(traced, "run_id")
    for side in ("lineage", "state_diff"):
        if _there(spark, f"{path}/{side}"):
            out = out.join(spark.read.parquet(f"{path}/{side}"), "run_id", "left")
    return out


def import_conversations(results: DataFrame, tasks: DataFrame, tools: DataFrame, sealed: DataFrame) -> DataFrame:
    """Results with their source task and tool schema; all or nothing.

    Any result without a task, of an unknown tool, or of a sealed family fails
    the whole import when it is read; there is no partial result.
    """
    one = lambda d, c: d.select(c).distinct()
    both = results.join(tasks, "task_id", "left").join(tools, "tool_name", "left").join(one(sealed, "family").withColumn("sealed", F.lit(True)), "family", "left")
    problem = F.when(F.col("family").isNull(), "no source task").when(F.col("tool_schema").isNull(), "unknown tool").when(F.col("sealed"), "sealed family")
    bad = both.select(problem.alias("p")).filter("p is not null").agg(F.min("p").alias("p"), F.count("*").alias("n"))
    gate = bad.select(F.when(F.col("n") > 0, F.raise_error(F.concat(F.lit("import refused: "), F.col("p"))).cast("boolean")).otherwise(F.lit(True)).alias("fine"))
    return both.drop("sealed").crossJoin(F.broadcast(gate)).filter("fine").drop("fine")  # one row
