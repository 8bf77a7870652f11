"""Session factory and shared-folder helpers."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def get_session(cores: int | str = "*", memory: str = "16g") -> SparkSession:
    """A local session with the settings the engine is tested under."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("runloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is ``spark.checkpoint.dir`` where the cluster names one. Only where
    that is unset (tests on one machine) a temporary folder is made.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not folder:
        folder = context.getCheckpointDir() or tempfile.mkdtemp(prefix="runloom-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through the reliable checkpoint folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Tables that ``written`` made in this process.
_WRITTEN: list[str] = []


def clean(spark: SparkSession, tables: list[str] | None = None) -> None:
    """Remove tables that this process wrote to the shared folder, all or those named; results that still read them must be gone."""
    for name in list(_WRITTEN) if tables is None else list(tables):
        if name in _WRITTEN:
            _WRITTEN.remove(name)
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def tables_of(f: Callable[[], DataFrame]) -> tuple[DataFrame, list[str]]:
    """A function's result and the tables that it wrote on the way."""
    before = len(_WRITTEN)
    out = f()
    return out, _WRITTEN[before:]


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage through a Parquet table in the shared folder; compact for wide or many rows."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/runloom-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of results that are gone, which else stay on disk until the driver happens to collect its garbage."""
    gc.collect()
    spark._jvm.System.gc()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table; a directory or a single file."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
