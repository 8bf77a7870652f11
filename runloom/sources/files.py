"""Other sources and the sinks: captures, snapshots, databases, mail, JSON inside text, split folders."""

from __future__ import annotations

import ast
import email
import email.policy
import hashlib
import json
import re
import sqlite3

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructType


def capture_files(spark: SparkSession, path: str, most: int | None = None) -> DataFrame:
    """``(path, size, sha256)`` of all files under a path; ``most`` bounds the listing, as the capture's recipe asks."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    rows = files.select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))
    return rows.orderBy("path").limit(most) if most is not None else rows


def snapshot(spark: SparkSession, path: str) -> DataFrame:
    """``(path, state)`` of JSON files as VARIANT; a file that is not a JSON object fails."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.try_parse_json("value").alias("state"))
    good = F.schema_of_variant("state").startswith("OBJECT")
    return raw.select("path", F.when(good, F.col("state")).otherwise(F.raise_error(F.concat(F.lit("not a JSON object: "), F.col("path"))).cast("variant")).alias("state"))


class SqliteSource(DataSource):
    """Read-only SQLite query: ``format("runloom_sqlite")`` with options path, query and maxRows (0: all).

    The last row is marked ``truncated`` if the bound cut the result. The file
    must be on the machine that reads it.
    """

    @classmethod
    def name(cls) -> str:
        return "runloom_sqlite"

    def schema(self) -> str:
        with _readonly(self.options["path"]) as con:
            names = [d[0] for d in con.execute(f"select * from ({self.options['query']}) limit 0").description]
        return ", ".join(f"`{n}` string" for n in names) + ", truncated boolean"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _SqliteReader({"path": self.options["path"], "query": self.options["query"], "maxRows": self.options.get("maxRows", "0")})


def _readonly(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


class _SqliteReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition: InputPartition):
        most = int(self.options.get("maxRows", "0"))
        with _readonly(self.options["path"]) as con:
            cursor = con.execute(self.options["query"])
            n, held = 0, cursor.fetchone()
            while held is not None and (not most or n < most):
                n, row, held = n + 1, held, cursor.fetchone()
                yield (*(None if x is None else str(x) for x in row), bool(most and n == most and held is not None))


MAIL = "struct<message_id:string,sender:string,recipients:string,subject:string,sent_at:string,body:string,body_sha256:string>"


def mail(spark: SparkSession, path: str) -> DataFrame:
    """Messages of a folder of .eml files or of a Maildir, one row a message."""

    @F.pandas_udf("message_id string, sender string, recipients string, subject string, sent_at string, body string, body_sha256 string")
    def parse(raw: pd.Series) -> pd.DataFrame:
        rows = []
        for data in raw:
            m = email.message_from_bytes(bytes(data), policy=email.policy.default)
            part = m.get_body(("plain", "html"))
            body = part.get_content() if part else ""
            rows.append((m["Message-ID"], m["From"], m["To"], m["Subject"], m["Date"], body, hashlib.sha256(body.encode()).hexdigest()))
        return pd.DataFrame([[None if x is None else str(x) for x in r] for r in rows], columns=["message_id", "sender", "recipients", "subject", "sent_at", "body", "body_sha256"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", parse("content").alias("m")).select("path", "m.*")


def _object_in(text: str | None) -> str:
    for read in (json.loads, ast.literal_eval):
        try:
            value = read(text)
        except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
            continue
        return json.dumps(value, sort_keys=True, default=str) if isinstance(value, dict) else "{}"
    return "{}"


@F.pandas_udf(StringType())
def object_text(text: pd.Series) -> pd.Series:
    """An object written as JSON or as a Python literal, as JSON; anything else is ``{}``."""
    return text.map(_object_in)


def objects_in_text(text: Column, tag: str) -> Column:
    """Contents of each ``<tag>...</tag>`` of a text."""
    return F.regexp_extract_all(text, F.lit(rf"(?s)<{re.escape(tag)}>\s*(.*?)\s*</{re.escape(tag)}>"), F.lit(1))


def write_splits(rows: DataFrame, path: str, split: str = "split") -> None:
    """One folder of JSON lines a split."""
    rows.write.mode("overwrite").partitionBy(split).json(path)


def write_if_unchanged(df: DataFrame, path: str, expected: str | None) -> str:
    """Replace a table only if its fingerprint is what the caller saw; returns the new one.

    The fingerprint is of the table's rows. The table is written beside the
    target and renamed, so that a failed write leaves the old one; one writer at
    a time is assumed, as a file system without a lock cannot promise more.
    """
    from runloom.operators.structure import checksum

    spark = df.sparkSession
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    target, fresh = fs_path(path), fs_path(path + ".new")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())

    def mark(rows: DataFrame) -> str:
        one = checksum(rows.withColumn("__one", F.lit(1)), "__one", rows.columns).first()
        return one["checksum"] if one else "empty"

    now = mark(spark.read.parquet(path)) if fs.exists(target) else None
    if now != expected:
        raise RuntimeError(f"the table at {path} has changed")
    df.write.mode("overwrite").parquet(path + ".new")
    if fs.exists(target):
        fs.delete(target, True)
    if not fs.rename(fresh, target):
        raise RuntimeError(f"could not rename to {path}")
    return mark(spark.read.parquet(path))
