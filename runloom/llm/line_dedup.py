"""Removal of repeated runs of lines.

Every three consecutive lines form a window. Windows are hashed (two 64-bit
chains over the hashes of their lines), counted with a partial aggregate and
joined back; each occurrence but the first, by (id, line number), is marked, and
the merged positions that marked windows cover are cut. Only hashes and numbers
are shuffled until the last join; a window that very many documents hold is one
aggregate row and a skewed join side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from runloom.llm.common import require
from runloom.session import written

WINDOW = 3
#: What stands for a null id while windows are ordered.
NO_ID = -(2**63)


def _windows(text: Column, width: int) -> Column:
    """Array of (w1, w2) for each ``width`` neighbouring lines."""
    lines = F.split(text, "\n", -1)
    hashes = F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(7), x).alias("b")))

    def over(h: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(h) - width)
        return F.transform(at, lambda i: F.struct(F.xxhash64(*[h[i + k]["a"] for k in range(width)]).alias("w1"), F.xxhash64(F.lit(7), *[h[i + k]["b"] for k in range(width)]).alias("w2")))

    # The array of hashes is bound once, by a transform over one element.
    return F.transform(F.array(hashes), lambda h: F.when(F.size(h) >= width, over(h)).otherwise(F.array().cast("array<struct<w1:bigint,w2:bigint>>")))[0]


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW) -> DataFrame:
    """``(id, dk, starts)``: first lines of the windows of a document that an earlier window equals."""
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text_col).alias("dk"), F.coalesce(text_col, F.lit("")).alias("text"))
    every = base.select("id", "dk", F.posexplode(_windows(F.col("text"), width)).alias("pos", "w")).select("id", "dk", "pos", "w.w1", "w.w2")
    # id and line as one number, for a hash aggregate; a 64-bit id needs 96 bits so.
    place = F.col("id").cast("decimal(20,0)") * F.lit(2**32).cast("decimal(10,0)") + F.col("pos")
    # Written, so that the join is between plain exchanges, whose hot partitions Spark splits.
    counted = written(every.groupBy("w1", "w2").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    late = every.join(counted, ["w1", "w2"]).filter(place != F.col("first"))
    return late.groupBy("id", "dk").agg(F.collect_set("pos").alias("starts"))


def _kept_lines(text: Column, starts: Column, width: int) -> Column:
    """(n_lines, n_removed, kept text) as a struct; positions that marked windows cover are merged by a set difference, in linear time."""

    def cut(p: Column) -> Column:
        # p binds the lines and the covered positions once.
        keep = F.array_except(F.sequence(F.lit(0), F.size(p["lines"]) - 1), p["gone"])
        return F.struct(F.size(p["lines"]).cast("long").alias("n_lines"), (F.size(p["lines"]) - F.size(keep)).cast("long").alias("n_removed"), F.array_join(F.transform(keep, lambda k: p["lines"][k]), "\n").alias("kept"))

    lines = F.split(text, "\n", -1)
    gone = F.array_distinct(F.flatten(F.transform(starts, lambda s: F.sequence(s, s + (width - 1)))))
    whole = F.struct(F.size(lines).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_removed"), text.alias("kept"))
    return F.when(starts.isNull(), whole).otherwise(F.transform(F.array(F.struct(lines.alias("lines"), gone.alias("gone"))), cut)[0])


def _marked(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """``docs`` with the starts of its later windows as ``__starts``, null where it has none."""
    require(docs, id_col, text_col)
    starts = repeated_windows(docs, id_col, text_col, width).select(F.col("id").alias("__id"), F.col("dk").alias("__k"), F.col("starts").alias("__starts"))
    keyed = docs.withColumn("__d", F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))).withColumn("__x", F.xxhash64(text_col))
    return keyed.join(starts, (F.col("__d") == F.col("__id")) & (F.col("__x") == F.col("__k")), "left")


def remove_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW) -> DataFrame:
    """``(id_col, n_lines, n_removed, kept)``, one row for each input row.

    Lines end at LF; null text counts as the empty text, which is one empty
    line; texts of fewer than ``width`` lines hold no window; blank lines count
    as lines. Rows that share an id count as one document, so equal windows at
    the same line of both are one occurrence; null ids come first, as the id
    -2**63 would, with which they count as one document. Other columns
    are not read. An empty table gives an empty result.
    """
    require(docs, id_col, text_col)
    rows = _marked(docs.select(id_col, text_col), id_col, text_col, width)
    return rows.select(F.col(id_col), F.inline(F.array(_kept_lines(F.coalesce(text_col, F.lit("")), F.col("__starts"), width))))


def remove_repeated_lines_from(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW) -> DataFrame:
    """The documents without those lines; a null text and all other columns stay as they are."""
    rows = _marked(docs, id_col, text_col, width)
    text = F.when(F.col("__starts").isNull(), F.col(text_col)).otherwise(_kept_lines(F.coalesce(text_col, F.lit("")), F.col("__starts"), width)["kept"])
    return rows.select(*[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def op2_line_dedup(spark, sf_dir):
    """Lines of every document and those that go as later copies of three-line windows."""
    kept = remove_repeated_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP2_SQL = """
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i
  from documents),
wins as (
  select doc_id, i, [line, lead(line, 1) over d, lead(line, 2) over d] as w, lead(i, 2) over d as ending
  from lines window d as (partition by doc_id order by i)),
marked as (
  select doc_id, i, row_number() over (partition by w order by doc_id, i) as nth from wins where ending is not null),
gone as (select distinct doc_id, i + unnest([0, 1, 2]) as i from marked where nth > 1)
select l.doc_id, count(*)::bigint as n_lines, count(g.i)::bigint as n_removed,
       sha256(coalesce(string_agg(l.line, chr(10) order by l.i) filter (where g.i is null), '')) as kept_sha256
from lines l left join gone g on l.doc_id = g.doc_id and l.i = g.i
group by l.doc_id
"""
