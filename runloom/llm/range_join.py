"""Exact cosine near-duplicates by a pivot-partitioned metric range join.

A cosine of at least c between two vectors means a distance of at most
r = sqrt(2 - 2c) between their unit vectors. Pivots partition the vectors into
cells by nearest pivot. By the triangle inequality, a vector u can have a partner
in the cell of pivot p only if d(u, p) <= d(u, own pivot) + 2r and
d(u, p) <= radius of that cell + r; it is replicated to those of these cells that
come after its own, as a visitor. So each pair meets in one cell, the later one,
and counts at both ends there; cells are joined independently. A cell's own
vectors and its visitors are counted first, and the cell is dealt to blocks of
bounded size by these counts: what a cell costs depends on what the bounds let in,
not on the table. A block yields a count for each vector and a spanning forest of
its links, never its pairs, so a group of near copies that holds a third of all
rows stays linear in the output.

Pivots are chosen from a bounded sample, farthest first. Equal vectors are one node
with a multiplicity from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from runloom.llm.common import arrow_batches, arrow_map, require
from runloom.llm.vectors import components, finite, valid_vectors
from runloom.operators.graph import connected_components
from runloom.session import checkpointed, written

COSINE = 0.95
#: Distinct vectors for each pivot, pivots at most (they go to every task), vectors that they are chosen from for
#: each pivot, and rows of a block.
CELL, PIVOTS, CANDIDATES, BLOCK = 8192, 4096, 4, 8192
#: Distances to pivots that are held at once.
DISTANCES = 1 << 22
#: Allowance for rounding in the bounds; links are decided by the cosine itself.
SLACK = 1e-6


def _unit(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return _scaled(flat.reshape(len(column), -1))


def _scaled(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)  # so that no square overflows
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _to_pivots(units: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (units @ pivots.T), 0))


def spread(units: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` of the vectors, each the farthest from those before it, so that every cluster gets one while they last."""
    taken = [0]
    far = _to_pivots(units, units[:1])[:, 0]
    while len(taken) < most and far.max() > SLACK:
        taken.append(int(far.argmax()))
        far = np.minimum(far, _to_pivots(units, units[taken[-1:]])[:, 0])
    return units[taken]


def _parts(batches: Iterator[pa.RecordBatch], pivots: dict[int, np.ndarray]) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """(dim, rows of that dim, their distances to its pivots), a bounded number at a time."""
    for batch in batches:
        dims = batch.column(3).to_numpy()
        for dim in np.unique(dims).tolist():
            part = batch.filter(pa.array(dims == dim))
            step = max(1, DISTANCES // len(pivots[dim]))
            for k in range(0, len(part), step):
                rows = part.slice(k, step)
                yield dim, rows, _to_pivots(_unit(rows.column(2)), pivots[dim])


def _homes(shared):
    """(rep, n, vector, dim) to (rep, n, vector, dim, cell, d)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, part, d in _parts(batches, shared.value):
            cell = d.argmin(axis=1)
            yield pa.record_batch([*part.columns, pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(d)), cell])], names=["rep", "n", "vector", "dim", "cell", "d"])

    return run


def _visits(part: pa.RecordBatch, d: np.ndarray, radius: np.ndarray, r: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell) of the visits that the triangle inequality cannot rule out, in cells after the row's own."""
    home, own = part.column(4).to_numpy(), part.column(5).to_numpy()
    near = (d <= own[:, None] + 2 * r + SLACK) & (d <= radius[None, :] + r + SLACK) & (np.arange(d.shape[1]) > home[:, None])
    return np.nonzero(near)


def _visitors(shared, radius: dict[int, np.ndarray], r: float):
    """(dim, cell, visits) of the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = {dim: np.zeros(len(p), np.int64) for dim, p in shared.value.items()}
        for dim, part, d in _parts(batches, shared.value):
            count[dim] += np.bincount(_visits(part, d, radius[dim], r)[1], minlength=len(count[dim]))
        for dim, c in count.items():
            some = np.flatnonzero(c)
            yield pa.record_batch([pa.array(np.full(len(some), dim, np.int32)), pa.array(some.astype(np.int32)), pa.array(c[some])], names=["dim", "cell", "visits"])

    return run


def _copies(shared, radius: dict[int, np.ndarray], home_blocks: dict[int, np.ndarray], visit_blocks: dict[int, np.ndarray], r: float):
    """Rows to (dim, cell, hb, vb, role, rep, n, vector): what each block of each cell needs.

    The cell's own vectors have role 0 on the home side; on the visiting side they have
    role 1, and vectors of other cells role 2.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, part, d in _parts(batches, shared.value):
            home = part.column(4).to_numpy()
            mixed = (part.column(0).to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            hb = (mixed % home_blocks[dim][home].astype(np.uint64)).astype(np.int64)
            row, cell = _visits(part, d, radius[dim], r)
            every = np.arange(len(d))
            for role, who, to in ((1, every, home), (2, row, cell)):
                times = home_blocks[dim][to]
                own = (mixed[who] % visit_blocks[dim][to].astype(np.uint64)).astype(np.int64)
                yield _rows(part, dim, np.repeat(to, times), _counting(times), np.repeat(own, times), role, np.repeat(who, times))
            times = visit_blocks[dim][home]
            yield _rows(part, dim, np.repeat(home, times), np.repeat(hb, times), _counting(times), 0, np.repeat(every, times))

    def _counting(times: np.ndarray) -> np.ndarray:
        return np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)

    def _rows(part: pa.RecordBatch, dim: int, cell: np.ndarray, hb: np.ndarray, vb: np.ndarray, role: int, row: np.ndarray) -> pa.RecordBatch:
        n = len(row)
        take = pa.array(row)
        columns = [pa.array(np.full(n, dim, np.int32)), *(pa.array(x.astype(np.int32)) for x in (cell, hb, vb)), pa.array(np.full(n, role, np.int32)), part.column(0).take(take), part.column(1).take(take), part.column(2).take(take)]
        return pa.record_batch(columns, names=["dim", "cell", "hb", "vb", "role", "rep", "n", "vector"])

    return run


def _join_block(cosine: float):
    def run(table: pa.Table) -> pa.Table:
        role, rep, n = (table.column(c).to_numpy() for c in ("role", "rep", "n"))
        own, visitors = np.flatnonzero(role == 0), np.flatnonzero(role > 0)
        if not len(own) or not len(visitors):
            return _counted(rep[:0], rep[:0], n[:0])
        units = _unit(table.column("vector").combine_chunks())
        nodes, place = np.unique(rep, return_inverse=True)
        links = np.zeros(len(rep), np.int64)
        other = (role[visitors] == 2).astype(np.float64)  # pairs within a cell are seen from both sides
        heads, tails = np.empty(0, np.int64), np.empty(0, np.int64)
        for s in range(0, len(own), 512):
            part = own[s : s + 512]
            near = (units[part] @ units[visitors].T) >= cosine
            near &= rep[part][:, None] != rep[visitors][None, :]
            i, j = np.nonzero(near)
            if len(i):
                links[part] = np.bincount(i, n[visitors[j]], len(part)).astype(np.int64)
                links[visitors] += np.bincount(j, n[part[i]] * other[j], len(visitors)).astype(np.int64)
                label = components(len(nodes), np.concatenate([heads, place[part[i]]]), np.concatenate([tails, place[visitors[j]]]))
                heads = np.flatnonzero(label != np.arange(len(nodes)))
                tails = label[heads]
        some = np.flatnonzero(links)
        zeros = np.zeros(len(heads), np.int64)
        return _counted(np.concatenate([rep[some], nodes[heads]]), np.concatenate([rep[some], nodes[tails]]), np.concatenate([links[some], zeros]))

    def _counted(a: np.ndarray, b: np.ndarray, links: np.ndarray) -> pa.Table:
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "links": pa.array(links, pa.int64())})

    return run


def replicated(nodes: DataFrame, cosine: float) -> DataFrame:
    """``(dim, cell, hb, vb, role, rep, n, vector)``: the rows of every block of every cell."""
    spark = nodes.sparkSession
    arrow_batches(spark)
    r = float(np.sqrt(2 - 2 * cosine))
    sizes = {x["dim"]: x["n"] for x in nodes.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    pivots = {}
    for dim, n in sizes.items():
        most = min(PIVOTS, max(1, -(-n // CELL)))
        chosen = nodes.filter(F.col("dim") == dim).orderBy(F.xxhash64("rep"), "rep").limit(most * CANDIDATES).select("vector").toArrow()
        pivots[dim] = spread(_unit(chosen.column("vector").combine_chunks()), most)
    shared = spark.sparkContext.broadcast(pivots)
    kind = "rep long, n long, vector array<double>, dim int, cell int, d double"
    placed = written(nodes.select("rep", "n", "vector", "dim").transform(arrow_map, _homes(shared), kind))
    radius = {dim: np.full(len(p), -np.inf) for dim, p in pivots.items()}
    home_blocks, visitors = ({dim: np.zeros(len(p), np.int64) for dim, p in pivots.items()} for _ in range(2))
    for x in placed.groupBy("dim", "cell").agg(F.max("d").alias("d"), F.count("*").alias("n")).collect():  # a row for each pivot
        radius[x["dim"]][x["cell"]] = x["d"]
        home_blocks[x["dim"]][x["cell"]] = visitors[x["dim"]][x["cell"]] = x["n"]
    visits = placed.transform(arrow_map, _visitors(shared, radius, r), "dim int, cell int, visits long")
    for x in visits.groupBy("dim", "cell").agg(F.sum("visits").alias("n")).collect():  # a row for each pivot
        visitors[x["dim"]][x["cell"]] += x["n"]
    home_blocks, visit_blocks = ({dim: np.maximum(1, -(-n // BLOCK)) for dim, n in x.items()} for x in (home_blocks, visitors))
    schema = "dim int, cell int, hb int, vb int, role int, rep long, n long, vector array<double>"
    return placed.transform(arrow_map, _copies(shared, radius, home_blocks, visit_blocks, r), schema)


def range_join(nodes: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``(a, b, links)`` over ``nodes(rep, n, vector, dim)``: counts where a = b, else edges that span every group."""
    return replicated(nodes, cosine).groupBy("dim", "cell", "hb", "vb").applyInArrow(_join_block(cosine), "a long, b long, links long")


def near_duplicate_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """``(id_col, n_links, component_id, kept)``, one row for each input row.

    Rows whose vector is null, empty, zero or not finite have no links and stand
    alone; so do rows without an id, whose component_id is null and which are
    kept. Vectors of different lengths are not compared. Repeated rows link with
    each other; rows that share an id are one node of the graph. Other columns
    are not read. An empty table gives an empty result.
    """
    require(df, id_col, vector_col)
    if not 0 < cosine < 1:
        raise ValueError("cosine must lie between 0 and 1")
    rows = valid_vectors(df, id_col, vector_col)
    nodes = written(rows.groupBy("vector", "dim").agg(F.min("id").alias("rep"), F.count("*").alias("n")))
    found = written(range_join(nodes, cosine))
    counts = found.filter("a = b").groupBy("a").agg(F.sum("links").alias("links"))
    groups = connected_components(found.filter("a <> b"))
    named = nodes.join(counts, nodes.rep == counts.a, "left").join(groups, nodes.rep == groups.node, "left")
    named = checkpointed(named.select("vector", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    linked = rows.join(named, "vector").select("id", "n_links", "component_id")
    every = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    alone = every.filter(F.col("id").isNull() | ~finite("vector")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.unionAll(alone)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op6_range_join(spark, sf_dir):
    """Links and groups of all vectors at a cosine of 0.95."""
    return near_duplicate_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
