"""Approximate nearest neighbours on robust-pruned directed graphs.

Rows are dealt to shards of bounded size by a hash of their id. Each shard holds
a graph in the manner of Vamana (Subramanya et al., DiskANN, 2019): points are
inserted in growing batches, a greedy beam search over the graph so far proposes
their neighbours, and relaxed-distance pruning keeps edges to diverse ones (a
candidate goes if an edge kept is ``ALPHA`` times nearer to it than the point);
reverse edges are pruned alike when they overflow. Equal vectors are one point,
so a vector that a third of all rows share costs one node a shard. Queries come
in blocks, a beam search runs on every shard, and the shards' best are merged.
All searches of a batch run in lock step as numpy arrays.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from runloom.llm.common import require
from runloom.llm.vectors import valid_vectors
from runloom.session import written

SHARD_ROWS, DEGREE, BUILD_BEAM, ALPHA = 8192, 28, 56, 1.2
QUERY_BEAM, EXPAND = 160, 4
#: Queries in a block, and blocks that a task searches with one copy of a shard's graph.
BLOCK, BLOCKS = 512, 64
#: Pairs whose distances are computed at once.
PAIRS = 1 << 14


class Graph:
    """Distinct vectors of a shard with their out-edges (-1 pads) and the rows that share each vector."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = 7) -> None:
        vectors = vectors + 0.0  # no negative zeros
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        _, first, inverse = np.unique(vectors.view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1]))).ravel(), return_index=True, return_inverse=True)
        rng = np.random.default_rng(seed)
        shuffle = rng.permutation(len(first))
        place = np.empty(len(first), np.int64)
        place[shuffle] = np.arange(len(first))
        self.points = vectors[first[shuffle]]
        point = place[inverse.ravel()]
        by = np.argsort(point, kind="stable")  # ids ascend within a point
        self.members, self.bounds = ids[by], np.concatenate([[0], np.cumsum(np.bincount(point, minlength=len(first)))])
        self.degree, self.beam, self.alpha = degree, beam, alpha
        self._ready()
        self._build()

    def _ready(self) -> None:
        scale = np.abs(self.points).max() or 1.0
        self.x = self.points / scale
        self.scale = scale

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("x", "scale")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        self._ready()

    def _near(self, q: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Squared distances from queries (b, d) to points (b, c), from differences, which near copies do not cancel; -1 is infinitely far."""
        d = np.full(at.shape, np.inf)
        rows, columns = np.nonzero(at >= 0)
        for k in range(0, len(rows), PAIRS):
            r, c = rows[k : k + PAIRS], columns[k : k + PAIRS]
            v = self.x[at[r, c]] - q[r]
            d[r, c] = np.einsum("ij,ij->i", v, v)
        return d

    def search(self, q: np.ndarray, beam: int, most: int) -> tuple[np.ndarray, np.ndarray]:
        """(points, squared distances) in the beams of scaled queries, nearest first; only points below ``most`` exist."""
        b = len(q)
        starts = np.unique(np.linspace(0, most - 1, min(most, 8)).astype(np.int64))
        at = np.full((b, beam), -1, np.int64)
        at[:, : len(starts)] = starts[:beam]
        dist = self._near(q, at)
        seen = at < 0
        order = np.argsort(dist, axis=1, kind="stable")
        at, dist, seen = (np.take_along_axis(m, order, 1) for m in (at, dist, seen))
        active = np.arange(b)
        while len(active):
            # The EXPAND nearest unexpanded points of each beam.
            rank = np.cumsum(~seen[active], axis=1)
            pick = ~seen[active] & (rank <= EXPAND)
            has = pick.any(axis=1)
            active, pick = active[has], pick[has]
            if not len(active):
                break
            seen[active] |= pick
            from_ = np.full((len(active), EXPAND), -1, np.int64)
            r, c = np.nonzero(pick)
            from_[r, rank[has][r, c] - 1] = at[active[r], c]
            new = np.where(from_[:, :, None] >= 0, self.edges[from_], -1).reshape(len(active), -1)
            near = self._near(q[active], new)
            near = np.where(near < dist[active, -1:], near, np.inf)
            width = min(near.shape[1], beam)
            if near.shape[1] > width:
                cut = np.argpartition(near, width - 1, axis=1)[:, :width]
                new, near = np.take_along_axis(new, cut, 1), np.take_along_axis(near, cut, 1)
            ids = np.concatenate([at[active], np.where(np.isfinite(near), new, -1)], axis=1)
            d = np.concatenate([dist[active], near], axis=1)
            s = np.concatenate([seen[active], ~np.isfinite(near)], axis=1)
            # Equal points lie together after a sort by point; the expanded copy comes first and the other goes.
            order = np.argsort(ids * 2 + ~s, axis=1, kind="stable")
            ids, d, s = (np.take_along_axis(m, order, 1) for m in (ids, d, s))
            twice = (ids[:, 1:] == ids[:, :-1]) | (ids[:, 1:] < 0)
            d[:, 1:][twice], s[:, 1:][twice], ids[:, 1:][twice] = np.inf, True, -1
            order = np.argsort(d, axis=1, kind="stable")[:, :beam]
            at[active], dist[active], seen[active] = (np.take_along_axis(m, order, 1) for m in (ids, d, s))
        return at, dist

    def prune(self, p: np.ndarray, cand: np.ndarray) -> np.ndarray:
        """Diverse out-edges of points ``p`` from candidates (b, c), -1 padded."""
        cand = np.sort(cand, axis=1)
        cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
        cand[cand == p[:, None]] = -1
        near = self._near(self.x[p], cand)
        order = np.argsort(near, axis=1, kind="stable")
        cand, near = np.take_along_axis(cand, order, 1), np.take_along_axis(near, order, 1)
        alive = cand >= 0
        out = np.full((len(p), self.degree), -1, np.int64)
        rows = np.arange(len(p))
        for k in range(self.degree):
            if not alive.any():
                break
            first = alive.argmax(axis=1)
            ok = alive[rows, first]
            out[ok, k] = cand[ok, first[ok]]
            between = self._near(self.x[cand[rows, first]], np.where(alive & ok[:, None], cand, -1))
            alive &= ~((self.alpha**2 * between <= near) & ok[:, None])
            alive[rows, first] = False
        return out

    def _build(self) -> None:
        n = len(self.points)
        self.edges = np.full((n, self.degree), -1, np.int32)
        done = min(n, 64)
        first = np.arange(done)
        self.edges[:done] = self.prune(first, np.tile(first, (done, 1)))
        for turn in range(2):
            at = done if turn == 0 else 0
            while at < n:
                batch = np.arange(at, min(n, at + (min(256, max(16, at // 4)) if turn == 0 else 256)))
                found, _ = self.search(self.x[batch], self.beam, at if turn == 0 else n)
                own = self.edges[batch].astype(np.int64)
                self.edges[batch] = self.prune(batch, np.concatenate([found, own], axis=1))
                self._reverse(batch)
                at = int(batch[-1]) + 1
            if n <= self.beam:
                break

    def _reverse(self, batch: np.ndarray) -> None:
        to = self.edges[batch].astype(np.int64)
        source = np.repeat(batch, self.degree)[(to >= 0).ravel()]
        to = to.ravel()[(to >= 0).ravel()]
        order = np.argsort(to, kind="stable")
        source, to = source[order], to[order]
        heads, first, counts = np.unique(to, return_index=True, return_counts=True)
        for s in range(0, len(heads), 256):
            part, start, count = heads[s : s + 256], first[s : s + 256], counts[s : s + 256]
            width = int(count.max())
            nth = np.arange(width)
            extra = np.where(nth < count[:, None], source[np.minimum(start[:, None] + nth, len(source) - 1)], -1)
            both = np.concatenate([self.edges[part].astype(np.int64), extra], axis=1)
            tidy = np.sort(both, axis=1)[:, ::-1]
            tidy[:, 1:][tidy[:, 1:] == tidy[:, :-1]] = -1
            fits = (tidy >= 0).sum(axis=1) <= self.degree
            if fits.any():
                self.edges[part[fits]] = np.sort(tidy[fits], axis=1)[:, ::-1][:, : self.degree]
            if (~fits).any():
                self.edges[part[~fits]] = self.prune(part[~fits], both[~fits])

    def nearest(self, ids: np.ndarray, vectors: np.ndarray, k: int, beam: int = QUERY_BEAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query id, row id, distance): up to ``k`` rows for each query, its own left out, ties to smaller ids."""
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for s in range(0, len(ids), 256):
            q = vectors[s : s + 256]
            at, _ = self.search(q / self.scale, min(beam, max(len(self.points), 1)), len(self.points))
            for i, found in enumerate(at):
                found = found[found >= 0]
                dist = np.sqrt(((self.points[found] - q[i]) ** 2).sum(axis=1))
                rows, near = [], []
                for p, d in zip(found.tolist(), dist.tolist(), strict=True):
                    own = self.members[self.bounds[p] : min(self.bounds[p + 1], self.bounds[p] + k + 1)]
                    rows.append(own)
                    near.append(np.full(len(own), d))
                if not rows:
                    continue
                rows, near = np.concatenate(rows), np.concatenate(near)
                other = rows != ids[s + i]
                rows, near = rows[other], near[other]
                best = np.lexsort((rows, near))[:k]
                out.append((np.full(len(best), ids[s + i]), rows[best], near[best]))
        if not out:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _stack(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return pdf["id"].to_numpy(np.int64), np.stack(pdf["vector"].to_numpy()).astype(np.float64)


def _build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"dim": [key[0]], "shard": [key[1]], "graph": [pickle.dumps(Graph(*_stack(pdf)), protocol=5)]})


def _pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"dim": [key[0]], "block": [key[1]], "queries": [pickle.dumps(_stack(pdf), protocol=5)]})


def index_vectors(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, int]:
    """``(dim, shard, graph binary)`` over all rows of ``valid_vectors`` and the number of shards."""
    shards = max(1, -(-rows.count() // shard_rows))
    keyed = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    return written(keyed.groupBy("dim", "shard").applyInPandas(_build, "dim int, shard int, graph binary")), shards


def nearest_neighbours(df: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = SHARD_ROWS, beam: int = QUERY_BEAM) -> DataFrame:
    """``(query_id, rank int, id_col, score)``: the ``k`` nearest rows found for each query, by Euclidean distance.

    Rows or queries whose vector is null, empty, zero or not finite, or whose id
    is null, take no part; vectors of different lengths are not compared; a row
    never answers the query of its own id; a repeated row answers as often as it
    is there, a repeated query once. Ties go to the smaller id. Other columns
    are not read. No rows or no queries give no result.
    """
    require(df, id_col, vector_col)
    rows = valid_vectors(df, id_col, vector_col)
    index, shards = index_vectors(rows, shard_rows)
    asked = valid_vectors(queries, id_col, vector_col).dropDuplicates(["id"])
    blocks = max(1, -(-asked.count() // BLOCK))
    groups = -(-blocks // BLOCKS)
    packed = written(asked.withColumn("block", F.pmod(F.xxhash64("id", F.lit(3)), F.lit(blocks)).cast("int")).groupBy("dim", "block").applyInPandas(_pack, "dim int, block int, queries binary"))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(left):
            graph: Graph = pickle.loads(left["graph"].iloc[0])
            parts = [graph.nearest(*pickle.loads(q), k=k, beam=beam) for q in right["queries"]]
        q, i, d = (np.concatenate(c) for c in zip(*parts, strict=True)) if parts else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        return pd.DataFrame({"query_id": q, "id": i, "score": d})

    graphs = index.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    ask = packed.withColumn("group", (F.col("block") / BLOCKS).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    keys = ["dim", "shard", "group"]
    found = graphs.groupBy(*keys).cogroup(ask.groupBy(*keys)).applyInPandas(search, "query_id long, id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")


def op5_ann(spark, sf_dir):
    """The ten nearest rows to every vector whose id is divisible by 100."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest_neighbours(rows, rows.filter("vec_id % 100 = 0"))
