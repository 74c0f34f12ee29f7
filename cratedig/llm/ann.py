"""Approximate nearest neighbours by cosine: one navigable small-world graph per shard.

Equal vectors are one point of a graph, with the smallest ids that can appear
in a result; a very common vector thus costs one point. Points are dealt to
shards by hash, and each shard is indexed by one task: a hierarchy of layers,
each a flat array of neighbour numbers, saved in the shared folder with its
vectors. For a search a shard is read by one task, which the queries pass
through in batches, and the best of every shard are merged. Within a task,
points are inserted and queries searched in lockstep, so that numpy does the
work.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cratedig.llm._util import ragged, save

K = 5
#: Points of a shard at most on average, neighbours of a point, and candidates held in building and searching.
SHARD = 8192
LINKS = 24
BUILD = 64
SEARCH = 96
_BATCH = 64
_GRAPHS = "dim int, shard int, n int, entry int, vectors binary, layers array<binary>, level binary, ids binary, counts binary"


class Graph:
    """Layers of neighbour arrays over unit vectors; layer 0 has all points, -1 fills rows."""

    def __init__(self, unit: np.ndarray, links: int, layers: list[np.ndarray], level: np.ndarray, entry: int):
        self.unit, self.links, self.layers, self.level, self.entry = unit, links, layers, level, entry

    @classmethod
    def build(cls, unit: np.ndarray, links: int = LINKS, width: int = BUILD) -> Graph:
        n = len(unit)
        draw = np.random.default_rng(n).random(n)
        level = np.minimum((-np.log(1 - draw) / math.log(links)).astype(int), 8)
        order = np.argsort(-level, kind="stable")  # the top first, so that every layer is entered from above
        self = cls(unit, links, [np.full((n, 2 * links if k == 0 else links), -1, np.int32) for k in range(int(level.max(initial=0)) + 1)], level, int(order[0]))
        done = 1
        while done < n:
            batch = order[done : done + min(_BATCH, max(1, done // 4))]
            self._insert(batch, width)
            done += len(batch)
        return self

    def _insert(self, batch: np.ndarray, width: int) -> None:
        q = self.unit[batch]
        at = np.full((len(batch), 1), self.entry)
        for k in range(len(self.layers) - 1, -1, -1):
            below = self.level[batch] < k
            found, score = self._layer(q, at, k, 1 if below.all() else width)
            at = found[:, : max(1, width // 4)]
            rows = np.flatnonzero(~below)
            if not len(rows):
                continue
            # points of a batch may be each other's neighbours too
            own = q[rows] @ q[rows].T
            np.fill_diagonal(own, -np.inf)
            near = np.concatenate([found[rows], np.broadcast_to(batch[rows], own.shape)], axis=1)
            close = np.concatenate([score[rows], own], axis=1)
            top = np.argsort(-close, axis=1, kind="stable")[:, :width]
            near, close = np.take_along_axis(near, top, 1), np.take_along_axis(close, top, 1)
            near[~np.isfinite(close)] = -1
            chosen = self._diverse(near, close, self.links)
            self.layers[k][batch[rows], : self.links] = chosen
            self._link_back(k, batch[rows], chosen)

    def _diverse(self, near: np.ndarray, close: np.ndarray, most: int) -> np.ndarray:
        """Of each row's candidates, nearest first, those nearer to the row than to any chosen one; others fill up."""
        rows, wide = near.shape
        vectors = self.unit[np.maximum(near, 0)]
        taken = np.zeros((rows, wide), bool)
        count = np.zeros(rows, int)
        between = np.matmul(vectors, vectors.transpose(0, 2, 1))
        for j in range(wide):
            good = (near[:, j] >= 0) & (count < most) & ~((between[:, j] > close[:, j, None]) & taken).any(axis=1)
            taken[:, j] = good
            count += good
        rank = np.argsort(np.where(taken, 0, 1) + 2 * (near < 0), axis=1, kind="stable")[:, :most]
        out = np.take_along_axis(near, rank, 1)
        return np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)

    def _link_back(self, k: int, points: np.ndarray, chosen: np.ndarray) -> None:
        layer = self.layers[k]
        of, to = np.repeat(points, chosen.shape[1]), chosen.ravel()
        of, to = of[to >= 0], to[to >= 0]
        order = np.argsort(to, kind="stable")
        ends, counts = np.unique(to, return_counts=True)
        if not len(ends):
            return
        owner, step = ragged(counts)
        new = np.full((len(ends), int(counts.max())), -1, np.int64)
        new[owner, step] = of[order]
        have, most = layer[ends], layer.shape[1]
        new[(new[:, :, None] == have[:, None, :]).any(axis=2)] = -1
        every = np.concatenate([have, new], axis=1)
        score = np.where(every >= 0, np.matmul(self.unit[np.maximum(every, 0)], self.unit[ends][:, :, None])[:, :, 0], -np.inf)
        top = np.argsort(-score, axis=1, kind="stable")
        every, score = np.take_along_axis(every, top, 1), np.take_along_axis(score, top, 1)
        out = every[:, :most]
        full = np.flatnonzero((every >= 0).sum(axis=1) > most)
        if len(full):
            out[full] = self._diverse(every[full], score[full], most)
        layer[ends] = out

    def _layer(self, q: np.ndarray, start: np.ndarray, k: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` best points found for each query from its starts: numbers and scores, best first, -1 fills."""
        n, rows, layer = len(self.unit), len(q), self.layers[k]
        seen = np.zeros((rows, n + 1), bool)  # the last column stands for -1
        lines = np.arange(rows)[:, None]
        seen[lines, start] = True
        seen[:, n] = True
        point = start.astype(np.int64)
        score = np.where(point >= 0, np.matmul(self.unit[np.maximum(point, 0)], q[:, :, None])[:, :, 0], -np.inf)
        fresh = point >= 0
        live = np.arange(rows)
        while len(live):
            open_score = np.where(fresh[live], score[live], -np.inf)
            # two candidates of each query are opened at once
            best = np.argsort(-open_score, axis=1, kind="stable")[:, :2]
            any_left = np.isfinite(np.take_along_axis(open_score, best[:, :1], 1))[:, 0]
            live, best = live[any_left], best[any_left]
            if not len(live):
                break
            ok = np.take_along_axis(fresh[live], best, 1)
            nxt = np.where(ok, np.take_along_axis(point[live], best, 1), -1)
            fresh[live[:, None], best] = False
            more = np.where(nxt[:, :, None] >= 0, layer[np.maximum(nxt, 0)], -1).reshape(len(live), -1)
            more = np.sort(more, axis=1)
            more[:, 1:][more[:, 1:] == more[:, :-1]] = -1
            more = np.where(seen[live[:, None], more], -1, more)
            seen[live[:, None], more] = True
            got = np.where(more >= 0, np.matmul(self.unit[np.maximum(more, 0)], q[live][:, :, None])[:, :, 0], -np.inf)
            wide = max(point.shape[1], width)
            if point.shape[1] < wide:
                pad = wide - point.shape[1]
                point, score, fresh = np.pad(point, ((0, 0), (0, pad)), constant_values=-1), np.pad(score, ((0, 0), (0, pad)), constant_values=-np.inf), np.pad(fresh, ((0, 0), (0, pad)))
            p, s, f = np.concatenate([point[live], more], axis=1), np.concatenate([score[live], got], axis=1), np.concatenate([fresh[live], more >= 0], axis=1)
            top = np.argsort(-s, axis=1, kind="stable")[:, :width]
            pad = wide - top.shape[1]
            point[live], score[live], fresh[live] = (np.pad(np.take_along_axis(x, top, 1), ((0, 0), (0, pad)), constant_values=v) for x, v in ((p, -1), (s, -np.inf), (f, False)))
        top = np.argsort(-score, axis=1, kind="stable")[:, :width]
        return np.take_along_axis(point, top, 1), np.take_along_axis(score, top, 1)

    def search(self, q: np.ndarray, width: int) -> np.ndarray:
        at = np.full((len(q), 1), self.entry)
        for k in range(len(self.layers) - 1, 0, -1):
            at = self._layer(q, at, k, 1)[0]
        return self._layer(q, at, 0, width)[0]


def _build(links: int, width: int):
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("least")
        vectors = np.stack(frame["vector"].to_numpy()).astype(np.float64).reshape(-1, key[0])
        unit = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)
        g = Graph.build(unit, links, width)
        ids = frame["ids"].to_numpy()
        row = {"dim": key[0], "shard": key[1], "n": len(unit), "entry": g.entry, "vectors": vectors.tobytes(), "layers": [x.tobytes() for x in g.layers], "level": g.level.astype(np.int32).tobytes()}
        row |= {"ids": np.concatenate(ids).astype(np.int64).tobytes(), "counts": np.array([len(x) for x in ids], np.int32).tobytes()}
        return pd.DataFrame([row])

    return run


class _Shard:
    """A stored shard, to search in."""

    def __init__(self, x: dict, links: int):
        self.vectors = np.frombuffer(x["vectors"], np.float64).reshape(-1, x["dim"])
        unit = (self.vectors / np.linalg.norm(self.vectors, axis=1, keepdims=True)).astype(np.float32)
        layers = [np.frombuffer(v, np.int32).reshape(len(unit), -1) for v in x["layers"]]
        self.graph = Graph(unit, links, layers, np.frombuffer(x["level"], np.int32), x["entry"])
        self.ids, self.counts = np.frombuffer(x["ids"], np.int64), np.frombuffer(x["counts"], np.int32)
        self.first = np.cumsum(self.counts) - self.counts

    def nearest(self, query_ids: np.ndarray, queries: np.ndarray, width: int, k: int) -> list[tuple[int, int, float]]:
        out: list[tuple] = []
        for lo in range(0, len(queries), 256):
            exact = queries[lo : lo + 256]
            q = (exact / np.linalg.norm(exact, axis=1, keepdims=True)).astype(np.float32)
            for r, points in enumerate(self.graph.search(q, max(width, 2 * k))):
                points = points[points >= 0]
                own = self.vectors[points]
                score = (own * exact[r]).sum(axis=1) / (np.sqrt((own * own).sum(axis=1)) * np.sqrt((exact[r] * exact[r]).sum()))
                hits = [(-s, i) for p, s in zip(points, score, strict=True) for i in self.ids[self.first[p] : self.first[p] + self.counts[p]] if i != query_ids[lo + r]]
                out += [(int(query_ids[lo + r]), int(i), -s) for s, i in sorted(hits)[:k]]
        return out


def _ask(links: int, width: int, k: int):
    """Reads shards and the queries after each; one shard is held at a time, and its queries pass by in batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = None, None
        for batch in batches:
            kind = batch.column("vec_id").is_valid().to_numpy(zero_copy_only=False)
            dim, shard = (batch.column(c).to_numpy() for c in ("dim", "shard"))
            edges = np.flatnonzero(np.concatenate([[True], ~(kind[1:] & kind[:-1] & (shard[1:] == shard[:-1]) & (dim[1:] == dim[:-1])), [True]])) if len(kind) else []
            out: list[tuple] = []
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                if not kind[lo]:
                    held, key = _Shard(batch.slice(lo, 1).to_pylist()[0], links), (dim[lo], shard[lo])
                elif key == (dim[lo], shard[lo]):
                    vectors = batch.column("vector").slice(lo, hi - lo).flatten().to_numpy().reshape(-1, dim[lo])
                    out += held.nearest(batch.column("vec_id").slice(lo, hi - lo).to_numpy(), vectors, width, k)
            yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in out], t) for j, t in enumerate((pa.int64(), pa.int64(), pa.float64()))], names=["query_id", "vec_id", "score"])

    return run


def valid_vectors(table: DataFrame) -> DataFrame:
    """(vec_id, vector): rows whose vector is finite in each component and not zero."""
    real = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")).where(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", real) & F.exists("vector", lambda x: x != 0)
    )


def build_index(vectors: DataFrame, k: int = K, shard: int = SHARD, links: int = LINKS, width: int = BUILD) -> DataFrame:
    """One row per shard of ``valid_vectors`` rows: dim, shard, flat neighbour arrays, vectors and ids."""
    keyed = vectors.distinct().select("vec_id", "vector", F.xxhash64("vector").alias("h"))
    # of equal vectors, a result of k can name the k smallest ids, and one more where the query is one of them
    ranked = keyed.withColumn("turn", F.row_number().over(Window.partitionBy("h", "vector").orderBy("vec_id"))).where(F.col("turn") <= k + 1)
    points = save(ranked.groupBy("h", "vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.min("vec_id").alias("least")), "points").withColumn("dim", F.size("vector"))
    shards = points.groupBy("dim").agg(F.ceil(F.count("*") / F.lit(shard)).cast("int").alias("shards"))
    dealt = points.join(shards, "dim").select("dim", F.pmod(F.hash("h"), F.col("shards")).alias("shard"), "vector", "ids", "least")
    # about one shard a task: small tables would be put together otherwise, but their graphs take long
    dealt = dealt.repartition(int(shards.agg(F.sum("shards")).first()[0] or 1), "dim", "shard")
    return save(dealt.groupBy("dim", "shard").applyInPandas(_build(links, width), _GRAPHS), "graphs")


def search_index(graphs: DataFrame, queries: DataFrame, k: int = K, links: int = LINKS, search: int = SEARCH) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest that the shards of ``build_index`` hold for ``valid_vectors`` rows.

    Every query goes to every shard of its length, behind the shard's own row: a
    task reads the shard once, whatever the number of queries.
    """
    shards = graphs.select("dim", "shard")
    asked = queries.distinct().withColumn("dim", F.size("vector")).join(shards.groupBy("dim").agg(F.collect_list("shard").alias("to")), "dim")
    asked = asked.select("dim", F.explode("to").alias("shard"), "vec_id", "vector")
    # about one shard a task, so that a batch holds few of them
    rows = graphs.unionByName(asked, allowMissingColumns=True).repartition(max(1, graphs.count()), "dim", "shard")
    # a shard's row has no vec_id, so it comes first
    hits = rows.sortWithinPartitions("dim", "shard", F.asc_nulls_first("vec_id")).mapInArrow(_ask(links, search, k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(table: DataFrame, queries: DataFrame, k: int = K, shard: int = SHARD, links: int = LINKS, width: int = BUILD, search: int = SEARCH) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k nearest rows of ``table`` but itself; both have vec_id and embedding.

    Vectors that are null, empty or zero, or hold a null or non-finite component,
    take no part, as query or candidate; nor do null ids. Vectors are indexed by
    length, as there is no cosine of two lengths. Rows that repeat a vec_id with
    other vectors are candidates each; rows that repeat the vector too are one. Score is the cosine of the stored
    components in double precision; ties go to the smaller vec_id. Other columns
    are ignored; empty tables give no rows.
    """
    if k < 1 or shard < 1 or links < 2:
        raise ValueError("k and shard are at least 1, links at least 2")
    return search_index(build_index(valid_vectors(table), k, shard, links, width), valid_vectors(queries), k, links, search)
