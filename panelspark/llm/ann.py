"""Approximate nearest neighbours: a robust-pruned directed graph per shard, searched by beams.

Rows with equal vectors are one node that keeps the least ids of its members. Nodes are dealt to
shards of at most about ``shard_rows`` by a hash of the vector, so shards are even and bounded
however the data cluster, and copies of one vector cost one node. Each shard builds its graph: nodes
enter in growing batches; a greedy beam search from the node nearest the mean proposes neighbours;
robust pruning keeps the nearest candidate and drops those that lie nearer to a kept one, by the
factor ``alpha``, than to the node; links back are pruned likewise. Queries come in blocks, each block
meets each shard once, a beam search finds the best nodes of the shard, and an exact merge keeps a
query's best over all shards.

For largest inner products, graphs are built on vectors with one more component, the square root of
what a vector's squared length lacks of the shard's largest: nearest by distance is then largest by
product. Scores are inner products of the original vectors in double precision.

Scale: a shard's graph is one row of about shard_rows * (dim + degree) * 4 bytes; neither vectors nor
queries are ever broadcast or collected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, small_batches

SHARD_ROWS = 8_192
DEGREE = 32
BUILD_BEAM = 64
BEAM = 128
ALPHA = 1.2
BLOCK = 1_024


def _lifted(x: np.ndarray) -> np.ndarray:
    """Vectors with the component that makes all equally long."""
    sq = (x * x).sum(1)
    return np.concatenate([x, np.sqrt(np.maximum(sq.max(initial=0.0) - sq, 0))[:, None]], 1).astype(np.float32)


def beam_search(x: np.ndarray, graph: np.ndarray, entry: np.ndarray, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """For each query: the ``beam`` best nodes met and their distances, nearest first; -1 and inf fill up. Queries go in step, one expansion each."""
    n, m = len(x), len(queries)
    sq = (x * x).sum(1)
    ids = np.full((m, beam), -1, np.int64)
    dist = np.full((m, beam), np.inf, np.float32)
    done = np.ones((m, beam), bool)
    k = min(len(entry), beam)
    ids[:, :k] = entry[:k]
    dist[:, :k] = sq[entry[:k]] - 2 * queries @ x[entry[:k]].T
    done[:, :k] = False
    seen = np.zeros((m, n), bool)
    seen[:, entry[:k]] = True
    live = np.arange(m)
    while len(live):
        d = np.where(done[live], np.inf, dist[live])
        best = d.argmin(1)
        open_ = np.isfinite(d[np.arange(len(live)), best])
        live, best = live[open_], best[open_]
        if not len(live):
            break
        done[live, best] = True
        near = graph[ids[live, best]]  # live x degree, -1 where there's none
        fresh = (near >= 0) & ~seen[live[:, None], near]
        seen[live[:, None], np.where(near >= 0, near, near[:, :1])] = True
        dn = np.where(fresh, sq[near] - 2 * np.einsum("qd,qkd->qk", queries[live], x[near]), np.inf).astype(np.float32)
        all_d = np.concatenate([dist[live], dn], 1)
        all_i = np.concatenate([ids[live], np.where(fresh, near, -1)], 1)
        all_done = np.concatenate([done[live], ~fresh], 1)
        top = np.argpartition(all_d, beam - 1, 1)[:, :beam] if all_d.shape[1] > beam else np.tile(np.arange(all_d.shape[1]), (len(live), 1))
        rows = np.arange(len(live))[:, None]
        dist[live], ids[live], done[live] = all_d[rows, top], all_i[rows, top], all_done[rows, top]
    order = np.argsort(dist, 1, kind="stable")
    rows = np.arange(m)[:, None]
    return ids[rows, order], dist[rows, order]


def robust_prune(x: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each node, up to ``degree`` of its candidates: nearest first, dropping what a kept one covers."""
    m, c = candidates.shape
    valid = (candidates >= 0) & (candidates != nodes[:, None])
    order = np.sort(np.where(valid, candidates, -1), 1)
    valid = (order >= 0) & np.concatenate([np.ones((m, 1), bool), order[:, 1:] != order[:, :-1]], 1)
    v = x[order]  # m x c x dim
    sq = (x * x).sum(1)
    at = x[nodes]
    d = np.where(valid, np.maximum(sq[order] + sq[nodes][:, None] - 2 * (v @ at[:, :, None])[:, :, 0], 0), np.inf)
    by = np.argsort(d, 1)
    rows = np.arange(m)[:, None]
    order, d, v = order[rows, by], d[rows, by], v[rows, by]
    own = sq[order]
    covers = own[:, :, None] + own[:, None, :] - 2 * (v @ v.transpose(0, 2, 1))  # squared distances between candidates
    covers = covers * np.float32(alpha * alpha) <= d[:, None, :]
    alive = np.isfinite(d)
    out = np.full((m, degree), -1, np.int64)
    every = np.arange(m)
    for k in range(degree):
        first = alive.argmax(1)
        some = alive[every, first]
        if not some.any():
            break
        out[some, k] = order[every, first][some]
        alive &= ~covers[every, first]
        alive[every, first] = False
    return out


def build(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, np.ndarray]:
    """(graph n x degree with -1 for none, entry nodes) over lifted vectors."""
    n = len(x)
    graph = np.full((n, degree), -1, np.int64)
    centre = int(((x - x.mean(0)) ** 2).sum(1).argmin())
    rng = np.random.default_rng(n)
    order = np.concatenate([[centre], rng.permutation(np.delete(np.arange(n), centre))])
    entry = np.unique(np.concatenate([[centre], order[1 : 1 + min(15, max(0, n // 64))]])) if n > 64 else np.array([centre])
    order = np.concatenate([entry, order[~np.isin(order, entry)]])
    done = min(n, max(len(entry), 64))
    first = order[:done]
    graph[first] = robust_prune(x, first, np.tile(first, (done, 1)), degree, alpha)
    at = done
    while at < n:
        batch = order[at : at + min(512, max(64, at))]
        at += len(batch)
        found, _ = beam_search(x, graph, entry, x[batch], beam)
        graph[batch] = robust_prune(x, batch, found, degree, alpha)
        # Links back: into free places where there are some; else those of one target are pruned together with what it has.
        src, dst = np.repeat(batch, degree), graph[batch].ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        by = np.argsort(dst, kind="stable")
        src, dst = src[by], dst[by]
        place = np.arange(len(dst)) - np.searchsorted(dst, dst)
        used = (graph >= 0).sum(1)
        free = place + used[dst] < degree
        full = np.unique(dst[~free])
        easy = free & ~np.isin(dst, full)
        graph[dst[easy], place[easy] + used[dst[easy]]] = src[easy]
        hard = np.isin(dst, full)
        src, dst = src[hard], dst[hard]
        place = np.arange(len(dst)) - np.searchsorted(dst, dst)
        while len(dst):
            take = place < degree
            targets = np.unique(dst[take])
            extra = np.full((len(targets), int(place[take].max()) + 1), -1, np.int64)
            extra[np.searchsorted(targets, dst[take]), place[take]] = src[take]
            graph[targets] = robust_prune(x, targets, np.concatenate([graph[targets], extra], 1), degree, alpha)
            src, dst, place = src[~take], dst[~take], place[~take] - degree
    return graph, entry


def _packed(x: np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(x, kind).tobytes()


def _built(table: pa.Table, dim: int, keep: int, degree: int, beam: int, alpha: float) -> pa.Table:
    """One shard's nodes -> its index row."""
    v = np.zeros((table.num_rows, dim))
    for i, x in enumerate(table.column("vector").to_pylist()):
        v[i, : len(x)] = x
    members = np.full((table.num_rows, keep), -1, np.int64)
    for i, ids in enumerate(table.column("ids").to_pylist()):
        members[i, : len(ids)] = ids
    graph, entry = build(_lifted(v), degree, beam, alpha)
    return pa.table({
        "shard": table.column("shard")[:1], "vectors": pa.array([_packed(v, "<f8")], pa.binary()), "members": pa.array([_packed(members, "<i8")], pa.binary()),
        "graph": pa.array([_packed(graph, "<i4")], pa.binary()), "entry": pa.array([_packed(entry, "<i4")], pa.binary()),
    })


def usable(vectors: DataFrame, key: str = "vec_id", value: str = "embedding") -> DataFrame:
    """(vec_id, vector): rows whose vector holds finite numbers only, not all zero; a null id takes no part either."""
    v = F.col(value).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("vec_id"), v.alias("vector")).where((F.size("vector") > 0) & fine & F.exists("vector", lambda x: x != 0))


def index(nodes: DataFrame, keep: int, shard_rows: int = SHARD_ROWS, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA) -> tuple[DataFrame, int, int]:
    """(vec_id, vector) -> (a row per shard's index, number of shards, dimension). ``keep``: ids kept of equal vectors."""
    # Equal vectors: a task keeps the least ids of its share before they meet.
    # Adding zero makes -0 and 0 one value.
    nodes = nodes.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    least = Window.partitionBy("vector").orderBy("vec_id")
    kept = nodes.distinct().withColumn("_r", F.row_number().over(least)).where(F.col("_r") <= keep).groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    kept = cut(kept)
    n, dim = kept.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    shards = max(1, math.ceil(n / shard_rows))
    dealt = kept.withColumn("shard", F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int"))
    rows = dealt.repartition(shards, "shard").groupBy("shard").applyInArrow(lambda t: _built(t, dim, keep, degree, beam, alpha), "shard int, vectors binary, members binary, graph binary, entry binary")
    return cut(rows), shards, dim


def _searched(batches: Iterator[pa.RecordBatch], dim: int, keep: int, k: int, degree: int, beam: int) -> Iterator[pa.RecordBatch]:
    at, held = None, None
    for batch in batches:
        for r in range(batch.num_rows):
            shard = batch.column("shard")[r].as_py()
            if shard != at:
                v = np.frombuffer(batch.column("vectors")[r].as_py(), "<f8").reshape(-1, dim)
                held = v, _lifted(v), np.frombuffer(batch.column("members")[r].as_py(), "<i8").reshape(-1, keep), np.frombuffer(batch.column("graph")[r].as_py(), "<i4").reshape(-1, degree).astype(np.int64), np.frombuffer(batch.column("entry")[r].as_py(), "<i4").astype(np.int64)
                at = shard
            v, x, members, graph, entry = held
            queries = batch.column("queries")[r].as_py()
            out_q, out_v, out_s = [], [], []
            for lo in range(0, len(queries), 128):
                some = queries[lo : lo + 128]
                q = np.zeros((len(some), dim))
                for i, one in enumerate(some):
                    q[i, : len(one["vector"])] = one["vector"]
                found, _ = beam_search(x, graph, entry, np.concatenate([q, np.zeros((len(q), 1))], 1).astype(np.float32), beam)
                for i, one in enumerate(some):
                    at_nodes = found[i][found[i] >= 0]
                    exact = v[at_nodes] @ q[i]
                    ids = members[at_nodes]
                    score = np.repeat(exact, keep)
                    ids = ids.ravel()
                    fine = (ids >= 0) & (ids != one["vec_id"])
                    ids, score = ids[fine], score[fine]
                    best = np.lexsort((ids, -score))[:k]
                    out_q.append(np.full(len(best), one["vec_id"]))
                    out_v.append(ids[best])
                    out_s.append(score[best])
            flat = [np.concatenate(o) if o else np.empty(0) for o in (out_q, out_v, out_s)]
            yield pa.RecordBatch.from_arrays([pa.array(flat[0].astype(np.int64)), pa.array(flat[1].astype(np.int64)), pa.array(flat[2].astype(float))], names=["query_id", "vec_id", "score"])


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, shard_rows: int = SHARD_ROWS, degree: int = DEGREE, build_beam: int = BUILD_BEAM, beam: int = BEAM, alpha: float = ALPHA, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` best by inner product, itself left out; ties to smaller ids.

    Both inputs are (vec_id, vector) as ``usable`` gives them, with ids distinct; repeated equal rows
    count once, and of rows that share an id but not a vector each stands for itself. Vectors of
    different lengths compare as if filled up with zeros. Of equal vectors the k + 1 least ids are
    kept, as no query can need more. With fewer candidates than k all are given, if the beam holds
    them. Empty inputs give no rows.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    keep = k + 1
    rows, shards, dim = index(vectors, keep, shard_rows, degree, build_beam, alpha)
    dealt = queries.distinct().withColumn("_b", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, math.ceil(queries.count() / block)))))
    blocks = dealt.groupBy("_b").agg(F.collect_list(F.struct("vec_id", "vector")).alias("queries"))
    pairs = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    found = rows.join(pairs, "shard").drop("_b").mapInArrow(lambda it: _searched(it, dim, keep, k, degree, beam), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
