"""Approximate nearest neighbours by learned partitions.

1. A neighbour graph is built over a bounded sample of the vectors, and its
   nodes are parted into balanced groups: regions grow from spread-out seeds
   along the graph's edges, and the group with the fewest members takes the
   next free neighbour, so none can outgrow the others.
2. A small classifier (multinomial logistic regression on the vector and its
   squared length) learns the partition from the vector.
3. Every vector is indexed under its most probable partition. A query is sent
   to its most probable ones, meets their vectors, and is reranked by exact
   distance in double precision. How many it is sent to is read off the
   sample: the fewest that hold ``recall`` of the sample's own neighbours (on
   vectors without any structure that is most of them). A query whose
   partitions hold fewer than k others is sent to its next ones as well.

A partition may hold any number of vectors (a third of all may be one and the
same), and be asked by any number: members and queries are dealt into chunks
of about ``CHUNK``, which meet chunk by chunk, each meeting returns at most k candidates a query, and these are merged
by rank. Only the bounded sample and the classifier pass through the driver.

The partitions' number grows with the square root of the vectors' number, up
to ``MAX_PARTITIONS``; the sample with it, up to ``SAMPLE`` vectors (both are
documented bounds of the fit; the index holds every vector).

Defined results: a null or zero vector, one with a null or non-finite
component, or of another length than most, takes no part, neither as query
nor as candidate; equal distances go to the smaller id; rows with a null id
take no part; repeated rows of one id ask once (with the smallest of their
vectors) and are candidates each; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import read, stage_table

SAMPLE = 4096
MAX_PARTITIONS = 256
CHUNK = 4096
DEGREE = 10
RECALL = 0.96


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, v) of the vectors that take part."""
    v = F.col("v")
    own = vectors.select(F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("v"))
    own = own.filter("vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0").filter(
        F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0))
    size = own.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return own.filter(F.size("v") == (size["d"] if size else 0))


def neighbour_graph(x: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """Each row's nearest rows in the sample, in blocks."""
    square = (x ** 2).sum(axis=1)
    out = np.empty((len(x), min(degree, len(x) - 1)), dtype=np.int64)
    for a in range(0, len(x), 1024):
        d = square[a:a + 1024, None] - 2 * x[a:a + 1024] @ x.T + square
        d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf
        out[a:a + 1024] = np.argpartition(d, out.shape[1] - 1, axis=1)[:, :out.shape[1]]
    return out


def balanced_partition(x: np.ndarray, graph: np.ndarray, parts: int) -> np.ndarray:
    """Partition number of each node: regions grow along edges, the smallest
    first, then nodes move to their neighbours' majority where it has room."""
    n = len(x)
    limit = math.ceil(n / parts * 1.1)
    seeds = [int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmax())]
    far = ((x - x[seeds[0]]) ** 2).sum(axis=1)
    for _ in range(parts - 1):                               # spread-out seeds
        seeds.append(int(far.argmax()))
        far = np.minimum(far, ((x - x[seeds[-1]]) ** 2).sum(axis=1))
    part = np.full(n, -1)
    edge: list[list[int]] = [[] for _ in range(parts)]
    size = np.zeros(parts, dtype=np.int64)

    def take(i, p):
        part[i] = p
        size[p] += 1
        edge[p].extend(graph[i].tolist())
    for p, s in enumerate(seeds):
        if part[s] < 0:
            take(s, p)
    open_ = set(range(parts))
    while open_:
        p = min(open_, key=lambda q: size[q])
        while edge[p] and part[edge[p][0]] >= 0:
            edge[p].pop(0)
        if edge[p] and size[p] < limit:
            take(edge[p].pop(0), p)
        else:
            open_.discard(p)
    centre = np.stack([x[part == p].mean(axis=0) if (part == p).any() else x[seeds[p]] for p in range(parts)])
    for i in np.flatnonzero(part < 0).tolist():              # not reached: the nearest centre with room
        for p in ((centre - x[i]) ** 2).sum(axis=1).argsort().tolist():
            if size[p] < limit:
                part[i] = p
                size[p] += 1
                break
    for _ in range(4):
        for i in range(n):
            votes = np.bincount(part[graph[i]], minlength=parts)
            best = int(votes.argmax())
            if votes[best] > votes[part[i]] and size[best] < limit:
                size[part[i]] -= 1
                size[best] += 1
                part[i] = best
    return part


class Router:
    """The classifier: log probabilities of the partitions of a vector."""

    def __init__(self, x: np.ndarray, part: np.ndarray, parts: int, rounds: int = 100, rate: float = 0.5):
        self.mean, self.scale = x.mean(axis=0), x.std() + 1e-12
        z = self.inputs(x)
        # start from the centres (a Gaussian model's weights), then fit by gradient
        centre = np.stack([z[part == p].mean(axis=0) if (part == p).any() else np.zeros(z.shape[1]) for p in range(parts)])
        spread = max(float(np.mean((z - centre[part]) ** 2)), 1e-6)
        self.w, self.b = centre.T / spread, -(centre ** 2).sum(axis=1) / (2 * spread)
        one = np.eye(parts)[part]
        gw, gb = np.full(self.w.shape, 1e-3), np.full(parts, 1e-3)
        for _ in range(rounds):
            gap = (one - np.exp(self.log_p_of(z))) / len(z)
            dw, db = z.T @ gap - 1e-4 * self.w, gap.sum(axis=0)
            gw += dw ** 2
            gb += db ** 2
            self.w += rate * 0.1 * dw / np.sqrt(gw)
            self.b += rate * 0.1 * db / np.sqrt(gb)

    def inputs(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.scale
        return np.append(z, (z ** 2).mean(axis=1, keepdims=True), axis=1)

    def log_p_of(self, z: np.ndarray) -> np.ndarray:
        s = z @ self.w + self.b
        s -= s.max(axis=1, keepdims=True)
        return s - np.log(np.exp(s).sum(axis=1, keepdims=True))

    def top(self, x: np.ndarray, m: int) -> np.ndarray:
        return np.argsort(-self.log_p_of(self.inputs(x)), axis=1, kind="stable")[:, :m]


def probes_for(router: Router, x: np.ndarray, graph: np.ndarray, parts: int, recall: float) -> int:
    """Fewest probes that find the given share of the sample's neighbours."""
    order = router.top(x, parts)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(parts)[None, :], axis=1)     # each partition's place in a row's order
    needed = np.sort(np.take_along_axis(place, order[:, 0][graph], axis=1), axis=None)
    return int(needed[min(len(needed) - 1, math.ceil(recall * len(needed)) - 1)]) + 1


def fit_router(own: DataFrame, sample: int = SAMPLE, max_partitions: int = MAX_PARTITIONS,
               recall: float = RECALL) -> tuple[Router | None, int, int]:
    """Router, number of partitions and probes, from a bounded sample of distinct vectors."""
    n = own.count()
    if not n:
        return None, 0, 0
    parts = int(min(max_partitions, max(1, round(math.sqrt(n) / 8))))
    size = min(sample, max(256, 64 * parts))
    rows = own.select("vec_id", "v").orderBy(F.xxhash64("vec_id"), "vec_id").limit(size).collect()
    x = np.unique(np.array([r["v"] for r in rows], dtype=np.float64), axis=0)
    parts = min(parts, len(x))
    if parts < 2:
        return Router(x, np.zeros(len(x), dtype=np.int64), 1, rounds=0), 1, 1
    graph = neighbour_graph(x)
    router = Router(x, balanced_partition(x, graph, parts), parts)
    return router, parts, probes_for(router, x, graph, parts, recall)


def nearest(queries: pd.DataFrame, members: pd.DataFrame, k: int) -> pd.DataFrame:
    """Each query's k nearest of the members: exact, ties to the smaller id."""
    q = np.stack(queries["q"].to_numpy())
    m = np.stack(members["v"].to_numpy())
    ids = members["vec_id"].to_numpy()
    rough = (q ** 2).sum(axis=1)[:, None] - 2 * q @ m.T + (m ** 2).sum(axis=1)
    slack = 1e-9 * ((q ** 2).sum(axis=1)[:, None] + (m ** 2).sum(axis=1).max())
    out = []
    for i, query in enumerate(queries["query_id"].to_numpy()):
        other = np.flatnonzero(ids != query)
        if not len(other):
            continue
        d = rough[i, other]
        want = min(k, len(other))
        near = other[d <= np.partition(d, want - 1)[want - 1] + 2 * slack[i, 0]]
        exact = np.sqrt(((m[near] - q[i]) ** 2).sum(axis=1))
        best = np.lexsort((ids[near], exact))[:want]
        out.append(pd.DataFrame({"query_id": query, "vec_id": ids[near[best]], "score": exact[best]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
        {"query_id": "int64", "vec_id": "int64", "score": "float64"})


def dealt(routed: DataFrame, is_query, size: int = CHUNK, cover=None) -> tuple[DataFrame, DataFrame]:
    """The queries and the members of ``routed`` (vec_id, v, parts), both
    dealt into chunks of about ``size``: each query of a partition meets each
    of its members in one (part, chunk, query_chunk)."""
    def chunks(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / F.lit(size)).cast("int").alias(name))
    members = routed.select("vec_id", "v", F.col("parts")[0].alias("part"))
    asked = routed.filter(is_query).groupBy(F.col("vec_id").alias("query_id")).agg(
        F.min(F.struct("v", "parts")).alias("a"), F.count(F.lit(1)).alias("own"))
    asked = asked.select("query_id", F.col("a.v").alias("q"), F.col("a.parts").alias("parts"), "own")
    if cover is not None:                                    # more partitions for queries that need them
        asked = asked.mapInPandas(cover, "query_id bigint, q array<double>, parts array<int>, own bigint")
    asked = asked.select("query_id", "q", F.explode("parts").alias("part"))
    both = chunks(members, "chunks").join(chunks(asked, "query_chunks"), "part")
    members = members.join(both, "part").withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.col("chunks")).cast("int"))
    asked = asked.join(both, "part").withColumn("query_chunk", F.pmod(F.xxhash64("query_id"), F.col("query_chunks")).cast("int"))
    return (asked.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))),
            members.withColumn("query_chunk", F.explode(F.sequence(F.lit(0), F.col("query_chunks") - 1))))


def search(vectors: DataFrame, is_query, k: int = 10, recall: float = RECALL, vec_id: str = "vec_id",
           embedding: str = "embedding", sample: int = SAMPLE, max_partitions: int = MAX_PARTITIONS) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows where ``is_query`` (a
    condition on vec_id) holds, against all other rows."""
    spark = vectors.sparkSession
    own = usable(vectors, vec_id, embedding)
    router, parts, most = fit_router(own, sample, max_partitions, recall)
    if router is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    sent = spark.sparkContext.broadcast(router)

    def route(frames):
        for f in frames:
            if len(f):
                x = np.stack(f["v"].to_numpy())
                yield f.assign(parts=list(sent.value.top(x, 1).astype(np.int32)))      # queries get theirs in ``cover``
    routed = stage_table(own.mapInPandas(route, "vec_id bigint, v array<double>, parts array<int>"), "routed-vectors")
    counts = np.zeros(parts, dtype=np.int64)
    for r in routed.groupBy(F.col("parts")[0].alias("part")).agg(F.count(F.lit(1)).alias("n")).collect():   # a row a partition
        counts[r["part"]] = r["n"]

    def cover(frames):
        for f in frames:
            if len(f):
                order = sent.value.top(np.stack(f["q"].to_numpy()), parts)
                held = np.cumsum(counts[order], axis=1)
                needed = (held < (k + f["own"].to_numpy())[:, None]).sum(axis=1) + 1   # its own rows are no candidates
                yield f.assign(parts=[o[:max(most, m)].astype(np.int32) for o, m in zip(order, needed.tolist())])
    asked, members = dealt(routed, is_query, cover=cover)

    def meet(q: pd.DataFrame, m: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(m):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
                {"query_id": "int64", "vec_id": "int64", "score": "float64"})
        return nearest(q, m, k)
    place = ["part", "chunk", "query_chunk"]
    met = asked.select(*place, "query_id", "q").groupBy(*place).cogroup(
        members.select(*place, "vec_id", "v").groupBy(*place)).applyInPandas(
        meet, "query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))   # at most k a chunk met
    return met.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    """op8: ten nearest neighbours of every hundredth vector."""
    return search(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 100 == 0)


def brute_force(ids: list[int], vectors: list, queries: list[int], k: int = 10) -> dict[int, list[tuple[int, float]]]:
    """Exact answer for tests and recall."""
    x = np.array(vectors, dtype=np.float64)
    at = {i: p for p, i in enumerate(ids)}
    keys = np.array(ids)
    out = {}
    for q in queries:
        d = np.sqrt(((x - x[at[q]]) ** 2).sum(axis=1))
        other = keys != q
        best = np.lexsort((keys[other], d[other]))[:k]
        out[q] = list(zip(keys[other][best].tolist(), d[other][best].tolist()))
    return out
