"""Approximate nearest neighbours by inner product: a forest of random-projection trees, then exact reranking."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .batches import tidied
from .staging import stage
from .vectors import clean, matrix

#: Sample vectors that a node needs for its own split; queries and candidates whose products are computed together.
SUPPORT, CHUNK = 32, 1024
#: Leaves that are split into parts are at most this many.
PARTED = 20_000


@dataclass(frozen=True)
class Forest:
    """Binary trees of any depth: a level of a tree has a direction, orthogonal to those above it, and its nodes have splits.

    Nodes with SUPPORT vectors of the sample are split at their median, deeper ones at the
    level's, so the trees' depth does not depend on the sample's size. Vectors get one more
    component that makes all of equal length, and queries a zero there, so that the largest
    inner product is the smallest angle.
    """

    directions: np.ndarray  # trees x depth x (dim + 1)
    splits: list[np.ndarray]  # for each of the top levels: trees x 2**level
    medians: np.ndarray  # trees x depth
    norm: float
    #: Leaves that a query visits.
    visits: int = 1

    @property
    def trees(self) -> int:
        return len(self.directions)

    @property
    def depth(self) -> int:
        return self.directions.shape[1]

    @property
    def leaves(self) -> int:
        return self.trees << self.depth

    def lift(self, v: np.ndarray) -> np.ndarray:
        return np.hstack([v, np.sqrt(np.maximum(self.norm**2 - (v * v).sum(1), 0))[:, None]])

    def split(self, tree: np.ndarray | int, level: int, node: np.ndarray) -> np.ndarray:
        return self.splits[level][tree, node] if level < len(self.splits) else np.broadcast_to(self.medians[tree, level], node.shape)

    def place(self, v: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree, numbered through the forest."""
        x, out = self.lift(v), []
        for t in range(self.trees):
            along, node = x @ self.directions[t].T, np.zeros(len(x), np.int64)
            for level in range(self.depth):
                node = 2 * node + (along[:, level] > self.split(t, level, node))
            out.append(node + (t << self.depth))
        return np.stack(out, 1)

    def search(self, q: np.ndarray, most: int) -> np.ndarray:
        """The first ``most`` leaves of each query out of one priority queue shared by all trees; -1 where there are no more.

        A node's priority is the squared distance over the splits crossed on the way to it. The
        lowest node is taken out and followed down to the leaf on the query's own side; the
        nodes on the other side of each split passed are put in. Only nodes that are reached
        are looked at. All queries advance together.
        """
        n, trees, depth = len(q), self.trees, self.depth
        along = np.stack([np.hstack([q, np.zeros((n, 1))]) @ d.T for d in self.directions], 1)  # n x trees x depth
        size, room = np.full(n, trees), trees + most * depth
        priority = np.full((n, room), np.inf)
        tree, level, node = (np.zeros((n, room), np.int64) for _ in range(3))
        priority[:, :trees], tree[:, :trees] = 0, np.arange(trees)
        out, at = np.full((n, most), -1, np.int64), np.arange(n)
        for k in range(most):
            low = priority[:, : int(size.max())].argmin(1)
            cost = priority[at, low]
            if not np.isfinite(cost).any():
                break
            t, lv, nd = tree[at, low], level[at, low], node[at, low]
            priority[at, low] = np.inf
            for depth_ in range(depth):
                go = np.flatnonzero((lv == depth_) & np.isfinite(cost))
                if len(go):
                    over = along[go, t[go], depth_] - self.split(t[go], depth_, nd[go])
                    near = 2 * nd[go] + (over > 0)
                    s = size[go]
                    priority[go, s], tree[go, s], level[go, s], node[go, s] = cost[go] + over**2, t[go], depth_ + 1, near ^ 1
                    size[go] += 1
                    nd[go], lv[go] = near, depth_ + 1
            out[:, k] = np.where(np.isfinite(cost), nd + (t << depth), -1)
        return out


def grow(sample: np.ndarray, norm: float, depth: int, trees: int, seed: int = 0) -> Forest:
    """Random directions, split at the sample's medians."""
    rng, dim = np.random.default_rng(seed), sample.shape[1] + 1
    directions = np.zeros((trees, depth, dim))
    for t in range(trees):
        for lo in range(0, depth, dim):
            directions[t, lo : lo + dim] = np.linalg.qr(rng.normal(size=(dim, dim)))[0][: depth - lo]
    top = min(depth, max(0, int(np.log2(max(1, len(sample) / SUPPORT)))))
    forest = Forest(directions, [np.zeros((trees, 1 << level)) for level in range(top)], np.zeros((trees, depth)), norm)
    x = forest.lift(sample)
    for t in range(trees):
        along, node = x @ directions[t].T, np.zeros(len(x), np.int64)
        forest.medians[t] = np.median(along, 0)
        for level in range(top):
            order = np.lexsort((along[:, level], node))
            bounds = np.searchsorted(node[order], np.arange((1 << level) + 1))
            for k, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
                forest.splits[level][t, k] = np.median(along[order[lo:hi], level]) if hi > lo else forest.medians[t, level]
            node = 2 * node + (along[:, level] > forest.splits[level][t, node])
    return forest


def calibrate(forest: Forest, queries: np.ndarray, leaves: list[np.ndarray], target: float) -> int:
    """Fewest leaves, out of the queue, that hold ``target`` of the queries' true neighbours, whose leaves are given."""
    most = 16
    while True:
        most = min(most, forest.leaves)
        order, ranks = forest.search(queries, most), []
        for own, near in zip(order, leaves):
            rank = {leaf: k for k, leaf in enumerate(own.tolist())}
            ranks += [min(rank.get(leaf, forest.leaves) for leaf in each) for each in near.tolist()]
        need = int(np.ceil(target * len(ranks)))
        found = int(np.sort(ranks)[need - 1]) + 1 if need else 1
        if found <= most or most == forest.leaves:
            return min(found, most)
        most *= 2


def _merge(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of (id, score), ids once, ties to smaller ids."""
    order = np.lexsort((ids, -scores))
    ids, scores = ids[order], scores[order]
    first = np.sort(np.unique(ids, return_index=True)[1])[:k]
    return ids[first], scores[first]


def _best(near: np.ndarray, k: int, slack: float) -> np.ndarray:
    """Which products are among the k largest of their row, or so near them that only exact ones decide."""
    if near.shape[1] <= k:
        return np.ones(near.shape, bool)
    return near >= np.partition(near, near.shape[1] - k, 1)[:, near.shape[1] - k, None] - slack


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, trees: int = 4, leaf_rows: int = 512, sample_rows: int = 20_000, target: float = 0.93, queries: int = 256, report: dict[str, float] | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products found for every query row, all rows being indexed.

    ``is_query`` is a condition on vec_id. The trees' splits come from ``sample_rows`` vectors
    chosen by a hash of their id; the trees are as deep as the whole table needs for leaves of
    about ``leaf_rows``. The number of leaves that a query visits is the least that holds
    ``target`` of the true neighbours, in the whole table, of ``queries`` sample vectors, which
    are compared with all rows. How much of the table that is depends on the data: vectors
    without clusters in many dimensions have neighbours in most leaves. ``report`` receives
    ``visits``, ``leaves`` and ``rows`` (scored per query on average).

    Equal vectors are one entry with their k + 1 smallest ids, which are all that a result can
    hold. Leaves with many rows are split over several groups, so no group grows with the data;
    a task keeps k results per query it meets. Vectors that are null, zero or hold null or
    non-finite components take no part; of several vectors of one vec_id the smallest counts,
    repeated rows count once; an empty table gives an empty result; other columns are not
    looked at.
    """
    spark = vectors.sparkSession
    rows = stage(clean(vectors).groupBy("vec_id").agg(F.min("v").alias("v")), "vectors")
    best = W.partitionBy("v").orderBy("vec_id")
    entries = rows.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).groupBy("v").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))
    entries = stage(entries, "entries")
    count, norm = entries.agg(F.count("*"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if not count:
        return spark.createDataFrame([], schema)
    picked = entries.select("v", F.get("ids", 0).alias("id"), F.xxhash64(F.get("ids", 0)).alias("h")).orderBy("h").limit(sample_rows).toPandas()
    sample = np.stack(picked["v"].to_numpy())
    depth = max(0, int(np.ceil(np.log2(max(1.0, count / leaf_rows)))))
    forest = grow(sample, float(norm) * (1 + 1e-9), depth, trees)
    slack = 1e-12 * float(norm) ** 2

    asked_ids, asked_v = picked["id"].to_numpy()[:queries], sample[:queries]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A task's nearest entries of each sample query, with their leaves."""
        held = [(np.zeros(0, np.int64), np.zeros(0), np.zeros((0, trees), np.int64)) for _ in asked_ids]
        for b in batches:
            for at in range(0, b.num_rows, CHUNK):
                part = b.slice(at, CHUNK)
                ids, v = part.column(0).to_numpy(), matrix(part.column(1))
                near, leaf = asked_v @ v.T, forest.place(v)
                near[asked_ids[:, None] == ids[None, :]] = -np.inf
                some = _best(near, k, 0.0)
                for q, (i, s, own) in enumerate(held):
                    c = np.flatnonzero(some[q] & np.isfinite(near[q]))
                    i, s, own = np.concatenate([i, ids[c]]), np.concatenate([s, near[q, c]]), np.concatenate([own, leaf[c]])
                    order = np.lexsort((i, -s))[:k]
                    held[q] = i[order], s[order], own[order]
        out = [(q, float(s), leaf.tolist()) for q, (_, scores, leaves) in enumerate(held) for s, leaf in zip(scores, leaves)]
        yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in out], t) for j, t in enumerate((pa.int32(), pa.float64(), pa.list_(pa.int64())))], ["q", "s", "leaves"])

    own = entries.select(F.get("ids", 0).alias("id"), "v").mapInArrow(tidied(compare), "q int, s double, leaves array<long>")
    own = own.withColumn("n", F.row_number().over(W.partitionBy("q").orderBy(F.desc("s")))).where(F.col("n") <= k).select("q", "leaves").toPandas()
    if len(own):
        asked = sorted(own["q"].unique())
        visits = calibrate(forest, asked_v[asked], [np.stack(own[own["q"] == q]["leaves"].to_numpy()) for q in asked], target)
    else:
        visits = 1
    forest = replace(forest, visits=visits)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                leaf = forest.place(matrix(b.column(1)))
                take = pa.array(np.repeat(np.arange(len(leaf)), leaf.shape[1]))
                yield pa.RecordBatch.from_arrays([pa.array(leaf.ravel()), b.column(0).take(take), b.column(1).take(take)], ["leaf", "ids", "v"])

    def seek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, CHUNK):
                part = b.slice(at, CHUNK)
                leaf = forest.search(matrix(part.column(1)), forest.visits)
                row, col = np.nonzero(leaf >= 0)
                yield pa.RecordBatch.from_arrays([pa.array(leaf[row, col]), part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row))], ["leaf", "query_id", "v"])

    placed = entries.select("ids", "v").mapInArrow(tidied(index), "leaf long, ids array<long>, v array<double>")
    most = max(4 * leaf_rows, -(-count * trees // PARTED))
    sizes = stage(placed.groupBy("leaf").count(), "leaves")
    parted = F.broadcast(sizes.where(F.col("count") > most).select("leaf", F.ceil(F.col("count") / most).cast("int").alias("parts")))
    parts = F.coalesce("parts", F.lit(1))
    asked = rows.where(is_query).mapInArrow(tidied(seek), "leaf long, query_id long, v array<double>")
    side = placed.join(parted, "leaf", "left").select("leaf", F.pmod(F.xxhash64(F.get("ids", 0)), parts).cast("int").alias("part"), F.lit(None).cast("long").alias("query_id"), "ids", "v")
    asked = asked.join(parted, "leaf", "left").select("leaf", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), "query_id", F.lit(None).cast("array<long>").alias("ids"), "v")
    if report is not None:
        scored = asked.where("part = 0").groupBy("leaf").agg(F.count("*").alias("q")).join(sizes, "leaf").agg(F.sum(F.col("q") * F.col("count"))).first()[0] or 0
        report |= {"visits": visits, "leaves": forest.leaves, "rows": scored / max(1, rows.where(is_query).count())}

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        at, own_ids, own_v, v = None, [], [], None

        def out() -> pa.RecordBatch:
            got = [(q, i.tolist(), s.tolist()) for q, (i, s) in held.items()]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in got], pa.int64()), pa.array([x[1] for x in got], pa.list_(pa.int64())), pa.array([x[2] for x in got], pa.list_(pa.float64()))], ["query_id", "ids", "scores"])

        for b in batches:
            leaf, part = b.column(0).to_numpy(), b.column(1).to_numpy()
            edges = [0, *(np.flatnonzero((np.diff(leaf) != 0) | (np.diff(part) != 0)) + 1).tolist(), len(leaf)]
            for lo, hi in zip(edges, edges[1:]):
                if lo == hi:
                    continue
                if (leaf[lo], part[lo]) != at:
                    at, own_ids, own_v, v = (leaf[lo], part[lo]), [], [], None
                run = b.slice(lo, hi - lo)
                asks = run.column(2).is_valid().to_numpy(zero_copy_only=False)
                first = int(asks.argmax()) if asks.any() else len(asks)
                if first:
                    own = run.slice(0, first)
                    own_ids += own.column(3).to_pylist()
                    own_v.append(matrix(own.column(4)))
                if first == len(asks) or not own_v:
                    continue
                v = np.concatenate(own_v) if v is None else v
                run = run.slice(first)
                for a in range(0, run.num_rows, CHUNK):
                    some = run.slice(a, CHUNK)
                    x, found = matrix(some.column(4)), {}
                    for c in range(0, len(v), 4 * CHUNK):
                        block = v[c : c + 4 * CHUNK]
                        hit = _best(x @ block.T, k + 1, slack)
                        r, j = np.nonzero(hit)
                        exact = (x[r] * block[j]).sum(1)
                        for row, col, s in zip(r.tolist(), j.tolist(), exact.tolist()):
                            found.setdefault(row, []).append((c + col, s))
                    for row, q in enumerate(some.column(2).to_pylist()):
                        pairs = [(i, s) for col, s in found.get(row, []) for i in own_ids[col] if i != q]
                        ids, scores = np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs])
                        if q in held:
                            ids, scores = np.concatenate([held[q][0], ids]), np.concatenate([held[q][1], scores])
                        held[q] = _merge(ids, scores, k)
                if len(held) > 200_000:
                    yield out()
        if held:
            yield out()

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, ids, scores = None, [], []

        def out() -> pa.RecordBatch:
            i, s = _merge(np.array(ids, np.int64), np.array(scores), k)
            n = len(i)
            return pa.RecordBatch.from_arrays([pa.array(np.full(n, q)), pa.array(np.arange(1, n + 1, dtype=np.int32)), pa.array(i), pa.array(s)], ["query_id", "rank", "vec_id", "score"])

        for b in batches:
            for own, i, s in zip(*(c.to_pylist() for c in b.columns)):
                if own != q:
                    if q is not None:
                        yield out()
                    q, ids, scores = own, [], []
                ids += i
                scores += s
        if q is not None:
            yield out()

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    together = side.union(asked).repartition(n, "leaf", "part").sortWithinPartitions("leaf", "part", F.asc_nulls_first("query_id"))
    partial = together.mapInArrow(tidied(search), "query_id long, ids array<long>, scores array<double>")
    return partial.repartition(n, "query_id").sortWithinPartitions("query_id").mapInArrow(tidied(finish), schema)
