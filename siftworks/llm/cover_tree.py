"""Exact threshold pairs of embeddings by dual traversal of cover trees."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import tidied
from .graph import components
from .joins import hub_join
from .staging import stage
from .vectors import clean, matrix

#: Slack for rounding when bounds decide instead of products.
EPS = 1e-7
#: Rows of one side whose distances to the other side are computed together, in traversals and in building.
CHUNK, BATCH = 1024, 64


@dataclass
class Tree:
    """A cover tree of the rows of x, its nodes in depth-first order.

    Level k has the radius ``top / 2**k``. Nodes of a level are farther apart than its radius
    (separation), each node is within the radius of the level above of its parent (covering),
    and a node is its own child on every level below (nesting). A point is stored once, at
    the highest of its levels; ``order`` lists points depth first, so the points below
    node i are those at places i to ``last[i]``, and all are within ``radius[i]`` of it.
    """

    order: np.ndarray  # row of x at each place
    level: np.ndarray  # highest level of the point at each place
    parent: np.ndarray  # place of its parent; the root is its own
    last: np.ndarray  # the place after the last one below it
    radius: np.ndarray  # farthest distance to a point below it
    top: float


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Between unit vectors."""
    return np.sqrt(np.maximum(2 - 2 * x @ y.T, 0))


def build(x: np.ndarray) -> Tree:
    """The nested nets of unit vectors, level by level: every point not within a level's radius of one of its nodes becomes a node.

    Equal rows (or those at a distance below 1e-7, where rounding decides) are put below their first.
    """
    n = len(x)
    d = distances(x[:1], x)[0]
    top = max(float(d.max()), 1e-6)
    level, parent = np.full(n, -1, np.int64), np.zeros(n, np.int64)
    level[0] = 0
    near, own = d.copy(), np.zeros(n, np.int64)  # nearest node of the levels so far, and its distance
    k = 0
    while (level < 0).any():
        k += 1
        r = top / 2**k
        above = own.copy()
        if r < 1e-7:
            rest = np.flatnonzero(level < 0)
            level[rest], parent[rest] = k, above[rest]
            break
        while len(rest := np.flatnonzero((level < 0) & (near > r))[:BATCH]):
            for p, d in zip(rest.tolist(), distances(x[rest], x)):
                if near[p] > r:  # not covered by one just before it
                    level[p], parent[p] = k, above[p]
                    closer = d < near
                    near[closer], own[closer] = d[closer], p
                    near[p], own[p] = 0.0, p
    children: list[list[int]] = [[] for _ in range(n)]
    for p in np.lexsort((np.arange(n), level)).tolist():
        if p != 0:
            children[int(parent[p])].append(p)
    order, stack = [], [0]
    while stack:
        p = stack.pop()
        order.append(p)
        stack += children[p][::-1]
    order = np.array(order)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    up, last = place[parent[order]], np.arange(1, n + 1)
    for i in range(n - 1, 0, -1):
        last[up[i]] = max(last[up[i]], last[i])
    radius = np.zeros(n)
    for i in np.flatnonzero(last > np.arange(n) + 1).tolist():
        radius[i] = distances(x[order[i : i + 1]], x[order[i : last[i]]]).max()
    return Tree(order, level[order], up, last, radius, top)


class Forest:
    """Some points of a tree, in its order: each stays below its nearest ancestor that is there, whose radius still covers it."""

    def __init__(self, place: np.ndarray, last: np.ndarray, radius: np.ndarray) -> None:
        self.last, self.radius = np.searchsorted(place, last), radius
        roots, self._kids, stack = [], {}, []
        for i, end in enumerate(self.last.tolist()):
            while stack and stack[-1][1] <= i:
                stack.pop()
            if stack:
                self._kids[stack[-1][0]].append(i)
            else:
                roots.append(i)
            if end > i + 1:
                stack.append((i, end))
                self._kids[i] = [i]
        self.roots = np.array(roots, np.int64)

    def children(self, i: int) -> np.ndarray:
        """Of a node with something below it: its own point, then the nodes below."""
        return np.array(self._kids[i], np.int64)


class Pairs:
    """Links between the rows of x and y (or within x), both in the order of their trees.

    ``nx`` and ``ny`` sum up the weights of each row's partners; ``parent`` joins linked rows.
    ``seen`` counts the products that were computed.
    """

    def __init__(self, x: np.ndarray, wx: np.ndarray, y: np.ndarray | None, wy: np.ndarray | None, threshold: float) -> None:
        self.same = y is None
        self.x, self.wx = x, wx
        self.y, self.wy = (x, wx) if y is None else (y, wy)
        self.least, self.reach = threshold, float(np.sqrt(max(0.0, 2 - 2 * threshold)))
        self.nx, self.ny = np.zeros(len(x), np.int64), np.zeros(len(self.y), np.int64)
        self.parent = np.arange(len(x) + (0 if self.same else len(self.y)))
        self.shift = 0 if self.same else len(x)
        self.seen, self.todo = 0, []

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, rows: np.ndarray) -> None:
        roots = sorted({self.root(int(i)) for i in rows})
        for r in roots[1:]:
            self.parent[r] = roots[0]

    def link(self, rows: np.ndarray, cols: np.ndarray, hit: np.ndarray) -> None:
        """Single points rows x cols that are linked where ``hit``."""
        r, c = hit.any(1), hit.any(0)
        if not r.any():
            return
        hit, rows, cols = hit[np.ix_(r, c)], rows[r], cols[c]
        self.nx[rows] += hit @ self.wy[cols]
        self.ny[cols] += hit.T @ self.wx[rows]
        label = np.arange(len(cols))  # joined through common rows until nothing changes
        while True:
            of_row = np.where(hit, label[None, :], len(cols)).min(1)
            new = np.where(hit, of_row[:, None], len(cols)).min(0)
            if (new == label).all():
                break
            label = new
        for k in np.unique(of_row):
            self.join(np.concatenate([rows[of_row == k], self.shift + cols[label == k]]))

    def join_ranges(self, a: slice, b: slice | None) -> None:
        """All points of the range(s) are linked with each other."""
        rows = np.arange(a.start, a.stop)
        if b is None:
            self.nx[a] += self.wx[a].sum() - self.wx[a]
            self.join(rows)
        else:
            self.nx[a] += self.wy[b].sum()
            self.ny[b] += self.wx[a].sum()
            self.join(np.concatenate([rows, self.shift + np.arange(b.start, b.stop)]))

    def walk(self, s: "Forest", t: "Forest") -> None:
        """Down both forests at once. Node pairs whose covering balls are too far apart go; those wholly within reach are linked as they are."""
        self._meet(s, t, s.roots, np.ones(len(s.roots), bool), t.roots, np.ones(len(t.roots), bool), self.same)
        while self.todo:
            i, j = self.todo.pop()
            a, b = s.children(i), t.children(j)
            self._meet(s, t, a, a != i, b, b != j, self.same and i == j)

    def _meet(self, s: "Forest", t: "Forest", a: np.ndarray, wide_a: np.ndarray, b: np.ndarray, wide_b: np.ndarray, own: bool) -> None:
        """Nodes a of one forest against b of the other; those not ``wide`` stand for their own point alone. own: a and b are the same nodes."""
        wide_a, wide_b = wide_a & (s.last[a] > a + 1), wide_b & (t.last[b] > b + 1)
        ra, rb = np.where(wide_a, s.radius[a], 0.0), np.where(wide_b, t.radius[b], 0.0)
        for lo in range(0, len(a), CHUNK):
            rows, rr, ww = a[lo : lo + CHUNK], ra[lo : lo + CHUNK], wide_a[lo : lo + CHUNK]
            cos = self.x[rows] @ self.y[b].T
            self.seen += cos.size // (2 if own else 1)
            d = np.sqrt(np.maximum(2 - 2 * cos, 0))
            on = d - rr[:, None] - rb[None, :] <= self.reach + EPS
            if own:  # each pair of children once, a child with itself if there is something below it
                k = np.arange(lo, lo + len(rows))
                on &= k[:, None] <= np.arange(len(b))[None, :]
                on[k - lo, k] &= ww
            if not on.any():
                continue
            single = ~(ww[:, None] | wide_b[None, :])
            self.link(rows, b, on & single & (cos >= self.least))
            for p, q in np.argwhere(on & ~single).tolist():
                u, v = int(rows[p]), int(b[q])
                x, y = slice(u, int(s.last[u]) if ww[p] else u + 1), slice(v, int(t.last[v]) if wide_b[q] else v + 1)
                if own and u == v:
                    if 2 * rr[p] < self.reach - EPS:
                        self.join_ranges(x, None)
                    else:
                        self.todo.append((u, v))
                elif d[p, q] + rr[p] + rb[q] < self.reach - EPS:
                    self.join_ranges(x, y)
                elif ww[p] and wide_b[q]:
                    self.todo.append((u, v))
                else:
                    self.leaf(x, y)

    def leaf(self, a: slice, b: slice) -> None:
        """One point against what is below a node."""
        rows, cols = np.arange(a.start, a.stop), np.arange(b.start, b.stop)
        self.seen += len(rows) * len(cols)
        self.link(rows, cols, self.x[a] @ self.y[b].T >= self.least)


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(1, keepdims=True)  # no overflow or underflow in the squares
    return v / np.linalg.norm(v, axis=1, keepdims=True)


FOUND = "id long, links long, root long"


def net(x: np.ndarray, radius: float, most: int) -> np.ndarray:
    """Farthest-first centers until all rows are within ``radius`` of one, or ``most``.

    The first k centers are a net for the k-th distance, so prefixes are the nested levels.
    """
    centers, near = [0], distances(x[:1], x)[0]
    while len(centers) < most and near.max() > radius:
        centers.append(int(near.argmax()))
        near = np.minimum(near, distances(x[centers[-1:]], x)[0])
    return np.array(centers)


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, block_rows: int = 4096, sample_rows: int = 4096, cells: int = 256, report: dict[str, int] | None = None) -> DataFrame:
    """``vectors`` with n_links, component_id and kept, replaced if there: all pairs of cosine >= ``threshold`` count.

    Equal vectors are reduced to one entry with their number. A sample gives the upper levels:
    ``cells`` nested centers. Every entry goes to its nearest center; cells are put together,
    or split, into blocks of about ``block_rows``, each of which becomes one cover tree. An
    entry meets another block only if a cell's covering radius, taken over all entries, leaves a
    partner possible; there the two trees are traversed together. That gives per entry a number
    and a root, so groups of near copies are never written out as pairs. How much is pruned
    depends on the data: vectors without any cluster, in many dimensions, leave all pairs, as
    their distances hardly differ. ``report`` receives the numbers of products computed
    (``products``) and of all pairs (``pairs``).

    Vectors that are null, zero or hold null or non-finite components link with nothing and
    are their own component; vectors of several lengths are compared within a length. A null
    vec_id takes no part and has null component_id. Repeated rows count as one vector; of
    several vectors of one vec_id the smallest counts. Other columns pass through.
    """
    kind = dict(vectors.dtypes)["embedding"]
    rows = clean(vectors, kind=kind if kind in ("array<float>", "array<double>") else "array<double>").groupBy("vec_id").agg(F.min("v").alias("v"))
    rows = stage(rows, "vectors")
    entries = stage(rows.groupBy("v").agg(F.min("vec_id").alias("id"), F.count("*").alias("w")), "entries")
    found = [(n, stage(_pairs(entries.where(F.size("v") == dim), threshold, block_rows, sample_rows, cells), "pairs")) for dim, n in entries.groupBy(F.size("v")).count().collect()]
    out = vectors.drop("n_links", "component_id", "kept")
    links = vectors.sparkSession.createDataFrame([], FOUND)
    for _, f in found:
        links = links.union(f)
    if report is not None:
        report["pairs"] = sum(n * (n - 1) // 2 for n, _ in found)
        report["products"] = links.where("id is null").agg(F.sum("links")).first()[0] or 0
    links = links.where("id is not null")
    groups = components(links.select(F.col("id").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "id")
    of_entry = entries.join(links.groupBy("id").agg(F.sum("links").alias("links")), "id", "left").join(groups, "id", "left")
    of_entry = of_entry.select("v", "w", (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    of_vector = hub_join(rows, of_entry, ["v"], "w", rows.count()).select(F.col("vec_id").alias("_id"), "n_links", "component_id")
    own = F.col("vec_id").cast("long")
    out = out.withColumnRenamed("_id", "_id_") if "_id" in out.columns else out
    out = out.join(of_vector, own == F.col("_id"), "left").drop("_id")
    out = out.withColumnRenamed("_id_", "_id") if "_id" in vectors.columns else out
    return out.withColumns({"n_links": F.coalesce("n_links", F.lit(0).cast("long")), "component_id": F.coalesce("component_id", own)}).withColumn("kept", own == F.col("component_id"))


def _blocks(sizes: dict[int, tuple[int, float]], between: np.ndarray, block_rows: int) -> tuple[list[list[int]], np.ndarray, np.ndarray]:
    """Cells put together to blocks, in the order of the nested nets' tree so that neighbours share one; each cell's first block and number of blocks."""
    parent = [0] + [int(between[k, :k].argmin()) for k in range(1, len(between))]
    order, stack = [], [0]
    while stack:
        k = stack.pop()
        order.append(k)
        stack += [c for c in range(len(between) - 1, 0, -1) if parent[c] == k]
    first, parts = np.zeros(len(between), np.int64), np.zeros(len(between), np.int64)
    blocks: list[list[int]] = []
    room = 0
    for c in order:
        n = sizes.get(c, (0, 0))[0]
        if n > block_rows:
            first[c], parts[c], room = len(blocks), -(-n // block_rows), 0
            blocks += [[c]] * int(parts[c])
        elif n:
            if n > room:
                blocks.append([])
                room = block_rows
            blocks[-1].append(c)
            first[c], parts[c], room = len(blocks) - 1, 1, room - n
    return blocks, first, parts


def _pairs(entries: DataFrame, threshold: float, block_rows: int, sample_rows: int, cells: int) -> DataFrame:
    """(id, links, root) of each linked entry in each pair of blocks, and the products computed, as links, under a null id."""
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + EPS
    picked = entries.select("v", F.xxhash64("id").alias("h")).orderBy("h").limit(sample_rows).toPandas()
    sample = _unit(np.stack(picked["v"].to_numpy()).astype(np.float64))
    pivots = sample[net(sample, reach / 2, cells)]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                d = distances(_unit(matrix(b.column(2))), pivots)
                yield pa.RecordBatch.from_arrays(b.columns + [pa.array(d.argmin(1)), pa.array(d.min(1))], ["id", "w", "v", "cell", "d"])

    element = dict(entries.dtypes)["v"]
    placed = entries.select("id", "w", "v").mapInArrow(tidied(assign), f"id long, w long, v {element}, cell long, d double")
    sizes = {c: (n, r) for c, n, r in placed.groupBy("cell").agg(F.count("*"), F.max("d")).collect()}
    blocks, first, parts = _blocks(sizes, distances(pivots, pivots), block_rows)
    n_blocks = len(blocks)
    member = np.zeros((len(pivots), n_blocks), bool)
    for k, own in enumerate(blocks):
        member[own, k] = True
    radius = np.array([sizes.get(c, (0, -np.inf))[1] for c in range(len(pivots))])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell, ids = b.column(3).to_numpy(), b.column(0).to_numpy()
            part = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % np.maximum(parts[cell], 1)
            yield pa.RecordBatch.from_arrays([pa.array(first[cell] + part), *b.columns[:3]], ["block", "id", "w", "v"])

    def plant(block: pa.Table) -> pa.Table:
        block = block.take(pc.sort_indices(block.column("id")))  # the tree depends on the rows only
        tree = build(_unit(matrix(block.column("v"))))
        block = block.take(pa.array(tree.order))
        more = {"place": np.arange(len(tree.order)), "last": tree.last, "radius": tree.radius}
        for name, x in more.items():
            block = block.append_column(name, pa.array(x))
        return block

    node = f"id long, w long, v {element}, place long, last long, radius double"
    planted = placed.mapInArrow(number, f"block long, id long, w long, v {element}").groupBy("block").applyInArrow(plant, f"block long, {node}")
    planted = stage(planted, "trees")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            block = b.column(0).to_numpy()
            d = distances(_unit(matrix(b.column(3))), pivots) if b.num_rows else np.zeros((0, len(pivots)))
            met = (d - radius <= reach + EPS) @ member  # boolean product: some cell of the block
            met[np.arange(len(block)), block] = True
            row, other = np.nonzero(met)
            low, high = np.minimum(block[row], other), np.maximum(block[row], other)
            for at in range(0, len(row), 20_000):
                cut = slice(at, at + 20_000)
                own = b.take(pa.array(row[cut]))
                yield pa.RecordBatch.from_arrays([pa.array((low * n_blocks + high)[cut]), pa.array((block[row] == high)[cut]), *own.columns[1:]], ["pair", "upper", *own.schema.names[1:]])

    def meet(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        low, high = divmod(key[0].as_py(), n_blocks)
        sides = []
        for up in (False, True):
            own = group if low == high else group.filter(pc.equal(group.column("upper"), up))
            own = own.take(pc.sort_indices(own.column("place")))
            if not own.num_rows:
                return pa.table({k: pa.array([], pa.int64()) for k in ("id", "links", "root")})
            place, last, far = (own.column(c).to_numpy() for c in ("place", "last", "radius"))
            sides.append((own.column("id").to_numpy(), own.column("w").to_numpy(), _unit(matrix(own.column("v"))), Forest(place, last, far)))
            if low == high:
                break
        (ids, w, x, s), (ids_b, w_b, y, t) = sides[0], sides[-1]
        p = Pairs(x, w, *((None, None) if low == high else (y, w_b)), threshold)
        p.walk(s, t)
        links = p.nx + p.ny if low == high else np.concatenate([p.nx, p.ny])
        ids = ids if low == high else np.concatenate([ids, ids_b])
        at = np.flatnonzero(links)
        roots = np.array([p.root(int(i)) for i in at], np.int64)
        return pa.table({"id": pa.array([None, *ids[at].tolist()], pa.int64()), "links": np.append(p.seen, links[at]), "root": pa.array([None, *ids[roots].tolist()], pa.int64())})

    dealt = planted.mapInArrow(tidied(deal), f"pair long, upper boolean, {node}")
    return dealt.groupBy("pair").applyInArrow(meet, FOUND)
