"""Exact top-k inner products by a dual-tree search over cover trees.

Rows and queries are dealt to cells of space, those nearest to the same sampled row. A query's k-th best score
over the sample is a floor of its k-th score; a cell of queries meets a cell of rows only where the best inner
product that both radii allow reaches the lowest floor of its queries, so that other rows are not sent to it. Cells
larger than a block are split by a hash. Within a pair the vectors of each side become a cover tree, a node of which
holds a centre and the radius that covers all below it. Both trees are walked together, and a pair of nodes is dropped
when the best inner product that its radii allow lies below every k-th score that its queries hold so far. Each block's best k of a query then meet in one merge.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import cut_lineage

#: Vectors of a block and queries of a group, about.
BLOCK, GROUP = 8192, 1024
#: Points of a leaf of the rows' tree and of the queries' tree; children of a node.
LEAF, QUERY_LEAF, FANOUT = 64, 32, 16
#: Rows that a query leaf multiplies at once, about.
TOGETHER = 1024
#: Rows of the sample that gives cells and floors, its bytes, and cells a side.
SAMPLE, SAMPLE_BYTES, CELLS = 2048, 16 << 20, 1024
#: Sums of products up to this are exact in double precision.
EXACT = float(1 << 53)
#: Ends of the scores; the two longs below stand for none.
LEAST, MOST = 2 - (1 << 63), (1 << 63) - 1


class CoverTree:
    """Nodes as arrays: centre, covering radius and the span of ``order`` below; children by node.

    A node's children have its own centre and up to ``FANOUT - 1`` more, each the point farthest from those before.
    So with ``cover`` the largest distance left, centres lie at least ``cover`` apart and each child's radius is at
    most ``cover``; fewer children are taken where half the node's radius covers the rest.
    """

    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        self.order, self.leaf = np.arange(len(x)), leaf
        self.centre: list[np.ndarray] = []
        self.radius: list[float] = []
        self.cover: list[float] = []
        self.span: list[tuple[int, int]] = []
        self.children: list[list[int]] = []
        if len(x):
            self._build(x.astype(float))
        self.centres, self.radii = np.array(self.centre), np.array(self.radius)
        self.norms = np.sqrt((self.centres**2).sum(1)) if len(x) else np.empty(0)

    def _node(self, centre: np.ndarray, dist: np.ndarray, lo: int) -> int:
        self.centre.append(centre)
        self.radius.append(float(dist.max()))
        self.cover.append(0.0)
        self.span.append((lo, lo + len(dist)))
        self.children.append([])
        return len(self.centre) - 1

    def _build(self, x: np.ndarray) -> None:
        middle = x[np.argmin(_distances(x, x.mean(0)))]  # a point of the set, as in any cover tree
        dist = _distances(x, middle)
        todo = [(self._node(middle, dist, 0), dist)]
        while todo:
            node, dist = todo.pop()
            lo, hi = self.span[node]
            if hi - lo <= self.leaf or self.radius[node] == 0:
                continue
            own = self.order[lo:hi]
            points = x[own]
            near, part, centres = dist.copy(), np.zeros(len(own), int), [self.centre[node]]
            while len(centres) < FANOUT and near.max() > self.radius[node] / 2:
                far = points[near.argmax()]
                d = _distances(points, far)
                closer = d < near
                near[closer], part[closer] = d[closer], len(centres)
                centres.append(far)
            self.cover[node] = float(near.max())
            order = np.argsort(part, kind="stable")
            self.order[lo:hi], near = own[order], near[order]
            edge = np.r_[0, np.flatnonzero(np.diff(part[order])) + 1, len(own)]
            for a, b in zip(edge[:-1], edge[1:], strict=True):
                child = self._node(centres[part[order[a]]], near[a:b], lo + a)
                self.children[node].append(child)
                todo.append((child, near[a:b]))


def _distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - centre) ** 2).sum(-1))


def most(qc: np.ndarray, qr: float, cc: np.ndarray, cr: np.ndarray) -> np.ndarray:
    """Upper bounds of the products of a query within ``qr`` of ``qc`` with rows within ``cr`` of each centre of ``cc``."""
    nq, nc = np.sqrt((qc**2).sum()), np.sqrt((cc**2).sum(1))
    top = cc @ qc + qr * nc + cr * nq + qr * cr
    top = top + 1e-9 * (np.abs(top) + (nq + qr) * (nc + cr)) + 1e-6  # rounding can only keep more
    return np.maximum(top, float(LEAST))  # scores end there


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number vectors; one that does not fit a long counts as its end (``LEAST`` or ``MOST``)."""
    if not q.size or not c.size:
        return np.zeros((len(q), len(c)), np.int64)
    if float(np.abs(q).max()) * float(np.abs(c).max()) * q.shape[1] < EXACT:
        return (q.astype(float) @ c.astype(float).T).astype(np.int64)
    got = q.astype(object) @ c.astype(object).T
    return np.clip(got, LEAST, MOST).astype(np.int64)


def block_topk(q: np.ndarray, q_ids: np.ndarray, c: np.ndarray, c_ids: np.ndarray, k: int, floor: np.ndarray | None = None,
               counts: dict[str, int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query position, id, score) of the best ``k`` of ``c`` for each query, ties to the smaller id, without
    candidates of the query's own id. Ids may repeat. Scores below a query's ``floor`` may be left out.
    ``counts`` is told the products of all pairs and those that were worked out.

    Each query node takes along the row nodes that its bound leaves over, opened down to its own radius; its children
    narrow these further. A query leaf multiplies the leaves left over together, the most promising first, and
    stops where the rest lies below its k-th scores.
    """
    if not len(q) or not len(c):
        return np.empty(0, int), np.empty(0, np.int64), np.empty(0, np.int64)
    qt, ct = CoverTree(q, QUERY_LEAF), CoverTree(c)
    inner = np.array([bool(ch) for ch in ct.children])
    size = np.array([hi - lo for lo, hi in ct.span])
    low = np.iinfo(np.int64).min
    best = np.full((len(q), k), low)  # scores; low: none yet
    best_ids = np.full((len(q), k), np.iinfo(np.int64).max)
    floor = np.full(len(q), -np.inf) if floor is None else floor
    worst = floor.copy()  # each query's k-th score, or a floor of it
    done = 0

    def narrowed(a: int, nodes: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
        """Row nodes that may hold a result for query node ``a``, with their bounds; inner ones above ``radius`` opened."""
        least = worst[qt.order[slice(*qt.span[a])]].min()
        kept, bounds = [], []
        while len(nodes):
            top = most(qt.centres[a], qt.radii[a], ct.centres[nodes], ct.radii[nodes])
            ok = top >= least  # an equal score may still win by its id
            nodes, top = nodes[ok], top[ok]
            wide = inner[nodes] & (ct.radii[nodes] >= radius)
            kept.append(nodes[~wide])
            bounds.append(top[~wide])
            nodes = np.array([x for b in nodes[wide] for x in ct.children[b]], int)
        return np.concatenate(kept or [nodes]), np.concatenate(bounds or [np.empty(0)])

    def take(rows: np.ndarray, cols: np.ndarray) -> None:
        score = _products(q[rows], c[cols])
        hit = (score >= worst[rows][:, None]) & (c_ids[cols][None, :] != q_ids[rows][:, None])  # an equal score may win by its id
        for i in np.flatnonzero(hit.any(1)):
            row, new = rows[i], np.flatnonzero(hit[i])
            if len(new) > 4 * k:  # ties of the last one stay
                least = np.partition(score[i, new], -k)[-k]
                new = new[score[i, new] >= least]
            scores, ids = np.r_[best[row], score[i, new]], np.r_[best_ids[row], c_ids[cols[new]]]
            order = np.lexsort((ids, -np.maximum(scores, low + 1)))[:k]
            best[row], best_ids[row] = scores[order], ids[order]
            if best[row, -1] > low:
                worst[row] = max(floor[row], float(best[row, -1]))

    todo = [(0, np.zeros(1, int))]
    while todo:
        a, nodes = todo.pop()
        if qt.children[a]:
            nodes, _ = narrowed(a, nodes, qt.radii[a])
            todo += [(child, nodes) for child in qt.children[a] if len(nodes)]
            continue
        nodes, top = narrowed(a, nodes, 0.0)
        order = np.argsort(-top, kind="stable")
        nodes, top = nodes[order], top[order]
        rows = qt.order[slice(*qt.span[a])]
        step = np.cumsum(size[nodes]) // TOGETHER
        for n in np.unique(step):
            some = nodes[(step == n) & (top >= worst[rows].min())]
            if not len(some):
                break
            cols = np.concatenate([ct.order[slice(*ct.span[b])] for b in some])
            done += len(rows) * len(cols)
            take(rows, cols)
    if counts is not None:
        counts["all"] = counts.get("all", 0) + len(q) * len(c)
        counts["done"] = counts.get("done", 0) + done
    at, place = np.nonzero((best > low) & (best >= floor[:, None]))
    return at, best_ids[at, place], best[at, place]


def _matrix(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and vectors of each length that comes."""
    size = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    first = np.cumsum(size) - size
    for dim in np.unique(size):
        at = np.flatnonzero(size == dim)
        yield at, flat[first[at][:, None] + np.arange(dim)].astype(np.int64)


class Sample:
    """Rows of a bounded sample by length; the first of them are the centres of cells."""

    def __init__(self, rows: list[tuple[int, list[int]]]):
        self.rows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        by_size: dict[int, list[int]] = {}
        for i, (_, vector) in enumerate(rows):
            by_size.setdefault(len(vector), []).append(i)
        for dim, places in by_size.items():
            ids = np.array([rows[i][0] for i in places], np.int64)
            self.rows[dim] = np.array(places), ids, np.array([rows[i][1] for i in places], np.int64).reshape(len(places), dim)

    def cells(self, x: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest of the first ``n`` sampled rows and its distance; -1 and infinity where none has that length."""
        places, _, points = self.rows.get(x.shape[1], (np.empty(0, int), None, None))
        held = int((places < n).sum())
        if not held:
            return np.full(len(x), -1), np.full(len(x), np.inf)
        xs, centres = x.astype(float), points[:held].astype(float)
        near = ((centres**2).sum(1)[None, :] - 2 * (xs @ centres.T)).argmin(1)
        return places[near], _distances(xs, centres[near])

    def centre(self, cell: int) -> np.ndarray:
        return next(points[places == cell][0].astype(float) for places, _, points in self.rows.values() if cell in places)

    def floors(self, x: np.ndarray, x_ids: np.ndarray, k: int) -> np.ndarray:
        """Each query's k-th best score over the sample without its own id; minus infinity where it has fewer rows."""
        _, ids, points = self.rows.get(x.shape[1], (None, np.empty(0, np.int64), None))
        if len(ids) < k:
            return np.full(len(x), -np.inf)
        score = _products(x, points).astype(float)
        score[ids[None, :] == x_ids[:, None]] = -np.inf
        return -np.partition(-score, k - 1, axis=1)[:, k - 1]


def _sample(rows: DataFrame, n_rows: int) -> Sample:
    """A sample by the hash of row and id, in its order: ``SAMPLE`` rows at most, of ``SAMPLE_BYTES`` at most, one an id."""
    place = F.shiftrightunsigned(F.xxhash64("vec_id", "vector"), 11)
    some = rows.withColumn("place", place).where(F.col("place") < 2.0 * SAMPLE / max(1, n_rows) * (1 << 53))
    got, used = {}, 0
    for r in some.orderBy("place", "vec_id", "vector").limit(SAMPLE).collect():
        used += 8 * len(r["vector"]) + 64
        if used > SAMPLE_BYTES:
            break
        got.setdefault(r["vec_id"], r["vector"])
    return Sample(list(got.items()))


def _dealt(rows: DataFrame, sample: Sample, cells: int, k: int | None = None) -> DataFrame:
    """``rows`` with ``cell``, ``dist`` from its centre and, given ``k``, ``floor``; written, as it is read more than once."""
    shared = rows.sparkSession.sparkContext.broadcast(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("vec_id").to_numpy()
            cell, dist, floor = np.empty(len(ids), np.int32), np.empty(len(ids)), np.full(len(ids), -np.inf)
            for at, x in _matrix(b.column("vector")):
                cell[at], dist[at] = shared.value.cells(x, cells)
                if k is not None:
                    floor[at] = shared.value.floors(x, ids[at], k)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("vector"), pa.array(cell), pa.array(dist), pa.array(floor)],
                                             names=["vec_id", "vector", "cell", "dist", "floor"])

    return cut_lineage(rows.mapInArrow(run, "vec_id long, vector array<long>, cell int, dist double, floor double"))


def cell_pairs(queries: DataFrame, rows: DataFrame, sample: Sample, block: int, group: int) -> list[tuple[int, int, int, int]]:
    """``(cell of queries, cell of rows, groups of the first, blocks of the second)`` of all pairs that may hold a result.

    Both sides have at most ``CELLS`` + 1 cells, whatever their rows."""
    stats = lambda df: sorted(tuple(r) for r in df.groupBy("cell").agg(F.count(F.lit(1)), F.max("dist"), F.min("floor")).collect())
    mine, theirs = stats(queries), stats(rows)
    out = []
    for cell, n, radius, floor in mine:
        open_ = [r for r in theirs if cell < 0 or r[0] < 0]  # no bound
        size = None if cell < 0 else len(sample.centre(cell))
        near = [] if cell < 0 else [(r, c) for r in theirs if r[0] >= 0 and len(c := sample.centre(r[0])) == size]
        if near:
            top = most(sample.centre(cell), radius, np.array([c for _, c in near]), np.array([r[2] for r, _ in near]))
            open_ += [r for (r, _), m in zip(near, top, strict=True) if m >= floor]
        out += [(cell, r[0], -(-n // group), -(-r[1] // block)) for r in open_]
    return out


def search(queries: DataFrame, rows: DataFrame, k: int = 20, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` rows with the largest inner product with each query.

    Both tables have ``vec_id`` long and ``vector`` array<long>. A query's candidates are the rows of its own
    length with another id (a row that repeats its id is its own); all, if fewer than ``k``; ties go to the
    smaller id, rows that repeat an id with the same vector count once. Null ids or vectors, and vectors with
    a null, take no part. A product that does not fit a long counts as the nearest one that does. Of equal
    vectors in a block only the ``k + 1`` smallest ids can matter, and only those are searched. The sample only sets
    cells and floors: every row that may hold a result is searched, and rows of a length that it lacks meet all.
    """
    clean = lambda df: df.select(F.col("vec_id").cast("long"), F.col("vector").cast("array<long>")).where("vec_id is not null and vector is not null and forall(vector, x -> x is not null)")
    spark, queries, rows = rows.sparkSession, clean(queries), clean(rows)
    n_rows, n_queries = rows.count(), queries.count()
    sample = _sample(rows, n_rows)
    cells = lambda n, size: max(1, min(CELLS, -(-n // size)))
    queries, rows = _dealt(queries.distinct(), sample, cells(n_queries, group), k), _dealt(rows.distinct(), sample, cells(n_rows, block))
    pairs = spark.createDataFrame(cell_pairs(queries, rows, sample, block, group), "qcell int, ccell int, groups int, blocks int")
    pairs = F.broadcast(pairs)  # two cells and two numbers for at most (CELLS + 1) squared pairs
    own = lambda n: F.pmod(F.xxhash64("vec_id", "vector"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cols = ["vec_id", "vector", "floor", "qcell", "ccell"]
    left = queries.withColumnRenamed("cell", "qcell").join(pairs, "qcell").select(*cols, own("groups").alias("part"), every("blocks").alias("block"), F.lit(0).alias("side"))
    right = rows.withColumnRenamed("cell", "ccell").join(pairs, "ccell").select(*cols, every("groups").alias("part"), own("blocks").alias("block"), F.lit(1).alias("side"))
    out = "query_id long, vec_id long, score long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(batches)
        sides: dict[int, list] = {}
        for s in (0, 1):
            part = t.filter(pa.compute.equal(t.column("side"), s)).combine_chunks()
            if not len(part):
                return
            ids, floors = part.column("vec_id").to_numpy(), part.column("floor").to_numpy()
            vectors = part.column("vector").combine_chunks()
            for at, x in _matrix(vectors):
                order = np.lexsort((ids[at], *x.T))
                x, own, floor = x[order], ids[at][order], floors[at][order]
                if s:
                    new = np.r_[True, (x[1:] != x[:-1]).any(1)]
                    place = np.arange(len(x)) - np.flatnonzero(new)[np.cumsum(new) - 1]
                    x, own = x[place <= k], own[place <= k]
                sides.setdefault(x.shape[1], [None, None])[s] = (x, own, floor)
        for one, other in sides.values():
            if one is None or other is None:
                continue
            (q, q_ids, floor), (c, c_ids, _) = one, other
            at, found, score = block_topk(q, q_ids, c, c_ids, k, floor)
            yield pa.RecordBatch.from_arrays([pa.array(q_ids[at]), pa.array(found), pa.array(score)], names=["query_id", "vec_id", "score"])

    local = left.unionByName(right).groupBy("qcell", "ccell", "part", "block").applyInArrow(run, out)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = local.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
