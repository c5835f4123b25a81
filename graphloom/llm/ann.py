"""Approximate nearest neighbours: a forest of random-projection trees.

1. Equal vectors form a class (its 11 smallest ids can be anyone's neighbours),
   so a vector that a third of all rows share costs one comparison.
2. ``TREES`` trees are fit on at most about ``SAMPLE`` classes (chosen by a hash): each node
   splits its sample by the hyperplane between two random centres.  Every class
   is indexed by its leaf in every tree.
3. A query descends all trees through one priority queue, ordered by the sum of
   squared distances to the hyperplanes crossed, and visits the first
   ``PROBES`` of all leaves of the forest.
4. Queries meet rows by (tree, leaf).  Large leaves are split by a hash of the
   class into blocks of about ``BLOCK``, queries likewise, so a tile has a bounded size;
   each tile ranks its candidates exactly (double precision) and passes on the
   nearest 11 classes of a query.  A last aggregation merges the tiles.

On data without structure a large share of leaves has to be visited for a high
recall; the share, not a number of candidates, is the parameter, so recall
doesn't fall as the input grows.

Defined cases: vectors that are null, zero, empty or hold a null or non-finite
component take no part, nor do those whose length isn't the most common one
(of equally common lengths the smallest); repeated ids count once a row; a null
id is a candidate of no query; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from graphloom.llm.common import cut

TREES = 4
SAMPLE = 16_384
LEAF = 32
PROBES = 0.2
BLOCK = 4096
QUERY_BLOCK = 2048


@dataclass
class Tree:
    """Nodes by number; a child below zero is leaf ``-child - 1``."""

    normals: np.ndarray
    offsets: np.ndarray
    children: np.ndarray
    root: int
    leaves: int

    def route(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        out = np.zeros(len(x), np.int32)
        todo = [(self.root, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = -node - 1
            elif len(rows):
                below = x[rows] @ self.normals[node] <= self.offsets[node]
                todo += [(int(self.children[node, 0]), rows[below]), (int(self.children[node, 1]), rows[~below])]
        return out


def grow(x: np.ndarray, rng: np.random.Generator, leaf: int = LEAF) -> Tree:
    """A tree over the sample ``x``."""
    normals, offsets, children, n_leaves = [], [], [], 0
    # (rows, parent node, side)
    todo: list[tuple[np.ndarray, int, int]] = [(np.arange(len(x)), -1, 0)]
    root = -1
    while todo:
        rows, parent, side = todo.pop()
        split = _split(x, rows, rng) if len(rows) > leaf else None
        if split is None:
            n_leaves += 1
            me = -n_leaves
        else:
            normal, offset, below = split
            me = len(normals)
            normals.append(normal)
            offsets.append(offset)
            children.append([0, 0])
            todo += [(rows[below], me, 0), (rows[~below], me, 1)]
        if parent >= 0:
            children[parent][side] = me
        else:
            root = me
    width = x.shape[1] if x.ndim == 2 else 0
    return Tree(np.array(normals).reshape(-1, width), np.array(offsets), np.array(children, np.int64).reshape(-1, 2), root, n_leaves)


def _split(x: np.ndarray, rows: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, float, np.ndarray] | None:
    """A hyperplane between two centres (a few rounds of two-means); None if the rows can't be told apart."""
    some = x[rng.choice(rows, min(len(rows), 256), replace=False)]
    a, b = some[0], some[-1]
    for _ in range(4):
        near_a = ((some - a) ** 2).sum(1) < ((some - b) ** 2).sum(1)
        if near_a.all() or not near_a.any():
            break
        a, b = some[near_a].mean(0), some[~near_a].mean(0)
    normal = a - b
    length = np.linalg.norm(normal)
    if not length:
        return None
    normal = normal / length
    offset = float(normal @ (a + b) / 2)
    below = x[rows] @ normal <= offset
    return None if below.all() or not below.any() else (normal, offset, below)


def probe(trees: list[Tree], x: np.ndarray, n: int) -> list[tuple[int, int]]:
    """The first ``n`` (tree, leaf) of the forest for the vector ``x``."""
    planes = [t.normals @ x - t.offsets for t in trees]
    queue = [(0.0, k, t.root) for k, t in enumerate(trees)]
    heapq.heapify(queue)
    out: list[tuple[int, int]] = []
    while queue and len(out) < n:
        cost, k, node = heapq.heappop(queue)
        while node >= 0:
            p = planes[k][node]
            near = 0 if p <= 0 else 1
            heapq.heappush(queue, (cost + p * p, k, int(trees[k].children[node, 1 - near])))
            node = int(trees[k].children[node, near])
        out.append((k, -node - 1))
    return out


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def usable(rows: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(id, v) of the vectors that take part, in double precision."""
    v = F.col(vector).cast("array<double>")
    good = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    # -0.0 and 0.0 are one value
    found = rows.select(F.col(id_col).cast("long").alias("id"), F.when(good, F.transform(v, lambda x: x + F.lit(0.0))).alias("v"))
    found = found.where("v IS NOT NULL AND id IS NOT NULL")
    common = found.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return found.where(F.size("v") == (common[0].d if common else 0))


def fit(classes: DataFrame, n_classes: int, trees: int = TREES, sample: int = SAMPLE, seed: int = 11) -> list[Tree]:
    """A forest over a bounded sample of ``classes`` (rep, v): at most about ``sample`` rows, chosen by hash."""
    share = min(1.0, sample / max(1, n_classes))
    rows = classes.where(F.pmod(F.xxhash64("rep", F.lit(seed)), F.lit(1_000_000)) < int(share * 1_000_000)).select("rep", "v").toArrow().sort_by("rep")
    x = _matrix(rows.column("v"))
    return [grow(x, np.random.default_rng(seed + k)) for k in range(trees)]


def _leaves_of(frame: DataFrame, trees: list[Tree]) -> DataFrame:
    """(rep, v, tree, leaf): the leaf of every row in every tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                x = _matrix(batch.column("v"))
                for k, tree in enumerate(trees):
                    n = batch.num_rows
                    yield pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("v"), pa.array(np.full(n, k, np.int32)), pa.array(tree.route(x))], names=["rep", "v", "tree", "leaf"])

    return frame.select("rep", "v").mapInArrow(run, "rep long, v array<double>, tree int, leaf int")


def _probes_of(frame: DataFrame, trees: list[Tree], share: float) -> DataFrame:
    """(rep, v, tree, leaf): the leaves that every query visits."""
    n = max(len(trees), int(np.ceil(share * sum(t.leaves for t in trees))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                found = [probe(trees, x, n) for x in _matrix(batch.column("v"))]
                take = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
                flat = np.array([p for f in found for p in f], np.int32).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([batch.column("rep").take(take), batch.column("v").take(take), pa.array(flat[:, 0]), pa.array(flat[:, 1])], names=["rep", "v", "tree", "leaf"])

    return frame.select("rep", "v").mapInArrow(run, "rep long, v array<double>, tree int, leaf int")


def nearest_in(q: np.ndarray, c: np.ndarray, c_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query index, candidate index, distance) of the ``k`` nearest by exact distance, ties to smaller ids."""
    rows, cols, dist = [], [], []
    c_sq = (c * c).sum(1)
    for at in range(0, len(q), 128):
        part = q[at : at + 128]
        rough = (part * part).sum(1)[:, None] + c_sq - 2 * part @ c.T
        if len(c) > k:
            # the rough distances rule out only what lies clearly beyond the k-th
            edge = np.partition(rough, k - 1, axis=1)[:, k - 1]
            slack = 1e-9 * (c_sq.max() + (part * part).sum(1) + 1e-300)
            i, j = np.nonzero(rough <= (edge + slack)[:, None])
        else:
            i, j = (m.ravel() for m in np.indices(rough.shape))
        d = np.sqrt(((part[i] - c[j]) ** 2).sum(1))
        order = np.lexsort((c_ids[j], d, i))
        i, j, d = i[order], j[order], d[order]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        keep = place < k
        rows.append(i[keep] + at)
        cols.append(j[keep])
        dist.append(d[keep])
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    return join(rows, int), join(cols, int), join(dist, float)


def search(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", every: int = 100, k: int = 10, share: float = PROBES) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of every row whose id is divisible by ``every``."""
    points = cut(usable(rows, id_col, vector))
    # of equal vectors only the k + 1 smallest ids can be among anyone's k nearest
    first = Window.partitionBy("v").orderBy("id")
    # the row number is limited before the shuffle, so a class sends a few rows a task
    few = points.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    classes = cut(few.groupBy("v").agg(F.min("id").alias("rep"), F.sort_array(F.collect_list("id")).alias("ids")))
    n_classes = classes.count()
    asked = cut(points.where(F.col("id") % every == 0))
    wanted = asked.select("v").distinct()
    q_classes = cut(wanted.join(classes.select("v", "rep"), "v").select("rep", "v"))
    trees = fit(classes, n_classes) if n_classes else []
    if not trees:
        return points.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)

    indexed = cut(_leaves_of(classes, trees))
    probes = cut(_probes_of(q_classes, trees, share))
    # both tables have a row for each leaf of the forest at most: bounded by SAMPLE
    sizes = cut(indexed.groupBy("tree", "leaf").count().withColumn("rows", F.ceil(F.col("count") / BLOCK).cast("int")).drop("count"))
    loads = cut(probes.groupBy("tree", "leaf").count().withColumn("queries", F.ceil(F.col("count") / QUERY_BLOCK).cast("int")).drop("count"))
    tiles = F.broadcast(sizes.join(loads, ["tree", "leaf"]))
    salt = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    left = indexed.join(tiles, ["tree", "leaf"]).select("tree", "leaf", salt("rows").alias("r"), F.explode(F.sequence(F.lit(0), F.col("queries") - 1)).alias("q"), "rep", "v")
    right = probes.join(tiles, ["tree", "leaf"]).select("tree", "leaf", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("r"), salt("queries").alias("q"), "rep", "v")

    def tile(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        c_ids, q_ids = (t.column("rep").to_numpy() for t in (candidates, queries))
        if len(c_ids) and len(q_ids):
            i, j, d = nearest_in(_matrix(queries.column("v")), _matrix(candidates.column("v")), c_ids, k + 1)
        else:
            i, j, d = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        return pa.table({"q_rep": pa.array(q_ids[i], pa.int64()), "rep": pa.array(c_ids[j], pa.int64()), "score": pa.array(d, pa.float64())})

    key = ["tree", "leaf", "r", "q"]
    met = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(tile, "q_rep long, rep long, score double")
    best = met.groupBy("q_rep", "rep").agg(F.min("score").alias("score"))
    near = Window.partitionBy("q_rep").orderBy("score", "rep")
    best = cut(best.withColumn("n", F.row_number().over(near)).where(F.col("n") <= k + 1).drop("n"))
    # from classes back to rows: k + 1 ids, of which the query's own goes
    spread = best.join(classes.select("rep", "ids"), "rep").select("q_rep", F.explode("ids").alias("vec_id"), "score")
    near = Window.partitionBy("q_rep").orderBy("score", "vec_id")
    lists = spread.withColumn("n", F.row_number().over(near)).where(F.col("n") <= k + 1)
    lists = lists.groupBy("q_rep").agg(F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("found"))
    of_class = lists.join(q_classes.withColumnRenamed("rep", "q_rep"), "q_rep").select("v", "found")
    own = asked.select("v", F.col("id").alias("query_id")).join(of_class, "v")
    mine = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return own.select("query_id", F.posexplode(mine).alias("pos", "hit")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score")
    )
