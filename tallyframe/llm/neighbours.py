"""Approximate nearest neighbours by cosine in a hierarchical k-means tree with best-bin-first traversal.

The upper tree is fitted on a sample of at most ``sample_rows`` rows and has at most ``most_leaves`` leaves, so it is small whatever
the number of rows. Each of its leaves with more than twice ``leaf_rows`` rows holds a lower tree, fitted by one task on as bounded a
sample of that leaf's rows and kept in a table that rows and queries meet by leaf: leaves stay near ``leaf_rows`` rows while the table grows
(a lower tree on 20,000 rows has up to some 2,500 leaves, both levels five million). Every row is put into the leaf it descends to.

A query takes leaves from a priority queue of nodes by their centre's distance, in the upper tree and then in each lower one. How many is
calibrated on both levels: for up to ``trial_queries`` queries the exact neighbours among all rows are found, and visits are widened
until ``recall`` of those lie in visited leaves. A query walks on until its upper leaves hold more than ``k`` rows, and
one that then has fewer than ``k`` ids visits more leaves, all in the end. Leaves with many rows or visits are cut into blocks, every
pair of blocks of a leaf meets in one task, and the best of each block are merged.

Defined results: vectors that are null or zero, hold a null or non-finite component, or have another length than most
(ties: the shorter) take no part, nor do null ids; rows of one id count once for a query, with their best score; ties go to the smaller id;
a table without a valid query gives no row. Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

FOUND = "query_id long, vec_id long, score double"


@dataclass
class Tree:
    """Nodes with their centres; children of an inner node, the number of a leaf."""

    centres: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    leaves: int = 0

    def add(self, centre: np.ndarray) -> int:
        self.centres.append(centre)
        self.children.append([])
        self.leaf.append(-1)
        return len(self.leaf) - 1

    def assign(self, units: np.ndarray) -> np.ndarray:
        """The leaf that each row descends to."""
        out = np.zeros(len(units), np.int64)
        todo = [(0, np.arange(len(units)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
                continue
            kids = self.children[node]
            best = np.argmin(_distances(units[rows], np.stack([self.centres[c] for c in kids])), axis=1)
            todo += [(c, rows[best == i]) for i, c in enumerate(kids)]
        return out

    def visit(self, unit: np.ndarray, most: int, rows: np.ndarray | None = None, need: int = 0) -> list[int]:
        """Leaves in best-bin-first order: ``most`` of them, and on until they hold ``need`` rows."""
        heap, seen, held = [(0.0, 0)], [], 0
        while heap and (len(seen) < most or held < need):
            _, node = heapq.heappop(heap)
            if self.leaf[node] >= 0:
                seen.append(self.leaf[node])
                held += 0 if rows is None else int(rows[self.leaf[node]])
                continue
            kids = self.children[node]
            for d, c in zip(_distances(unit[None, :], np.stack([self.centres[c] for c in kids]))[0].tolist(), kids):
                heapq.heappush(heap, (d, c))
        return seen


def _distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (centres * centres).sum(1)[None, :] - 2 * rows @ centres.T


def _means(rows: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    distinct = np.unique(rows, axis=0)
    centres = distinct[rng.permutation(len(distinct))[:k]]
    for _ in range(rounds):
        of = np.argmin(_distances(rows, centres), axis=1)
        for i in range(len(centres)):
            if (of == i).any():
                centres[i] = rows[of == i].mean(0)
    return centres, np.argmin(_distances(rows, centres), axis=1)


def fit(units: np.ndarray, leaves: int, branch: int = 8, seed: int = 42) -> Tree:
    """Splits the node with most sampled rows until there are ``leaves`` leaves."""
    rng, tree = np.random.default_rng(seed), Tree()
    root = tree.add(units.mean(0) if len(units) else np.zeros(1))
    open_, done, heap = {root: units}, [], [(-len(units), root)]
    while heap:
        _, node = heapq.heappop(heap)
        rows = open_.pop(node)
        if len(done) + len(heap) + 1 >= leaves or len(rows) < 2 * branch:
            done.append(node)
            continue
        centres, of = _means(rows, branch, rng)
        kids = [i for i in range(len(centres)) if (of == i).any()]
        if len(kids) < 2:
            done.append(node)
            continue
        for i in kids:
            child = tree.add(centres[i])
            tree.children[node].append(child)
            open_[child] = rows[of == i]
            heapq.heappush(heap, (-len(open_[child]), child))
    for i, node in enumerate(sorted(done)):
        tree.leaf[node] = i
    tree.leaves = len(done)
    return tree


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def _unit(rows: np.ndarray) -> np.ndarray:
    scaled = rows / np.abs(rows).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def _best(queries: tuple[np.ndarray, np.ndarray], rows: tuple[np.ndarray, np.ndarray], k: int) -> list[tuple[int, int, float]]:
    """The ``k`` nearest ids of each query in a block: products first, then the exact measure for all that may be among them."""
    (q_ids, q), (ids, v) = queries, rows
    units, q_units, out = _unit(v), _unit(q), []
    norms, q_norms = np.sqrt((v * v).sum(1)), np.sqrt((q * q).sum(1))
    for begin in range(0, len(q_ids), 128):
        near = q_units[begin : begin + 128] @ units.T
        for i, products in enumerate(near, begin):
            products[ids == q_ids[i]] = -np.inf
            least = np.partition(products, -k)[-k] if len(products) > k else -np.inf
            while True:  # rows of one id count once, so more may be needed
                at = np.flatnonzero(products >= least - 1e-9) if np.isfinite(least) else np.flatnonzero(np.isfinite(products))
                score = (v[at] * q[i]).sum(1) / (norms[at] * q_norms[i])
                order = np.lexsort((ids[at], -score))
                _, first = np.unique(ids[at][order], return_index=True)
                if len(first) >= k or not np.isfinite(least):
                    break
                least = -np.inf
            for j in order[np.sort(first)[:k]]:
                out.append((int(q_ids[i]), int(ids[at][j]), float(score[j])))
    return out


def _table(found: list[tuple[int, int, float]]) -> pa.Table:
    columns = list(zip(*found)) or [(), (), ()]
    return pa.table({n: pa.array(c, t) for n, c, t in zip(("query_id", "vec_id", "score"), columns, (pa.int64(), pa.int64(), pa.float64()))})


def valid(rows: DataFrame) -> tuple[DataFrame, int]:
    """Rows that take part, and their number of components."""
    good = rows.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).where(
        "vec_id IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0 "
        "AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(embedding, x -> x <> 0)"
    )
    most = good.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dims = most["d"] if most else 0
    return good.where(F.size("embedding") == dims), dims


def search(
    rows: DataFrame, is_query, k: int = 5, *, recall: float = 0.97, leaf_rows: int = 500, most_leaves: int = 2048, sample_rows: int = 20_000,
    trial_queries: int = 256, block_rows: int = 8192, block_queries: int = 1024,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest rows for each row that meets ``is_query``, itself excepted."""
    spark = rows.sparkSession
    good, dims = valid(rows)
    n = good.count()
    mixed = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30))
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    share = int(min(1.0, sample_rows / n) * (1 << 30))
    sample = good.where(mixed <= share).select("embedding").limit(2 * sample_rows).toPandas()["embedding"]
    units = _unit(np.stack(sample.to_list())) if len(sample) else np.zeros((0, dims))
    tree = fit(units, int(min(most_leaves, max(1, n // leaf_rows))))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf = tree.assign(_unit(_matrix(b.column("embedding"), dims))) if b.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("embedding"), pa.array(leaf)], names=["vec_id", "embedding", "leaf"])

    top = saved(good.mapInArrow(put, "vec_id long, embedding array<double>, leaf long"))
    # Rows of each leaf of the upper tree: at most most_leaves numbers.
    sizes = {r["leaf"]: r["rows"] for r in top.groupBy("leaf").agg(F.count(F.lit(1)).alias("rows")).collect()}
    held = np.zeros(tree.leaves, np.int64)
    held[list(sizes)] = list(sizes.values())
    large = {leaf: m for leaf, m in sizes.items() if m > 2 * leaf_rows}
    lower = _lower_trees(top, large, dims, leaf_rows, sample_rows)
    placed = saved(_placed(top, lower, {leaf: -(-m // block_rows) for leaf, m in large.items()}, dims, lambda t, u: [[x] for x in t.assign(u).tolist()]))
    per_place = saved(placed.groupBy("place").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("row_blocks")))
    queries = good.where(is_query)
    visits, inner = _calibrated(placed, lower, queries, tree, dims, k, recall, trial_queries)
    widest = lower.agg(F.max("leaves")).first()[0] or 1 if large else 1

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _table([])
        pick = lambda t: (t["vec_id"].to_numpy(), _matrix(t["embedding"].combine_chunks(), dims))
        return _table(_best(pick(left), pick(right), k))

    def nearest(some: DataFrame, most: int, most_inner: int) -> DataFrame:
        def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                order = [tree.visit(u, most, held, k + 1) for u in _unit(_matrix(b.column("embedding"), dims))]
                at = pa.array(np.repeat(np.arange(b.num_rows), [len(x) for x in order]))
                yield pa.RecordBatch.from_arrays([b.column("vec_id").take(at), b.column("embedding").take(at), pa.array([x for y in order for x in y], pa.int64())], names=["vec_id", "embedding", "leaf"])

        walked = some.mapInArrow(walk, "vec_id long, embedding array<double>, leaf long")
        asks = walked.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()  # at most most_leaves numbers
        salts = {r["leaf"]: -(-r["n"] // block_queries) for r in asks if r["leaf"] in large}
        walked = saved(_placed(walked, lower, salts, dims, lambda t, u: [t.visit(x, most_inner) for x in u]))
        visited = walked.groupBy("place").agg(F.ceil(F.count(F.lit(1)) / block_queries).cast("int").alias("query_blocks"))
        blocks = per_place.join(visited, "place")
        mine = lambda number: F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col(number)).cast("int")
        each = lambda number: F.explode(F.sequence(F.lit(0), F.col(number) - 1))
        index = placed.join(blocks, "place").withColumn("rb", mine("row_blocks")).withColumn("qb", each("query_blocks")).select("place", "rb", "qb", "vec_id", "embedding")
        asked = walked.join(blocks, "place").withColumn("qb", mine("query_blocks")).withColumn("rb", each("row_blocks")).select("place", "rb", "qb", "vec_id", "embedding")
        keys = ["place", "rb", "qb"]
        return _ranked(asked.groupBy(*keys).cogroup(index.groupBy(*keys)).applyInArrow(meet, FOUND), k)

    # Visited leaves may still hold too few ids: such queries visit more, in the end all leaves.
    best = saved(nearest(queries, visits, inner))
    while visits < tree.leaves or inner < widest:
        full = best.groupBy(F.col("query_id").alias("vec_id")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
        short = saved(queries.join(full, "vec_id", "left_anti"))
        if short.isEmpty():
            break
        visits, inner = min(4 * visits, tree.leaves), min(4 * inner, widest)
        again = short.select(F.col("vec_id").alias("query_id")).distinct()
        best = saved(best.join(again, "query_id", "left_anti").unionByName(nearest(short, visits, inner)))
    return best


LOWER = "leaf long, leaves int, tree binary"


def _lower_trees(top: DataFrame, large: dict[int, int], dims: int, leaf_rows: int, sample_rows: int) -> DataFrame:
    """``leaf, leaves, tree``: a tree inside each large leaf, fitted by one task on at most about ``sample_rows`` of its rows."""
    if not large:
        return top.sparkSession.createDataFrame([], LOWER)

    def grow(t: pa.Table) -> pa.Table:
        leaf = t["leaf"][0].as_py()
        inside = fit(_unit(_matrix(t["embedding"].combine_chunks(), dims)), max(2, large[leaf] // leaf_rows))
        return pa.table({"leaf": pa.array([leaf]), "leaves": pa.array([inside.leaves], pa.int32()), "tree": pa.array([pickle.dumps(inside)])})

    shares = F.broadcast(top.sparkSession.createDataFrame([(leaf, min(1.0, sample_rows / m)) for leaf, m in large.items()], "leaf long, share double"))
    some = top.join(shares, "leaf").where(F.rand(42) <= F.col("share")).select("leaf", "embedding")
    return saved(some.groupBy("leaf").applyInArrow(grow, LOWER))


def _placed(some: DataFrame, lower: DataFrame, salts: dict[int, int], dims: int, pick: Callable[[Tree, np.ndarray], list[list[int]]]) -> DataFrame:
    """Rows with the ``place`` (leaf, and leaf of the tree inside it) or places that ``pick`` gives; a large leaf's rows are dealt to so many tasks."""
    outer = F.shiftleft("leaf", 32)
    if not salts:
        return some.withColumn("place", outer)
    numbers = F.broadcast(some.sparkSession.createDataFrame(list(salts.items()), "leaf long, salts int"))

    def descend(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows and right.num_rows:
            found = pick(pickle.loads(right["tree"][0].as_py()), _unit(_matrix(left["embedding"].combine_chunks(), dims)))
        else:
            found = [[0]] * left.num_rows  # no row of the leaf was in the sample
        at = pa.array(np.repeat(np.arange(left.num_rows), [len(x) for x in found]), pa.int64())
        place = (left["leaf"].take(at).to_numpy() << 32) + np.array([x for y in found for x in y], np.int64)
        return pa.table({"vec_id": left["vec_id"].take(at), "embedding": left["embedding"].take(at), "leaf": left["leaf"].take(at), "place": pa.array(place, pa.int64())})

    keys = ["leaf", "salt"]
    dealt = some.join(numbers, "leaf").withColumn("salt", F.pmod(F.xxhash64("vec_id", F.lit(2)), F.col("salts")).cast("int"))
    trees = lower.join(numbers, "leaf").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    inside = dealt.select("vec_id", "embedding", *keys).groupBy(*keys).cogroup(trees.select("tree", *keys).groupBy(*keys))
    rest = some.join(numbers.select("leaf"), "leaf", "left_anti").select("vec_id", "embedding", "leaf", outer.alias("place"))
    return inside.applyInArrow(descend, "vec_id long, embedding array<double>, leaf long, place long").unionByName(rest)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _calibrated(placed: DataFrame, lower: DataFrame, queries: DataFrame, tree: Tree, dims: int, k: int, recall: float, trials: int) -> tuple[int, int]:
    """Visits to leaves, and to leaves inside each, that cover ``recall`` of the exact neighbours of the trial queries, found in one pass over all rows."""
    some = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(trials).toPandas()
    if not len(some):
        return max(1, tree.leaves), 1
    trial = (some["vec_id"].to_numpy(), np.stack(some["embedding"].to_list()))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                ids = b.column("vec_id").to_numpy()
                place_of = dict(zip(ids.tolist(), b.column("place").to_pylist()))
                found = _best(trial, (ids, _matrix(b.column("embedding"), dims)), k)
                t = _table(found).append_column("place", pa.array([place_of[x[1]] for x in found], pa.int64()))
                yield from t.to_batches()

    near = placed.select("vec_id", "embedding", "place").mapInArrow(scan, FOUND + ", place long")
    best = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"), F.max_by("place", "score").alias("place"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    truth = best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "place").collect()  # trials times k rows
    if not truth:
        return tree.leaves, 1
    units = dict(zip(trial[0].tolist(), _unit(trial[1])))
    order = {i: {leaf: j for j, leaf in enumerate(tree.visit(u, tree.leaves))} for i, u in units.items()}

    def depths(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            inside = pickle.loads(right["tree"][0].as_py())
            for i, inner in zip(left["query_id"].to_pylist(), left["inner"].to_pylist()):
                found.append(inside.visit(units[i], inside.leaves).index(inner) + 1)
        return pa.table({"depth": pa.array(found, pa.int32())})

    wanted = placed.sparkSession.createDataFrame([(r["query_id"], r["place"] >> 32, r["place"] & 0xFFFFFFFF) for r in truth], "query_id long, leaf long, inner long")
    inner = [r["depth"] for r in wanted.groupBy("leaf").cogroup(lower.groupBy("leaf")).applyInArrow(depths, "depth int").collect()]
    # Either walk may miss half of what may be missed.
    each = (1 + recall) / 2
    reach = lambda d: sorted(d)[min(len(d), int(np.ceil(each * len(d)))) - 1]
    return reach([order[r["query_id"]][r["place"] >> 32] + 1 for r in truth]), reach(inner + [1] * (len(truth) - len(inner)))
