"""Approximate nearest neighbours by largest inner product: a hierarchical k-means tree searched best bin first."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spindrift.llm.shared import cut, small, stored
from spindrift.llm.vectors import dots, kmeans, lengths, matrix, proper, sample, split, squares


@dataclass(frozen=True)
class Settings:
    """neighbours: how many are wanted. recall: that calibration must reach. sample: vectors that the tree is fitted on, or
    a share of 1 / per_sampled of the rows if that is more, and never more than sample_bytes hold. branching and leaf:
    children of a node, and sampled vectors in a leaf, at most. rounds: of k-means. calibration: queries whose exact
    neighbours are found to learn how far the search must widen. block, queries: indexed vectors, and queries, that meet
    in one task."""

    neighbours: int = 20
    recall: float = 0.97
    sample: int = 16_384
    per_sampled: int = 64
    sample_bytes: int = 32 << 20
    branching: int = 16
    leaf: int = 48
    rounds: int = 6
    calibration: int = 256
    block: int = 4096
    queries: int = 8192
    seed: int = 31

    def sampled(self, rows: int, dim: int) -> int:
        return max(1, min(max(self.sample, rows // self.per_sampled), self.sample_bytes // (8 * dim)))


@dataclass
class Tree:
    """centres by node, children by node (none: a leaf), the leaf's number by node, and the largest norm; means and
    spread: of the sampled vectors below each node, and their root mean square distance from that.

    The largest inner product is the smallest distance once every vector has one more component, that brings it to the
    largest norm, and a query has 0 there.
    """

    norm: float
    centres: list[np.ndarray] = field(default_factory=list)
    means: list[np.ndarray] = field(default_factory=list)
    spread: list[float] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    leaves: int = 0

    def lifted(self, x: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.norm**2 - (x * x).sum(1), 0)
        return np.hstack([x, np.sqrt(rest)[:, None]])

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Each vector's leaf: down the tree by the nearest centre."""
        y, out = self.lifted(x), np.zeros(len(x), np.int32)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            kids = self.children[node]
            if not kids:
                out[rows] = self.leaf[node]
            elif len(rows):
                c = np.array([self.centres[k] for k in kids])
                near = ((c * c).sum(1)[None] - 2 * y[rows] @ c.T).argmin(1)
                todo += [(k, rows[near == i]) for i, k in enumerate(kids)]
        return out

    def visits(self, q: np.ndarray, bound: np.ndarray, slack: float, sizes: np.ndarray, least: int) -> list[list[int]]:
        """For each query the leaves of best-bin-first traversal, best first.

        A node's priority is what its vectors may score: the query's product with their mean, and slack times their
        spread. Nodes come from a priority queue, until the next one may not reach the query's bound and the leaves
        visited hold at least so many rows. So each query widens as far as its own bound asks.
        """
        may = q @ np.array(self.means).T + slack * np.linalg.norm(q, axis=1)[:, None] * np.array(self.spread)[None]
        out = []
        for best, floor in zip((-may).tolist(), (-bound).tolist(), strict=True):
            heap, leaves, rows = [(best[0], 0)], [], 0
            while heap:
                far, node = heapq.heappop(heap)
                if far > floor and rows >= least:
                    break
                for k in self.children[node]:
                    heapq.heappush(heap, (best[k], k))
                if not self.children[node]:
                    leaves.append(self.leaf[node])
                    rows += sizes[self.leaf[node]]
            out.append(leaves)
        return out


def fit(x: np.ndarray, norm: float, settings: Settings = Settings()) -> Tree:
    """The tree over a sample; leaves are numbered depth first, so that neighbours in number are near in space."""
    tree, rng = Tree(norm), np.random.default_rng(settings.seed)
    y = tree.lifted(x)

    def grow(rows: np.ndarray, centre: np.ndarray) -> int:
        me, mean = len(tree.centres), x[rows].mean(0)
        tree.centres.append(centre)
        tree.means.append(mean)
        tree.spread.append(float(np.sqrt(((x[rows] - mean) ** 2).sum(1).mean())))
        tree.children.append([])
        tree.leaf.append(-1)
        parts = []
        if len(rows) > settings.leaf:
            c = kmeans(y[rows], settings.branching, settings.rounds, rng)
            near = ((c * c).sum(1)[None] - 2 * y[rows] @ c.T).argmin(1)
            parts = [(rows[near == i], c[i]) for i in range(len(c)) if (near == i).any()]
        if len(parts) < 2:
            tree.leaf[me] = tree.leaves
            tree.leaves += 1
        else:
            tree.children[me] = [grow(r, c) for r, c in parts]
        return me

    grow(np.arange(len(y)), y.mean(0))
    # A leaf of few sampled vectors tells little of how far its rows lie apart.
    ends = [i for i, kids in enumerate(tree.children) if not kids]
    usual = float(np.median([tree.spread[i] for i in ends]))
    for i in ends:
        tree.spread[i] = max(tree.spread[i], usual)
    return tree


def bounds(q: np.ndarray, q_id: np.ndarray, s: np.ndarray, s_id: np.ndarray, k: int, norm: float) -> np.ndarray:
    """A score that each query's k-th best isn't below: the k-th best among the sampled vectors, but for rounding; none if there are fewer."""
    score = np.where(q_id[:, None] != s_id[None], q @ s.T, -np.inf)
    if score.shape[1] <= k:
        return np.full(len(q), -np.inf)
    return np.partition(score, -k, axis=1)[:, -k] - _ROUNDING * np.linalg.norm(q, axis=1) * norm


def calibrated(tree: Tree, q: np.ndarray, bound: np.ndarray, sizes: np.ndarray, k: int, leaf_of: list[list[int]], target: float) -> float:
    """The smallest slack of a series at which the mean recall of the true neighbours, whose leaves are given, reaches target."""
    known = [i for i, leaves in enumerate(leaf_of) if leaves]
    slack = 0.0
    while known:
        seen = tree.visits(q[known], bound[known], slack, sizes, k + 1)
        if np.mean([np.mean(np.isin(leaf_of[i], v)) for i, v in zip(known, seen, strict=True)]) >= target:
            break
        if all(len(v) == tree.leaves for v in seen):
            break
        slack = max(0.1, slack * 1.15)
    return slack


#: Two ways to sum an inner product differ by this share of the vectors' norms at most, and not by one of the product, which may be near 0.
_ROUNDING = 1e-9
_FOUND, _RANKED = "query_id long, vec_id long, score double", "query_id long, rank int, vec_id long, score double"


def _best(q_id: np.ndarray, v_id: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of each query's k best: by score, ties to the smaller id."""
    order = np.lexsort((v_id, -score, q_id))
    q = q_id[order]
    new = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1]))) if len(q) else np.empty(0, int)
    place = np.arange(len(q)) - np.repeat(new, np.diff(np.append(new, len(q))))
    return order[place < k]


def _meet(q: np.ndarray, q_id: np.ndarray, bound: np.ndarray, x: np.ndarray, x_id: np.ndarray, allowed, k: int) -> pa.RecordBatch:
    """Each query's best among the vectors of one block. allowed(rows): which may be looked at; bound: scores below it don't count."""
    parts = []
    for at in range(0, len(q), 512):
        s = q[at : at + 512] @ x.T
        hit = (s >= bound[at : at + 512, None]) & (q_id[at : at + 512, None] != x_id[None])
        if allowed is not None:
            hit &= allowed(slice(at, at + 512))
        i, j = np.nonzero(hit)
        if len(i) > 64 * k * 512:  # far more than can be among the best: those below each query's k-th are left out first
            s = np.where(hit, s, -np.inf)
            floor = np.partition(s, -k, axis=1)[:, -k] if s.shape[1] > k else np.full(len(s), -np.inf)
            far = _ROUNDING * np.linalg.norm(q[at : at + 512], axis=1) * np.sqrt((x * x).sum(1).max())
            i, j = np.nonzero(hit & (s >= (floor - far)[:, None]))
        exact = dots(q[at + i], x[j])
        keep = _best(q_id[at + i], x_id[j], exact, k)
        parts.append((q_id[at + i][keep], x_id[j][keep], exact[keep]))
    found = [np.concatenate([p[c] for p in parts]) if parts else np.empty(0, t) for c, t in enumerate((np.int64, np.int64, np.float64))]
    return pa.RecordBatch.from_arrays([pa.array(f) for f in found], names=["query_id", "vec_id", "score"])


def search(vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", settings: Settings = Settings()) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's nearest, by largest inner product in double precision.

    The tree is fitted on a bounded sample, and every row is indexed under its leaf. A query's bound is its k-th best
    score among the sampled vectors, and best-bin-first traversal visits the leaves that may reach it; how far a leaf's
    rows are taken to spread is calibrated by the exact neighbours of a few queries in all rows, until their recall is
    reached. Leaves are packed into blocks, and one of many rows is cut to cells by trees of their own, as often as it
    takes, with the same rule for queries: so blocks stay of one size as rows grow in number. Queries come to each block
    that holds one of their leaves, and a block that many queries visit is copied for each batch of them. The sampled
    vectors that set a query's bound are candidates in any case, so every list has as many as are wanted.

    A query's candidates are the vectors of its length, and each length that occurs is searched by a tree of its own.
    Vectors that are null, zero or of null or non-finite components and rows of null key take no part. Rows of one key
    never are each other's neighbours, and count once, by the best score. Ties go to the smaller key. A query finds all
    candidates if there are no more than wanted. No vectors: no rows.
    """
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("query")).filter(proper(F.col("v")) & F.col("id").isNotNull())
    found = [_search(rows.filter(F.size("v") == dim), dim, settings) for dim in lengths(rows)]
    if not found:
        return vectors.sparkSession.createDataFrame([], _RANKED)
    return reduce(DataFrame.union, found)


def _search(rows: DataFrame, dim: int, settings: Settings) -> DataFrame:
    """search() of rows(id, v, query) of one length."""
    spark, k = rows.sparkSession, settings.neighbours
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    total, queries, norm = rows.agg(F.count("*"), F.sum(F.col("query").cast("long")), F.sqrt(F.max(square))).first()
    if not queries:
        return spark.createDataFrame([], _RANKED)
    picked = sample(rows.select("id", "v"), "id", settings.sampled(total, dim), total, settings.seed).toArrow()
    s_id, first = np.unique(picked["id"].to_numpy(), return_index=True)  # rows of one key count once
    s = matrix(picked["v"], dim)[first]
    tree = fit(s, norm, settings)
    held = spark.sparkContext.broadcast((tree, s, s_id))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf = held.value[0].assign(matrix(b.column(1), dim))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf)], names=["id", "v", "query", "leaf"])

    indexed = stored(rows.mapInArrow(index, "id long, v array<double>, query boolean, leaf int"), "ann-index")

    # Calibration: exact neighbours of a bounded number of queries among all rows, and the leaves that hold them.
    tried = sample(indexed.filter("query").select("id", "v"), "id", settings.calibration, queries, settings.seed + 1).toArrow()
    t_id, t = tried["id"].to_numpy(), matrix(tried["v"], dim)

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the best so far of all that the task has seen
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                c = b.slice(at, 4096)
                leaf, ids = c.column(2).to_numpy(), c.column(0).to_numpy()
                found = _meet(t, t_id, np.full(len(t), -np.inf), matrix(c.column(1), dim), ids, None, k)
                order = np.argsort(ids, kind="stable")
                where = order[np.searchsorted(ids[order], found.column(1).to_numpy())]
                new = [*(x.to_numpy() for x in found.columns), leaf[where]]
                held = [np.concatenate(x) for x in zip(held, new, strict=True)] if held else new
                keep = _best(*held[:3], k)
                held = [x[keep] for x in held]
        if held:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, held)), names=["query_id", "vec_id", "score", "leaf"])

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    true = indexed.select("id", "v", "leaf").mapInArrow(exact, _FOUND + ", leaf int").withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "leaf").collect()
    leaf_of: dict[int, list[int]] = {}
    for r in true:
        leaf_of.setdefault(r["query_id"], []).append(r["leaf"])
    sizes = np.zeros(tree.leaves, np.int64)
    for r in indexed.groupBy("leaf").count().collect():
        sizes[r["leaf"]] = r["count"]
    slack = calibrated(tree, t, bounds(t, t_id, s, s_id, k, norm), sizes, k, [leaf_of.get(i, []) for i in t_id.tolist()], settings.recall)

    # Leaves are packed into blocks in order; one of more rows than a block has its own.
    first, block, room = np.zeros(tree.leaves, np.int64), 0, settings.block
    for i, n in enumerate(sizes.tolist()):
        if n > room and room < settings.block:
            block, room = block + 1, settings.block
        first[i], room = block, room - n
    packing = spark.sparkContext.broadcast((first, sizes))

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, s, s_id = held.value
        for b in batches:
            for at in range(0, b.num_rows, 512):
                c = b.slice(at, 512)
                yield _meet(matrix(c.column(1), dim), c.column(0).to_numpy(), np.full(c.num_rows, -np.inf), s, s_id, None, k)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (tree, s, s_id), (first, sizes) = held.value, packing.value
        for b in batches:
            for from_ in range(0, b.num_rows, 512):
                c = b.slice(from_, 512)
                ids, q = c.column(0).to_numpy(), matrix(c.column(1), dim)
                kth = bounds(q, ids, s, s_id, k, norm)
                at, to, leaves = [], [], []
                for i, order in enumerate(tree.visits(q, kth, slack, sizes, k + 1)):
                    by: dict[int, list[int]] = {}
                    for leaf in order:
                        by.setdefault(int(first[leaf]), []).append(leaf)
                    at += [i] * len(by)
                    to += by.keys()
                    leaves += by.values()
                take = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(to, pa.int64()), c.column(0).take(take), c.column(1).take(take), pa.array(kth[at] if at else [], pa.float64()), pa.array(leaves, pa.list_(pa.int32()))], names=["block", "id", "v", "bound", "leaves"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = packing.value[0]
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(first[b.column(2).to_numpy()]), *b.columns], names=["block", "id", "v", "leaf"])

    def cells(x: np.ndarray, k: int) -> np.ndarray:
        """A row a cell: its centre, the mean of its vectors, their spread."""
        c = kmeans(x, k, settings.rounds, np.random.default_rng(settings.seed))
        near = squares(x, c).argmin(1)
        held = [x[near == i] for i in range(len(c)) if (near == i).any()]
        c, means = c[np.unique(near)], np.array([h.mean(0) for h in held])
        spread = np.array([np.sqrt(((h - m) ** 2).sum(1).mean()) for h, m in zip(held, means, strict=True)])
        return np.hstack([c, means, np.maximum(spread, np.median(spread))[:, None]])

    def reach(made: np.ndarray, rows: pa.Table) -> np.ndarray:
        """As in the tree: the cells that may hold what reaches a query's bound, and the likeliest one in any case."""
        q, bound = matrix(rows["v"], dim), rows["bound"].to_numpy()
        may = q @ made[:, dim : 2 * dim].T + slack * np.linalg.norm(q, axis=1)[:, None] * made[None, :, -1]
        out = may >= bound[:, None]
        out[np.arange(len(q)), may.argmax(1)] = True
        return out

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        x, q, leaf = matrix(left["v"], dim), matrix(right["v"], dim), left["leaf"].to_numpy()
        known, at = np.unique(leaf, return_inverse=True)
        seen = np.zeros((len(q), len(known) + 1), bool)
        for i, leaves in enumerate(right["leaves"].to_pylist()):
            place = np.searchsorted(known, leaves)
            place[(place >= len(known)) | (known[np.minimum(place, len(known) - 1)] != leaves)] = len(known)
            seen[i, place] = True
        if not len(x) or not len(q):
            return pa.Table.from_batches([_meet(q[:0], np.empty(0, np.int64), np.empty(0), x[:0], np.empty(0, np.int64), None, k)])
        return pa.Table.from_batches([_meet(q, right["id"].to_numpy(), right["bound"].to_numpy(), x, left["id"].to_numpy(), lambda rows: seen[rows][:, at], k)])

    probes = indexed.filter("query").select("id", "v").mapInArrow(probe, "block long, id long, v array<double>, bound double, leaves array<int>")
    blocks = indexed.select("id", "v", "leaf").mapInArrow(place, "block long, id long, v array<double>, leaf int")
    blocks, probes = split(blocks, stored(probes, "ann-probes"), ["block"], "id", dim, settings.block, cells, lambda made, x: squares(x, made[:, :dim]).argmin(1), reach, settings.seed)
    # What can't be cut, of equal vectors, is dealt by a hash; a block that many queries visit is copied for each batch of them.
    parts = cut(blocks.groupBy("block").agg(F.ceil(F.count("*") / settings.block).cast("int").alias("parts")))
    turns = cut(probes.groupBy("block").agg(F.ceil(F.count("*") / settings.queries).cast("int").alias("turns")).join(small(parts, parts.count()), "block"))
    turns = small(turns, turns.count())
    probes = probes.join(turns, "block").withColumn("turn", F.pmod(F.xxhash64("id"), F.col("turns")).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("turns", "parts")
    blocks = blocks.join(turns, "block").withColumn("part", F.pmod(F.xxhash64("id", "v"), F.col("parts")).cast("int")).withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1))).drop("turns", "parts")
    on = ["block", "part", "turn"]
    found = blocks.groupBy(*on).cogroup(probes.groupBy(*on)).applyInArrow(meet, _FOUND)
    # The sampled vectors that set a query's bound are found with it, and lie in leaves that it needn't visit.
    found = found.union(indexed.filter("query").select("id", "v").mapInArrow(sampled, _FOUND))
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
