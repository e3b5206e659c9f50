"""Approximate nearest neighbours by stable projections and a kd-tree, with a chi-square stopping test.

Inner products become distances: with one more component every vector gets the length of the longest, and of such
vectors the nearest has the largest inner product. A few random normal projections (2-stable: a projected squared
distance is the true one times a chi-square variable) are indexed by a kd-tree. Its splits come from a bounded
sample; every vector is then put into its leaf.

A query takes the leaves in the order of their projected distance. What lies in the nearest leaves is verified
exactly and gives the distance of its k-th neighbour so far. A vector nearer than that would show a projected
distance beyond some radius only with probability 1 - confidence, by the chi-square distribution: there the search
stops. So further leaves are visited, and in them vectors verified, only within that radius, which shrinks as
neighbours are found.

Leaves are stored in blocks of bounded size and queries travel in packs, so a task holds one block and one pack.
Equal vectors are searched once and stand for all their ids.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import stored

PROJECTIONS = 8
#: Chance that a true neighbour lies within the radius at which the search stops.
CONFIDENCE = 0.97
#: Vectors in a leaf, about; most leaves; sampled vectors that the splits come from, at most.
LEAF, MOST_LEAVES, SAMPLE = 512, 1024, 20_000
#: Leaves that a query visits first; vectors in a block; queries in a pack.
FIRST_LEAVES, BLOCK, PACK = 8, 1024, 256


def chi_square(x: float, m: int) -> float:
    """Distribution function of chi-square with an even number m of degrees of freedom."""
    half, term, total = x / 2, 1.0, 0.0
    for i in range(m // 2):
        total += term
        term *= half / (i + 1)
    return 1 - math.exp(-half) * total


def chi_square_quantile(p: float, m: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, m) < p else (low, middle)
    return high


@dataclass
class Tree:
    """A kd-tree over the projections: inner nodes first, then leaves; node k has children 2k+1 and 2k+2."""

    depth: int
    axis: np.ndarray
    cut: np.ndarray

    @classmethod
    def build(cls, points: np.ndarray, leaves: int) -> Tree:
        depth = max(0, math.ceil(math.log2(max(1, leaves))))
        axis, cut = np.zeros((1 << depth) - 1, np.int64), np.zeros((1 << depth) - 1)
        held = {0: points}
        for node in range(len(axis)):
            mine = held.pop(node)
            if len(mine):
                axis[node] = int(np.argmax(mine.max(0) - mine.min(0)))
                cut[node] = np.median(mine[:, axis[node]])
            left = mine[:, axis[node]] < cut[node] if len(mine) else np.zeros(0, bool)
            held[2 * node + 1], held[2 * node + 2] = mine[left], mine[~left]
        return cls(depth, axis, cut)

    def leaf(self, points: np.ndarray) -> np.ndarray:
        at = np.zeros(len(points), np.int64)
        rows = np.arange(len(points))
        for _ in range(self.depth):
            at = 2 * at + 1 + (points[rows, self.axis[at]] >= self.cut[at])
        return at - len(self.axis)

    def distances(self, points: np.ndarray) -> np.ndarray:
        """Squared distance of each point to the cell of each leaf."""
        m = points.shape[1]
        low, high = np.full((1, m), -np.inf), np.full((1, m), np.inf)
        for level in range(self.depth):
            nodes = np.arange((1 << level) - 1, (2 << level) - 1)
            low, high = np.repeat(low, 2, axis=0), np.repeat(high, 2, axis=0)
            each = np.arange(len(nodes))
            high[2 * each, self.axis[nodes]] = np.minimum(high[2 * each, self.axis[nodes]], self.cut[nodes])
            low[2 * each + 1, self.axis[nodes]] = np.maximum(low[2 * each + 1, self.axis[nodes]], self.cut[nodes])
        out = np.zeros((len(points), len(low)))
        for d in range(m):
            x = points[:, d : d + 1]
            out += np.maximum(0, np.maximum(low[None, :, d] - x, x - high[None, :, d])) ** 2
        return out


def usable(vector: Column) -> Column:
    """Whether the vector has components, all of them finite, and one that is not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(frame: DataFrame, id_column: str = "vec_id", vector: str = "embedding", k: int = 20, query_step: int = 20, confidence: float = CONFIDENCE, leaf: int = LEAF) -> DataFrame:
    """The k nearest found for each row whose id is divisible by ``query_step``: query_id, rank, vec_id, score.

    Nearness is the largest inner product, in double precision on the original vectors; ties go to the smaller id.
    Vectors that are null, empty, zero, hold a null or a non-finite component, have no id, or another length than most
    (the shortest such length in a tie) take no part. Rows that share an id count once, with the smallest of their
    vectors. With fewer than k other rows all are returned. An empty table gives no rows.
    """
    rows = frame.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("v"))).withColumn("dims", F.size("v"))
    rows = stored(rows.groupBy("id", "dims").agg(F.min("v").alias("v")), "ann-rows")
    sizes = sorted(rows.groupBy("dims").count().orderBy(F.desc("count"), "dims").limit(1).collect())
    if not sizes:
        return frame.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims = sizes[0]["dims"]
    # where an id has vectors of several lengths only this one counts
    rows = rows.where(F.col("dims") == dims).select("id", F.transform("v", lambda x: x + F.lit(0.0)).alias("v"))
    rows = rows.withColumn("key", F.concat_ws("-", F.hex(F.xxhash64("v")), F.hex(F.xxhash64(F.lit(1), "v"))))
    # of a vector's ids the k + 1 smallest suffice: a query is at most one of them
    order = Window.partitionBy("key").orderBy("id")
    few = rows.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1)
    asked = rows.where(F.pmod("id", F.lit(query_step)) == 0).select(F.col("id").alias("query_id"), "key")
    asked = stored(asked, "ann-queries")
    groups = few.groupBy("key").agg(F.first("v").alias("v"), F.sort_array(F.collect_list("id")).alias("ids"))
    groups = groups.join(asked.select("key").distinct().withColumn("asks", F.lit(True)), "key", "left").withColumn("asks", F.coalesce("asks", F.lit(False)))
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    longest = rows.agg(F.max(square)).first()[0]

    normal = np.random.default_rng(20).standard_normal((dims + 1, PROJECTIONS))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = _matrix(batch["v"], dims)
            lifted = np.c_[table, np.sqrt(np.maximum(0, longest - (table**2).sum(1)))]
            # a query lies in the plane of the first components, at the length of the longest vector
            flat = np.c_[table * np.sqrt(longest / (table**2).sum(1, keepdims=True)), np.zeros(len(table))]
            yield pa.RecordBatch.from_arrays(
                [batch["key"], _bytes(table), batch["ids"], batch["asks"], _bytes(lifted @ normal), _bytes(flat @ normal)], ["key", "v", "ids", "asks", "p", "q"]
            )

    base = stored(groups.select("key", "v", "ids", "asks").mapInArrow(project, "key string, v binary, ids array<long>, asks boolean, p binary, q binary"), "ann-base")
    count = base.count()
    share = SAMPLE / max(1, count)
    drawn = base if share >= 1 else base.where(F.pmod(F.xxhash64("key"), F.lit(1_000_000)) < int(share * 1_000_000))
    sample = np.array([np.frombuffer(r[0]) for r in drawn.select("p").limit(2 * SAMPLE).collect()]).reshape(-1, PROJECTIONS)
    tree = Tree.build(sample, min(MOST_LEAVES, math.ceil(count / leaf)))
    radius = chi_square_quantile(confidence, PROJECTIONS)

    def into_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves = tree.leaf(_packed(batch["p"], PROJECTIONS))
            yield pa.RecordBatch.from_arrays([pa.array(leaves), batch["v"], batch["ids"], batch["p"]], ["leaf", "v", "ids", "p"])

    placed = base.select("v", "ids", "p").mapInArrow(into_leaves, "leaf long, v binary, ids array<long>, p binary")
    blocks = placed.repartition("leaf").sortWithinPartitions("leaf").mapInArrow(_pack_blocks, "leaf long, v binary, ids array<array<long>>, p binary")
    blocks = stored(blocks, "ann-blocks")

    def routes(first: bool):
        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 512):
                    part = batch.slice(at, 512)
                    lower = tree.distances(_packed(part["q"], PROJECTIONS))
                    near = min(FIRST_LEAVES, lower.shape[1])
                    order = np.argpartition(lower, near - 1, axis=1)[:, :near]
                    chosen = np.zeros(lower.shape, bool)
                    np.put_along_axis(chosen, order, True, axis=1)
                    if not first:
                        kth = part["kth"].to_numpy(zero_copy_only=False)
                        norms = np.sqrt((_packed(part["v"], dims) ** 2).sum(1))
                        chosen = ~chosen & (lower <= radius * _apart(kth, norms, longest)[:, None])
                    who, leaves = np.nonzero(chosen)
                    taken = part.take(pa.array(who))
                    kths = taken["kth"] if not first else pa.array(np.full(len(who), -np.inf))
                    yield pa.RecordBatch.from_arrays([pa.array(leaves), taken["key"], taken["v"], taken["q"], kths], ["leaf", "key", "v", "q", "kth"])

        return route

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                table, points = np.frombuffer(row["v"]).reshape(-1, dims), np.frombuffer(row["p"]).reshape(-1, PROJECTIONS)
                asking, flat = np.frombuffer(row["qv"]).reshape(-1, dims), np.frombuffer(row["qq"]).reshape(-1, PROJECTIONS)
                yield _searched(row, table, points, asking, flat, k + 1, radius, longest)

    routed = "leaf long, key string, v binary, q binary, kth double"
    queries = base.where("asks").select("key", "v", "q")

    def visit(frame: DataFrame, first: bool) -> DataFrame:
        packs = frame.mapInArrow(routes(first), routed).repartition("leaf").sortWithinPartitions("leaf").mapInArrow(_pack_queries, "leaf long, keys array<string>, qv binary, qq binary, kths array<double>")
        met = blocks.join(packs, "leaf").select("v", "ids", "p", "keys", "qv", "qq", "kths")
        # a row holds a block and a pack
        return met.mapInArrow(search, "key string, vec_id long, score double")

    best = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    first = stored(visit(queries, True), "ann-first")
    first = stored(first.withColumn("at", F.row_number().over(best)).where(F.col("at") <= k + 1).drop("at"), "ann-first")
    reached = first.groupBy("key").agg(F.when(F.count("*") > k, F.min("score")).otherwise(F.lit(float("-inf"))).alias("kth"))
    further = visit(queries.join(reached, "key", "left").withColumn("kth", F.coalesce("kth", F.lit(float("-inf")))), False)
    found = first.unionAll(further).withColumn("at", F.row_number().over(best)).where(F.col("at") <= k + 1)
    found = stored(found.groupBy("key").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id"))).alias("found")), "ann-found")
    answers = asked.join(found, "key").select("query_id", F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("found"))
    answers = answers.select("query_id", F.posexplode("found").alias("at", "x"))
    return answers.select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.far")).alias("score"))


def _apart(kth: np.ndarray, norms: np.ndarray, longest: float) -> np.ndarray:
    """Squared distance between a query and its k-th neighbour, both at the length of the longest vector."""
    return np.maximum(0, 2 * longest - 2 * kth * np.sqrt(longest) / norms)


def _matrix(lists: pa.Array, dims: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _bytes(table: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in np.ascontiguousarray(table)], pa.binary())


def _packed(values: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(values.to_pylist())).reshape(-1, width)


def _runs(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Slices of one leaf with at most so many rows, from rows sorted by leaf."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        leaves = batch["leaf"].to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(leaves)) + 1).tolist(), len(leaves)]
        for begin, end in zip(edges, edges[1:], strict=False):
            if begin == end:
                continue
            if rest and rest[0]["leaf"][0].as_py() != leaves[begin]:
                yield _one(rest)
                rest = []
            while begin < end:
                room = most - sum(x.num_rows for x in rest)
                rest.append(batch.slice(begin, min(room, end - begin)))
                begin += min(room, end - begin)
                if sum(x.num_rows for x in rest) >= most:
                    yield _one(rest)
                    rest = []
    if rest:
        yield _one(rest)


def _one(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def _joined(values: pa.Array) -> pa.Array:
    return pa.array([b"".join(values.to_pylist())], pa.binary())


def _pack_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for run in _runs(batches, BLOCK):
        ids = pa.array([run["ids"].to_pylist()], pa.list_(pa.list_(pa.int64())))
        yield pa.RecordBatch.from_arrays([run["leaf"].slice(0, 1), _joined(run["v"]), ids, _joined(run["p"])], ["leaf", "v", "ids", "p"])


def _pack_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for run in _runs(batches, PACK):
        keys, kths = pa.array([run["key"].to_pylist()], pa.list_(pa.string())), pa.array([run["kth"].to_pylist()], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([run["leaf"].slice(0, 1), keys, _joined(run["v"]), _joined(run["q"]), kths], ["leaf", "keys", "qv", "qq", "kths"])


def _searched(row: dict, table: np.ndarray, points: np.ndarray, asking: np.ndarray, flat: np.ndarray, k: int, radius: float, longest: float) -> pa.RecordBatch:
    """The best k of a block for each query of a pack; only vectors within the stopping radius are verified."""
    kths, norms = np.array(row["kths"]), np.sqrt((asking**2).sum(1))
    with np.errstate(invalid="ignore"):
        reach = np.where(np.isfinite(kths), radius * _apart(kths, norms, longest), np.inf)
    shown = (flat**2).sum(1)[:, None] + (points**2).sum(1)[None, :] - 2 * flat @ points.T
    keys, ids, scores = [], [], []
    for at in range(len(asking)):
        near = np.flatnonzero(shown[at] <= reach[at])
        if not len(near):
            continue
        score = table[near] @ asking[at]
        good = score >= kths[at]
        near, score = near[good], score[good]
        if len(near) > k:
            top = score >= np.partition(score, len(score) - k)[len(score) - k]
            near, score = near[top], score[top]
        for n, s in zip(near.tolist(), score.tolist(), strict=True):
            listed = row["ids"][n]
            keys += [row["keys"][at]] * len(listed)
            ids += listed
            scores += [s] * len(listed)
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(ids, pa.int64()), pa.array(scores, pa.float64())], ["key", "vec_id", "score"])
