"""Nearest neighbours (7) by a few stable projections and a kd-tree over them.

Vectors are projected to M dimensions with Gaussian weights: the squared projected
distance of a pair, over its squared true distance, is chi-square with M degrees
of freedom. A shard's projections stand in a kd-tree; a query takes its leaves in the
order of projected distance and verifies their vectors, until a vector as near as
the k-th best would have come up already with probability CONFIDENCE.

Every vector is indexed; the stopping test alone makes the search approximate.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Window, functions as F

M = 8
CONFIDENCE = 0.97
LEAF = 32
SHARD_ROWS = 8192
QUERY_ROWS = 4096


def chi_square_cdf(x):
    """Of M (even) degrees of freedom."""
    half = np.minimum(np.asarray(x, float) / 2, 700.0)
    terms = sum(half**j / math.factorial(j) for j in range(M // 2))
    return 1 - np.exp(-half) * terms


def usable(embedding):
    """Neither null nor empty, zero or with null or non-finite components."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return embedding.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(embedding, lambda x: x != 0)


def projection(dim, seed=7):
    return np.random.default_rng(seed).standard_normal((dim, M))


class KdTree:
    """Leaves of at most LEAF rows by median cuts of the widest side, with their boxes."""

    def __init__(self, points):
        self.leaves, low, high = [], [], []
        todo = [np.arange(len(points))]
        while todo:
            rows = todo.pop()
            part = points[rows]
            lo, hi = part.min(0), part.max(0)
            if len(rows) <= LEAF:
                self.leaves.append(rows)
                low.append(lo)
                high.append(hi)
                continue
            order = np.argpartition(part[:, np.argmax(hi - lo)], len(rows) // 2)
            todo += [rows[order[:len(rows) // 2]], rows[order[len(rows) // 2:]]]
        self.low, self.high = np.array(low), np.array(high)

    def by_distance(self, point):
        """(leaf numbers, squared distances of their boxes), nearest first."""
        gap = np.maximum(0, np.maximum(self.low - point, point - self.high))
        far = (gap * gap).sum(1)
        order = np.argsort(far, kind="stable")
        return order, far[order]


def search(vectors, ids, queries, query_ids, k, step=8):
    """(query row, position, distance) of the k nearest found for each query."""
    weights = projection(vectors.shape[1])
    tree = KdTree(vectors @ weights)
    placed = queries @ weights
    # Copies of a query may be projected so far away (squared) by rounding: a sum's error is
    # at most its length times the unit roundoff, relative to both norms.
    rounding = 4 * vectors.shape[1] * np.finfo(float).eps
    slack = rounding**2 * (weights * weights).sum() * (queries * queries).sum(1)
    out = []
    for q in range(len(queries)):
        order, far = tree.by_distance(placed[q])
        best_d, best_i = np.zeros(0), np.zeros(0, np.int64)
        for at in range(0, len(order), step):
            if len(best_d) == k and far[at] > slack[q]:
                kth = best_d[-1] ** 2
                if kth == 0 or chi_square_cdf(far[at] / kth) >= CONFIDENCE:
                    break
            rows = np.concatenate([tree.leaves[i] for i in order[at:at + step]])
            rows = rows[ids[rows] != query_ids[q]]
            apart = vectors[rows] - queries[q]
            d = np.concatenate((best_d, np.sqrt((apart * apart).sum(1))))
            i = np.concatenate((best_i, rows))
            first = np.lexsort((ids[i], d))[:k]
            best_d, best_i = d[first], i[first]
        out.append((np.full(len(best_i), q), best_i, best_d))
    return [np.concatenate(x) for x in zip(*out)]


def _matrix(column):
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = np.asarray(column.flatten(), dtype=np.float64)
    return flat.reshape(len(column), -1)


def nearest(rows, k=10, *, every=100, id_col="vec_id", vector_col="embedding"):
    """query_id, rank, vec_id, score: the `k` nearest rows by Euclidean distance.

    Queries are the rows whose id is divisible by `every`; candidates are all
    rows but those with the query's own id. Rows with a null id, and vectors that
    are null, empty, zero or hold null or non-finite components, take no part;
    vectors meet only vectors of their own dimension. Equal distances go by the
    smaller id; a repeated candidate row is found as often as it occurs; a
    repeated query row counts once per distinct vector. Rows are dealt by id over shards of about
    SHARD_ROWS; each shard meets the queries in blocks of about QUERY_ROWS. An empty table
    gives an empty one. Other columns are not read.
    """
    usable_rows = rows.select(F.col(id_col).cast("long").alias("vec_id"),
                              F.col(vector_col).cast("array<double>").alias("embedding"))
    usable_rows = usable_rows.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    asked = usable_rows.where(F.col("vec_id") % every == 0).distinct()
    shards = max(1, -(-usable_rows.count() // SHARD_ROWS))
    blocks = max(1, -(-asked.count() // QUERY_ROWS))
    # A row number, not the id, deals the rows: repeated ids don't pile up.
    dealt = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(shards))
    index = usable_rows.select(
        "*", F.size("embedding").alias("dim"), dealt.alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    questions = asked.select(
        "*", F.size("embedding").alias("dim"),
        # Tells apart queries that share an id but not a vector.
        F.xxhash64("embedding").alias("asked"),
        F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"))

    def meet(left, right):
        names = ["query_id", "asked", "vec_id", "score"]
        if not left.num_rows or not right.num_rows:
            none = [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.float64())]
            return pa.table(none, names=names)
        ids, query_ids = np.asarray(left["vec_id"]), np.asarray(right["vec_id"])
        queries = _matrix(right["embedding"])
        q, i, d = search(_matrix(left["embedding"]), ids, queries, query_ids, k)
        return pa.table([pa.array(query_ids[q]), right["asked"].combine_chunks().take(pa.array(q)),
                         pa.array(ids[i]), pa.array(d)], names=names)

    found = index.groupBy("dim", "shard", "block").cogroup(
        questions.groupBy("dim", "shard", "block")
    ).applyInArrow(meet, "query_id long, asked long, vec_id long, score double")
    window = Window.partitionBy("query_id", "asked").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
