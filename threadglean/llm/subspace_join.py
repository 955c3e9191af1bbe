"""Embedding near-duplicates (6) by a subspace pigeonhole join.

Unit vectors with cosine >= c are within squared distance 2 - 2c. After a seeded rotation
the dimensions are split into blocks of BLOCK_DIMS; if every block's squared distance
exceeded its share of that budget, in proportion to its dimensions, the whole would
exceed the budget. So each block is range-joined under its share, and the union of
the blocks' candidates, verified exactly on the original vectors, is whole.

A block's range join goes over cells: median cuts in the block, fitted on a bounded
sample. A vector stands in its own cell, and probes the cells that its ball of the
block's radius reaches. Cells with many vectors are split into tiles which
meet pairwise. A task gives counts and a spanning forest of its links, so
a large group of near copies makes as many rows as it has vectors, not pairs.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from threadglean.llm.components import Forest, components
from threadglean.llm.projection_search import _matrix, usable
from threadglean.operators.scale import cut_lineage, pin_small

BLOCK_DIMS = 8
CELL_ROWS = 4096
TILE_ROWS = 4096
SAMPLE_ROWS = 4096
MOST_CUTS = 12
# What floating point may add to a squared distance of unit vectors.
SLACK = 1e-9


def rotation(dim, seed=13):
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def blocks_of(dim):
    return [slice(a, min(a + BLOCK_DIMS, dim)) for a in range(0, dim, BLOCK_DIMS)]


class Cuts:
    """Median cuts of one block: cut number j at each node of level j, all levels full."""

    def __init__(self, points, depth):
        self.depth, self.axis, self.value = depth, [], []
        groups = [np.arange(len(points))]
        for _ in range(depth):
            axis, value, after = [], [], []
            for rows in groups:
                part = points[rows]
                a = int(np.argmax(part.var(0))) if len(rows) > 1 else 0
                v = float(np.median(part[:, a])) if len(rows) else 0.0
                axis.append(a)
                value.append(v)
                side = part[:, a] < v if len(rows) else np.zeros(0, bool)
                after += [rows[side], rows[~side]]
            self.axis.append(np.array(axis))
            self.value.append(np.array(value))
            groups = after

    def cells(self, points, radius=0.0):
        """(row, cell) pairs: the cells that the ball of each point reaches."""
        rows, cell = np.arange(len(points)), np.zeros(len(points), np.int64)
        for axis, value in zip(self.axis, self.value):
            gap = points[rows, axis[cell]] - value[cell]
            if radius:
                left, right = gap < radius, gap >= -radius
                rows = np.concatenate((rows[left], rows[right]))
                cell = np.concatenate((2 * cell[left], 2 * cell[right] + 1))
            else:
                cell = 2 * cell + (gap >= 0)
        return rows, cell


def _unit(vectors):
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def link_tile(home, home_ids, home_n, probe, probe_ids, probe_n, block, cosine):
    """(ids, counts, forest): links between two tiles found first in this block."""
    dim = home.shape[1]
    turn, parts = rotation(dim), blocks_of(dim)
    budget = 2 - 2 * cosine
    a_all, b_all = _unit(home), _unit(probe)
    a_turned, b_turned = a_all @ turn, b_all @ turn
    share = [budget * (p.stop - p.start) / dim + SLACK for p in parts]
    links_a, links_b = [], []
    mine = parts[block]
    b_square = (b_turned[:, mine] ** 2).sum(1)
    for at in range(0, len(home), 512):
        a = a_turned[at:at + 512, mine]
        apart = (a * a).sum(1)[:, None] + b_square - 2 * a @ b_turned[:, mine].T
        i, j = np.nonzero(apart <= share[block] + SLACK)
        keep = probe_ids[j] > home_ids[at + i]
        i, j = at + i[keep], j[keep]
        # A pair is taken in the first block that finds it.
        for b in range(block + 1):
            keep = _within(a_turned, b_turned, i, j, parts[b], share[b]) == (b == block)
            i, j = i[keep], j[keep]
        if len(i):
            keep = np.concatenate([
                (a_all[i[s:s + 65536]] * b_all[j[s:s + 65536]]).sum(1) >= cosine
                for s in range(0, len(i), 65536)])
            links_a.append(i[keep])
            links_b.append(j[keep])
    if not links_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), []
    i, j = np.concatenate(links_a), np.concatenate(links_b)
    ids, where = np.unique(np.concatenate((home_ids[i], probe_ids[j])), return_inverse=True)
    counts = np.bincount(where, np.concatenate((probe_n[j], home_n[i])), len(ids)).astype(np.int64)
    forest, edges = Forest(len(ids)), []
    for a, b in zip(where[:len(i)].tolist(), where[len(i):].tolist()):
        if forest.join(a, b):
            edges.append((a, b))
    return ids, counts, [(ids[a], ids[b]) for a, b in edges]


def _within(a, b, i, j, part, share):
    gap = a[i, part] - b[j, part]
    return (gap * gap).sum(1) <= share


def near_duplicates(rows, cosine=0.93, *, id_col="vec_id", vector_col="embedding", label_col="label"):
    """vec_id, n_links, component_id, kept of every row.

    Vectors are compared when their labels are equal and not null. Vectors that are null,
    empty, zero or hold null or non-finite components, and rows with a null label or id,
    link with nothing: n_links 0, their own id as component. Ids should
    identify vectors: where one id is the least of several groups of equal vectors,
    these count as one node, whose links are added up. Vectors meet
    only vectors of their own dimension. Equal vectors of a label are compared once,
    with their number. Other columns are not read. An empty table gives an empty one.
    """
    inner = rows.schema[vector_col].dataType.elementType.simpleString()
    inner = inner if inner in ("float", "double") else "double"
    slim = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                       F.col(vector_col).cast(f"array<{inner}>").alias("embedding"))
    takes_part = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("embedding")))
    keyed = slim.select(
        "vec_id", "label", "embedding", takes_part.alias("takes_part"),
        F.when(takes_part, F.md5(F.to_json(F.struct("label", "embedding")))).alias("key"))
    classes = cut_lineage(
        keyed.where("takes_part").groupBy("key").agg(
            F.min(F.struct("vec_id", "label", "embedding")).alias("v"), F.count("*").alias("n"))
        .select("key", "v.*", "n", F.size("v.embedding").alias("dim")))
    sizes = classes.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    depth = min(MOST_CUTS, max(0, int(np.ceil(np.log2(max(sizes, 1) / CELL_ROWS)))))
    sample = classes.orderBy(F.xxhash64("key"), "key").limit(SAMPLE_ROWS).select("embedding").collect()
    cuts = {}
    for dim in {len(r[0]) for r in sample}:
        turned = _unit(np.array([r[0] for r in sample if len(r[0]) == dim])) @ rotation(dim)
        cuts[dim] = [Cuts(turned[:, p], depth) for p in blocks_of(dim)]

    def place(radius_of):
        def run(batches):
            for batch in batches:
                for dim in set(batch.column(2).to_pylist()):
                    take = np.flatnonzero(np.asarray(batch.column(2)) == dim)
                    turned = _unit(_matrix(batch.column(1).take(pa.array(take)))) @ rotation(dim)
                    parts = blocks_of(dim)
                    fitted = cuts.get(dim) or [Cuts(np.zeros((0, 1)), 0)] * len(parts)
                    found = [c.cells(turned[:, p], radius_of(p, dim)) for c, p in zip(fitted, parts)]
                    row = np.concatenate([r for r, _ in found])
                    cell = np.concatenate([c for _, c in found])
                    block = np.repeat(np.arange(len(parts)), [len(r) for r, _ in found])
                    yield pa.RecordBatch.from_arrays(
                        [*[batch.column(i).take(pa.array(take[row])) for i in range(5)],
                         pa.array(block, pa.int32()), pa.array(cell, pa.int32())],
                        names=["label", "embedding", "dim", "vec_id", "n", "block", "cell"])
        return run

    kind = classes.schema["label"].dataType.simpleString()
    schema = f"label {kind}, embedding array<{inner}>, dim int, vec_id long, n long, block int, cell int"
    base = classes.select("label", "embedding", "dim", "vec_id", "n")
    home = base.mapInArrow(place(lambda p, dim: 0.0), schema)
    probe = base.mapInArrow(place(
        lambda p, dim: float(np.sqrt((2 - 2 * cosine) * (p.stop - p.start) / dim + 2 * SLACK))), schema)
    where = ["label", "dim", "block", "cell"]

    def tiles(frame, name):
        counted = frame.groupBy(*where).count().where(F.col("count") > TILE_ROWS)
        counted = counted.select(*where, F.ceil(F.col("count") / TILE_ROWS).cast("int").alias(name))
        counted, few = pin_small(counted)
        return F.broadcast(counted) if few else counted

    n_home, n_probe = tiles(home, "n_home"), tiles(probe, "n_probe")

    def dealt(frame, own, other):
        own_tile = F.pmod(F.xxhash64("vec_id", "embedding"), F.coalesce(f"n_{own}", F.lit(1))).cast("int")
        other_tile = F.explode(F.sequence(F.lit(0), F.coalesce(f"n_{other}", F.lit(1)) - 1))
        return frame.join(n_home, where, "left").join(n_probe, where, "left").select(
            *frame.columns, own_tile.alias(f"{own}_tile"), f"n_{other}").select(
            *frame.columns, f"{own}_tile", other_tile.alias(f"{other}_tile"))

    def meet(left, right):
        found = np.zeros(0, np.int64), np.zeros(0, np.int64), []
        if left.num_rows and right.num_rows:
            found = link_tile(
                _matrix(left["embedding"]), np.asarray(left["vec_id"]), np.asarray(left["n"]),
                _matrix(right["embedding"]), np.asarray(right["vec_id"]), np.asarray(right["n"]),
                left["block"][0].as_py(), cosine)
        ids, counts, edges = found
        return pa.table([pa.array([*ids.tolist(), *[int(a) for a, _ in edges]], pa.int64()),
                         pa.array([*counts.tolist(), *[0] * len(edges)], pa.int64()),
                         pa.array([*[None] * len(ids), *[int(b) for _, b in edges]], pa.int64())],
                        names=["u", "links", "v"])

    key = [*where, "home_tile", "probe_tile"]
    found = cut_lineage(
        dealt(home, "home", "probe").groupBy(*key).cogroup(dealt(probe, "probe", "home").groupBy(*key))
        .applyInArrow(meet, "u long, links long, v long"))
    links = found.groupBy("u").agg(F.sum("links").alias("links"))
    joined = components(found.where("v is not null").select("u", "v"))
    classed = (
        classes.select("key", F.col("vec_id").alias("u"), "n").join(links, "u", "left")
        .join(joined, F.col("u") == F.col("id"), "left")
        .select("key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                F.coalesce("component", "u").alias("component_id")))
    return keyed.select("vec_id", "key").join(classed, "key", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
