"""Mixing sources to target weights (3) by Pfair scheduling, with DataFrame functions only.

Rows of a source, in a seeded random order, form blocks. By its exact weight, a source's
block j falls due over a stretch of time; it may not go out before the slot in which that
stretch begins and must be out by the slot in which it ends; in each slot, the released
block with the earliest deadline goes. So after every slot each source is less than
one block away from its weight, over the whole corpus.

When a source has, by its weight, no block left, the stretches of the others go on at
renormalised weights: all rows go out. The schedule is worked out from the numbers
of rows per source, a chunk of slots at a time, and joined to the rows by source and block.
"""

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from threadglean.operators.scale import cut_lineage, lookup_join, number_rows, rank_rows

# Period of whole_shares(), one_period() and phases(), which mix() does not use: a
# schedule that repeats keeps to rounded weights only.
PERIOD = 1024
# Slots that are worked out at a time, and the most blocks that are sent to all executors.
CHUNK_SLOTS = 1 << 20
PLAN_PIN_ROWS = 500_000


def whole_shares(weights, period):
    """Positive whole numbers that add up to `period`, nearest to the weights."""
    total = sum(weights)
    exact = [w * period / total for w in weights]
    shares = [max(1, int(x)) for x in exact]
    order = sorted(range(len(weights)), key=lambda i: (shares[i] - exact[i], i))
    for turn in range(period - sum(shares)):
        shares[order[turn % len(order)]] += 1
    while sum(shares) > period:
        i = max(range(len(shares)), key=lambda i: (shares[i] - exact[i]) * (shares[i] > 1))
        shares[i] -= 1
    return shares


def one_period(shares):
    """For each source, the slots of its blocks in a period, by earliest deadline."""
    period = sum(shares)
    done = [0] * len(shares)
    waiting = [(0, i) for i in range(len(shares))]  # by release
    heapq.heapify(waiting)
    ready, slots = [], [[] for _ in shares]
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            i = heapq.heappop(waiting)[1]
            heapq.heappush(ready, (-(-(done[i] + 1) * period // shares[i]), i))
        deadline, i = heapq.heappop(ready)
        if deadline <= slot:
            raise AssertionError("a deadline was missed")
        slots[i].append(slot)
        done[i] += 1
        if done[i] < shares[i]:
            heapq.heappush(waiting, (done[i] * period // shares[i], i))
    return slots


def phases(blocks, weights, period=PERIOD):
    """(source, phase, first block, blocks, first slot, period, slots) for each source and phase."""
    period = max(period, 4 * len(blocks))
    left = {i: n for i, n in enumerate(blocks) if n}
    used, at, phase, out = dict.fromkeys(left, 0), 0, 0, []
    while left:
        active = sorted(left)
        shares = whole_shares([weights[i] for i in active], period)
        slots = one_period(shares)
        # The slot in which a source is asked for a block it doesn't have.
        length = min((left[i] // n) * period + s[left[i] % n]
                     for i, n, s in zip(active, shares, slots))
        whole, rest = divmod(length, period)
        for i, n, s in zip(active, shares, slots):
            taken = whole * n + sum(x < rest for x in s)
            if taken:
                out.append((i, phase, used[i], taken, at, period, s))
            used[i] += taken
            left[i] -= taken
            if not left[i]:
                del left[i]
        at, phase = at + length, phase + 1
    return out


class Fluid:
    """Every source served at its exact weight, all of them one block a slot, until it runs out.

    The clock of a source's service: `weight` times clock blocks have gone out. `time`
    turns it into slots; the two part in pace whenever a source has run out.
    """

    def __init__(self, blocks, weights):
        self.blocks = np.asarray(blocks, np.int64)
        self.weights = np.asarray(weights, np.longdouble)
        if not (np.isfinite(self.weights) & (self.weights > 0)).all():
            raise ValueError("weights must be positive numbers")
        out = self.blocks / self.weights
        order = np.argsort(out, kind="stable")
        self.out = out[order]
        # With k sources run out: their blocks, and the weight of the others.
        self.gone = np.concatenate(([0], np.cumsum(self.blocks[order])))
        self.left = np.concatenate((np.cumsum(self.weights[order][::-1])[::-1], [0]))
        self.ends = self.time(self.out)

    def time(self, clock):
        """Slots at readings of the clock; a hair beside a whole number is that number."""
        k = np.searchsorted(self.out, clock)
        slots = self.gone[k] + clock * self.left[k]
        whole = np.rint(slots)
        return np.where(np.abs(slots - whole) < 1e-9 + 1e-15 * whole, whole, slots)

    def clock(self, slot):
        k = min(np.searchsorted(self.ends, slot), len(self.out) - 1)
        return min((slot - self.gone[k]) / self.left[k], self.out[-1])


def schedule(blocks, weights, chunk=CHUNK_SLOTS):
    """(source, block, slot, phase) arrays, a chunk of slots at a time, by earliest deadline.

    `blocks` are positive. A phase is a stretch between two times at which sources run out.
    Holds a chunk and one entry per source.
    """
    fluid = Fluid(blocks, weights)
    many, total = len(fluid.blocks), int(fluid.blocks.sum())
    chunk = max(chunk, many)
    ends = np.unique(fluid.ends)
    released, done = np.zeros(many, np.int64), np.zeros(many, np.int64)
    ready = []
    for begin in range(0, total, chunk):
        end = min(begin + chunk, total)
        # Blocks released before `end`; two more a source, as the clock is not exact.
        upto = np.minimum(fluid.blocks, (fluid.weights * fluid.clock(end)).astype(np.int64) + 2)
        counts = np.maximum(upto - released, 0)
        i = np.repeat(np.arange(many), counts)
        j = np.arange(len(i)) + np.repeat(released - (np.cumsum(counts) - counts), counts)
        release = np.floor(fluid.time(j / fluid.weights[i])).astype(np.int64)
        i, j, release = (x[release < end] for x in (i, j, release))
        released += np.bincount(i, minlength=many)
        deadline = np.ceil(fluid.time((j + 1) / fluid.weights[i])).astype(np.int64)
        order = np.argsort(release, kind="stable")
        keys, begins = (deadline * many + i)[order].tolist(), release[order].tolist()
        went, at = [], 0
        for slot in range(begin, end):
            while at < len(begins) and begins[at] <= slot:
                heapq.heappush(ready, keys[at])
                at += 1
            went.append(heapq.heappop(ready))
        deadline, i = np.divmod(np.array(went, np.int64), many)
        slots = np.arange(begin, end)
        if (deadline <= slots).any():
            raise AssertionError("a deadline was missed")
        order = np.argsort(i, kind="stable")
        counts = np.bincount(i, minlength=many)
        j = np.empty(len(i), np.int64)
        j[order] = np.arange(len(i)) + np.repeat(done - (np.cumsum(counts) - counts), counts)
        done += counts
        yield i, j, slots, np.searchsorted(ends, slots + 1)


def plan_blocks(spark, counts, weights, block):
    """The schedule as a table: source number, block, slot, phase, position of the first row."""
    counts = np.asarray(counts, np.int64)
    blocks = -(-counts // block)
    kind = "__source_no long, __block long, __slot long, __phase int, __start long"
    names = [c.split()[0] for c in kind.split(", ")]
    many, at, parts = int(blocks.sum()) > max(CHUNK_SLOTS, len(blocks)), 0, []
    for i, j, slots, phase in schedule(blocks, weights, CHUNK_SLOTS):
        ends = at + np.cumsum(np.minimum(block, counts[i] - j * block))
        starts, at = np.concatenate(([at], ends[:-1])), int(ends[-1])
        part = spark.createDataFrame(pa.table(
            [pa.array(x) for x in (i, j, slots, phase.astype(np.int32), starts)], names=names), kind)
        parts.append(cut_lineage(part) if many else part)
    plan = parts[0]
    for part in parts[1:]:
        plan = plan.unionByName(part)
    return plan, int(blocks.sum())


def mix(rows, *, weights=None, temperature=0.5, block=16, source_col="source",
        order_cols=("doc_id",), seed=29):
    """All rows with `block`, `slot`, `phase` and `position` (0, 1, 2, ... without gaps).

    `weights` maps sources to positive numbers (missing: 1); without it a source
    weighs its number of rows to the power `temperature`. A null source is a source. Rows that
    agree in `order_cols` are interchangeable. Columns with the names of the new
    ones are replaced. The driver holds two numbers per source and a chunk of slots, no
    names; rows are ranked over ranges, so a source may hold any share of them. Texts and null ids
    are columns like others: rows are handed on whole. An empty table gives an empty one.
    """
    spark = rows.sparkSession
    rows = rows.drop("block", "slot", "phase", "position")
    columns = rows.columns
    source = F.col(source_col)
    sources = cut_lineage(rows.groupBy(source.alias("__source")).agg(F.count("*").alias("__rows")))
    if weights:
        given = spark.createDataFrame([(s, float(w)) for s, w in weights.items()],
                                      f"__given {rows.schema[source_col].dataType.simpleString()}, __pull double")
        sources = cut_lineage(sources.join(given, F.col("__source").eqNullSafe(F.col("__given")), "left").select(
            "__source", "__rows", F.coalesce("__pull", F.lit(1.0)).alias("__pull")))
    name = F.col("__source")
    sources = number_rows(sources, [name.isNotNull(), name.cast("string")], "__no").withColumn(
        "__source_no", F.col("__no") - 1)
    held = sources.select("__source_no", "__rows", *["__pull"] * bool(weights)).toArrow()
    if not held.num_rows:
        return rows.select("*", F.lit(0).cast("long").alias("block"), F.lit(0).cast("long").alias("slot"),
                           F.lit(0).alias("phase"), F.lit(0).cast("long").alias("position"))
    held = held.sort_by("__source_no")
    counts = np.asarray(held["__rows"])
    pull = np.asarray(held["__pull"]) if weights else counts.astype(float) ** temperature
    plan, n_blocks = plan_blocks(spark, counts, pull, block)
    plan = lookup_join(plan, sources.select("__source_no", "__source"), ["__source_no"], "inner", "__block")
    plan = plan.drop("__source_no")
    dealt = rows.withColumn("__deal", F.xxhash64(F.lit(seed), *order_cols))
    ranked = rank_rows(dealt, source_col, ["__deal", *[F.col(c) for c in order_cols]], "__rank",
                       small_limit=0)
    numbered = ranked.withColumn("__own", F.expr(f"(__rank - 1) div {block}"))
    placed = numbered.join(F.broadcast(plan) if n_blocks <= PLAN_PIN_ROWS else plan,
                           source.eqNullSafe(F.col("__source")) & (F.col("__own") == F.col("__block")))
    position = F.col("__start") + F.pmod(F.col("__rank") - 1, F.lit(block))
    return placed.select(
        *columns, F.col("__block").alias("block"), F.col("__slot").alias("slot"),
        F.col("__phase").alias("phase"), position.cast("long").alias("position"))


def in_order(mixed):
    """The rows in schedule order: ranges of positions, sorted within, one after another."""
    n = int(mixed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return mixed.repartitionByRange(n, "position").sortWithinPartitions("position")
