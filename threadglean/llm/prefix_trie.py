"""Conversation prefix trie (12) in double arrays.

A conversation is a row of slim turns: two 64-bit hashes of role and text, and the text's
code points. Equal conversations are one sequence, so copies weigh nothing from there on.
Distinct sequences are sorted over range partitions and cut into prefix shards of
SHARD_SEQUENCES, which are stretches of the sorted order. A shard numbers its distinct turns
densely, packs its trie into BASE and CHECK arrays level by level, and walks its sequences
through them for the aggregates of the nodes.

Only the nodes on the path to the sequence before or after a shard also stand in other
shards: these upper nodes are merged by their prefix hash. All aggregates add up: members
and leaves belong to one sequence each, and a node is counted as a child, and with its
text, in the first shard that holds it.

The ids of a node's conversations are formatted in stretches of 8192 ids and hashed as a stream.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Window, functions as F

from threadglean.llm.textbytes import mix
from threadglean.operators.scale import cut_lineage, lookup_join

SHARD_SEQUENCES = 4_096
_ROW_BITS = 33          # monotonically_increasing_id keeps the partition above
_STRETCH_BITS = 13      # conversation ids that are formatted at once
_TRIES = 64             # places tried at once for a node with several children
EMPTY = hashlib.sha256(b"").digest()


class DoubleArray:
    """A trie that is packed level by level. Node `s` has the child under symbol `c` at
    t = BASE[s] + c if CHECK[t] = s; the root is node 0. Bases may be negative."""

    def __init__(self, size):
        self.base = np.zeros(size, np.int64)
        self.check = np.full(size, -1, np.int64)
        self.check[0] = -2      # the root is nobody's child
        self.free = 1           # no free place before it

    def _room(self, size):
        if size > len(self.base):
            more = max(size, 2 * len(self.base)) - len(self.base)
            self.base = np.concatenate((self.base, np.zeros(more, np.int64)))
            self.check = np.concatenate((self.check, np.full(more, -1, np.int64)))

    def _fit(self, symbols):
        """The least base from the first free place on at which all symbols find one."""
        offsets, at = symbols - symbols[0], self.free
        while True:
            self._room(at + _TRIES + int(offsets[-1]) + 1)
            starts = np.arange(at, at + _TRIES)
            good = (self.check[starts[:, None] + offsets] < 0).all(axis=1)
            if good.any():
                return int(starts[np.argmax(good)] - symbols[0])
            at += _TRIES

    def grow(self, states, symbols):
        """Add the children of a level: distinct (state, symbol) pairs in ascending order."""
        head = np.flatnonzero(np.concatenate(([True], states[1:] != states[:-1])))
        size = np.diff(np.append(head, len(states)))
        for i in np.flatnonzero(size > 1).tolist():
            own = slice(head[i], head[i] + size[i])
            self.base[states[head[i]]] = base = self._fit(symbols[own])
            self.check[base + symbols[own]] = states[head[i]]
        single = head[size == 1]
        if len(single):
            # One child fits in any place.
            self._room(self.free + len(single))
            free = self.free + np.flatnonzero(self.check[self.free:] < 0)
            if len(free) < len(single):
                begin = len(self.check)
                self._room(begin + len(single))
                free = np.concatenate((free, np.arange(begin, begin + len(single))))
            free = free[:len(single)]
            self.base[states[single]] = free - symbols[single]
            self.check[free] = states[single]
        left = np.flatnonzero(self.check[self.free:] < 0)
        self.free = self.free + int(left[0]) if len(left) else len(self.check)

    def step(self, states, symbols):
        """The nodes under `symbols`; -1 where there is none."""
        to = self.base[states] + symbols
        inside = (to >= 0) & (to < len(self.check))
        out = np.full(len(to), -1, np.int64)
        ok = np.flatnonzero(inside)
        ok = ok[self.check[to[ok]] == states[ok]]
        out[ok] = to[ok]
        return out


def _hash_step(a, b, k1, k2):
    """Prefix hashes one turn further."""
    return (mix(a * np.uint64(0x9E3779B97F4A7C15) + k1 + np.uint64(1)),
            mix(b * np.uint64(0xC2B2AE3D27D4EB4F) + k2 + np.uint64(1)))


def shard_nodes(lengths, k1, k2, chars, n, low, own):
    """Nodes of a shard's sequences, which come in sorted order.

    `own` is False for the sequences before and after the shard, which only tell which
    nodes are shared. Gives a dict of arrays, one entry per node, and the node at which each
    sequence ends.
    """
    first = np.cumsum(lengths) - lengths
    keys = np.empty(len(k1), [("a", np.uint64), ("b", np.uint64)])
    keys["a"], keys["b"] = k1, k2
    _, symbols = np.unique(keys, return_inverse=True)
    symbols = symbols.reshape(-1).astype(np.int64)
    trie = DoubleArray(2 * len(symbols) + 2)
    state = np.zeros(len(lengths), np.int64)
    levels, steps = [np.zeros(1, np.int64)], []
    for depth in range(int(lengths.max(initial=0))):
        live = np.flatnonzero(lengths > depth)
        at = first[live] + depth
        pairs = np.unique(state[live] * len(symbols) + symbols[at])
        states, under = np.divmod(pairs, len(symbols))
        trie.grow(states, under)
        state[live] = trie.step(state[live], symbols[at])
        levels.append(trie.step(states, under))
        steps.append((live, at))
    size = len(trie.check)
    nodes = np.concatenate(levels)
    out = {"a": np.zeros(size, np.uint64), "b": np.zeros(size, np.uint64), "chars": np.zeros(size, np.int64),
           "depth": np.zeros(size, np.int64), "n": np.zeros(size, np.int64),
           "low": np.full(size, np.iinfo(np.int64).max), "shared": np.zeros(size, bool),
           "fresh": np.zeros(size, bool), "children": np.zeros(size, np.int64),
           "leaves": np.zeros(size, np.int64), "saved": np.zeros(size, np.int64)}
    # The walk: prefix hashes, members, nodes that other shards hold too.
    walked = np.zeros(len(lengths), np.int64)
    before = np.zeros(size, bool)
    for depth in range(len(levels)):
        if depth:
            live, at = steps[depth - 1]
            parent = walked[live]
            walked[live] = here = trie.step(parent, symbols[at])
            out["a"][here], out["b"][here] = _hash_step(out["a"][parent], out["b"][parent], k1[at], k2[at])
            out["chars"][here], out["depth"][here] = chars[at], depth
        else:
            live, here = np.arange(len(lengths)), walked.copy()
        inside = own[live]
        np.add.at(out["n"], here[inside], n[live[inside]])
        np.minimum.at(out["low"], here[inside], low[live[inside]])
        out["shared"][here[~inside]] = True
        if len(own) and not own[0]:
            before[here[live == 0]] = True
    out["fresh"][nodes] = ~before[nodes]
    held = out["n"] > 0
    parent_of = np.maximum(trie.check, 0)
    # From the deepest level up: each node's own share, then that of its subtree.
    ends = np.zeros(size, bool)
    ends[state[own]] = True
    inner = np.zeros(size, bool)
    for level in levels[1:]:
        inner[parent_of[level]] = True      # the next shard's first sequence counts here too
    out["leaves"][ends & ~inner] = 1
    out["saved"][nodes] = out["chars"][nodes] * (out["n"][nodes] - out["fresh"][nodes])
    for level in reversed(levels[1:]):
        level = level[held[level]]
        up = parent_of[level]
        np.add.at(out["saved"], up, out["saved"][level])
        np.add.at(out["leaves"], up, out["leaves"][level])
        np.add.at(out["children"], up, out["fresh"][level].astype(np.int64))
    nodes = nodes[held[nodes]]
    out = {k: v[nodes] for k, v in out.items()}
    above = parent_of[nodes]
    place = np.full(size, -1, np.int64)
    place[nodes] = np.arange(len(nodes))
    out["above"] = place[above]
    return out, place[state]


NODE = ("a long, b long, depth long, up_a long, up_b long, up_low long, up_shared boolean, shared boolean, "
        "low long, n long, children long, leaves long, saved long, ends binary")


def _shard(table):
    """The nodes of one shard, as rows of NODE."""
    order = np.argsort(np.asarray(table["place"]), kind="stable")
    table = table.take(pa.array(order)).combine_chunks()
    turns = table["turns"].chunk(0) if table["turns"].num_chunks else table["turns"].combine_chunks()
    lengths = np.diff(np.asarray(turns.offsets))
    flat = turns.flatten()
    k1, k2 = (np.asarray(flat.field(i)).astype(np.int64).view(np.uint64) for i in (0, 1))
    own = np.asarray(table["own"])
    found, end = shard_nodes(lengths, k1, k2, np.asarray(flat.field(2)).astype(np.int64),
                             np.asarray(table["n"]), np.asarray(table["low"]), own)
    ends = np.full(len(found["n"]), -1, np.int64)
    ends[end[own]] = np.flatnonzero(own)
    above = found["above"]

    def signed(x):
        return pa.array(x.view(np.int64))

    return pa.table(
        [signed(found["a"]), signed(found["b"]), pa.array(found["depth"]),
         signed(found["a"][above]), signed(found["b"][above]), pa.array(found["low"][above]),
         pa.array(found["shared"][above]), pa.array(found["shared"]), pa.array(found["low"]), pa.array(found["n"]),
         pa.array(found["children"]), pa.array(found["leaves"]), pa.array(found["saved"]),
         table["ends"].combine_chunks().take(pa.array(ends, mask=ends < 0))],
        names=[x.split()[0] for x in NODE.split(", ")])


def rebuilt(turns, *, family=100, most_shared=6):
    """conv_id, turns: every conversation with the first turns of its family's first one.

    Conversation c takes the first h turns of conversation c - c % family, with h =
    crc32(c) % most_shared, and then its own after its first h. A turn is a struct
    (k1, k2, chars).
    """
    role, text = (F.coalesce(F.col(x), F.lit("")) for x in ("role", "text"))
    base = F.col("conv_id") - F.col("conv_id") % family
    slim = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"),
        F.xxhash64(F.lit(1), role, text).alias("k1"), F.xxhash64(F.lit(2), role, text).alias("k2"),
        F.char_length(text).cast("int").alias("chars")).withColumn("base", base)
    # Nulls of a struct come first, too.
    listed = slim.repartition("base").groupBy("base", "conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "k1", "k2", "chars"))).alias("own"))
    own = F.transform("own", lambda t: F.struct(t["k1"].alias("k1"), t["k2"].alias("k2"), t["chars"].alias("chars")))
    listed = cut_lineage(listed.select("base", "conv_id", own.alias("own")))
    heads = listed.where("conv_id = base").select("base", F.slice("own", 1, most_shared).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most_shared).cast("int")
    head = F.coalesce("head", F.slice("own", 1, 0))
    return listed.join(heads, "base", "left").select("conv_id", F.concat(
        F.slice(head, F.lit(1), h), F.slice(F.col("own"), h + 1, F.greatest(F.size("own") - h, F.lit(0)))
    ).alias("turns"))


def _digests(batches):
    """s1, s2, n, low, ends: the members of a sequence, from stretches of ids in order."""
    now, digest, n, low, done = None, None, 0, 0, []

    def flush():
        columns = list(zip(*done)) or [[]] * 5
        done.clear()
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                          names=["s1", "s2", "n", "low", "ends"])

    for batch in batches:
        for s1, s2, ids, count, least in zip(*(c.to_pylist() for c in batch.columns)):
            if now != (s1, s2):
                if now is not None:
                    done.append((*now, n, low, digest.digest()))
                now, digest, n, low = (s1, s2), hashlib.sha256(), 0, least
            elif n:
                digest.update(b",")
            digest.update(ids.encode())
            n, low = n + count, min(low, least)
        yield flush()
    if now is not None:
        done.append((*now, n, low, digest.digest()))
        yield flush()


def _sequences(conversations):
    """turns, n, low, ends: the distinct sequences with their members."""
    marked = cut_lineage(conversations.select(
        "conv_id", "turns", F.xxhash64(F.lit(1), "turns").alias("s1"), F.xxhash64(F.lit(2), "turns").alias("s2")))
    stretches = marked.groupBy("s1", "s2", F.shiftright("conv_id", _STRETCH_BITS).alias("stretch")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")), ",").alias("ids"), F.count("*").alias("n"),
        F.min("conv_id").alias("low"))
    members = stretches.repartition("s1", "s2").sortWithinPartitions("s1", "s2", "stretch").select(
        "s1", "s2", "ids", "n", "low").mapInArrow(_digests, "s1 long, s2 long, n long, low long, ends binary")
    # Copies meet map by map first, so a hot sequence arrives once per task.
    once = marked.groupBy("s1", "s2").agg(F.first("turns").alias("turns"))
    return once.join(members, ["s1", "s2"]).select("turns", "n", "low", "ends")


def nodes(turns, *, family=100, most_shared=6, shard_sequences=SHARD_SEQUENCES):
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and
    ends_sha256 of every node of the trie of rebuilt conversations.

    The turns of a conversation are ordered by turn, null first; turns of one number stand
    in the order of a digest of role and text. A null role or text is empty. Rows with a
    null conv_id belong to no conversation. Repeated rows are turns of their own. A family
    without its first conversation lends no turns. Other columns are not read. An
    empty table has no nodes. Two hashes of 64 bits each tell turns and prefixes apart.

    Texts are read once and stay where they are. The slim turns of one conversation, 20
    bytes each, are one row.
    """
    keys = F.transform("turns", lambda t: t["k1"])
    spread = _sequences(rebuilt(turns, family=family, most_shared=most_shared))
    # Orders by the first hashes; rows that agree in them are told apart inside a partition.
    ordered = cut_lineage(
        spread.withColumn("key", keys).repartitionByRange("key").sortWithinPartitions("key", "turns")
        .drop("key").withColumn("at", F.monotonically_increasing_id()))
    row = F.col("at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    placed = (ordered.withColumn("range", F.shiftright("at", _ROW_BITS))
              .withColumn("part", F.floor(row / shard_sequences)))
    shards = placed.groupBy("range", "part").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    # One row per shard, so this order is a small one.
    inner = Window.orderBy("range", "part")
    shards = cut_lineage(shards.select(
        "range", "part", F.row_number().over(inner).alias("shard"), F.lag("last").over(inner).alias("before"),
        F.lead("first").over(inner).alias("after")))
    own = lookup_join(placed, shards.select("range", "part", "shard"), ["range", "part"], "inner",
                      spread=["at"]).select("shard", F.col("at").alias("place"), "turns", "n", "low", "ends",
                                            F.lit(True).alias("own"))
    edges = shards.select("shard", F.explode(F.array("before", "after")).alias("at")).dropna()
    around = lookup_join(ordered, edges, "at", "inner", spread=["n"]).select(
        "shard", F.col("at").alias("place"), "turns", "n", "low", "ends", F.lit(False).alias("own"))
    found = cut_lineage(own.unionByName(around).groupBy("shard").applyInArrow(_shard, NODE))
    upper = cut_lineage(found.where("shared").groupBy("a", "b").agg(
        F.first("depth").alias("depth"), F.first("up_a").alias("up_a"), F.first("up_b").alias("up_b"),
        *[F.sum(x).alias(x) for x in ("n", "children", "leaves", "saved")], F.min("low").alias("low"),
        F.max("ends").alias("ends")))
    below = found.where("not shared").select(*upper.columns, "up_low", "up_shared")
    every = upper.select("*", F.lit(None).cast("long").alias("up_low"), F.lit(True).alias("up_shared")).unionByName(below)
    parents = upper.select(F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("low").alias("merged_low"))
    named = lookup_join(every.where("up_shared"), parents, ["up_a", "up_b"], "left", spread=["a", "b"]).withColumn(
        "up_low", F.col("merged_low")).drop("merged_low")
    parent = F.when(F.col("depth") > 0, F.col("up_low"))
    return named.unionByName(every.where("not up_shared")).select(
        F.col("low").alias("conv_id"), "depth", parent.alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.lower(F.hex(F.coalesce("ends", F.lit(EMPTY)))).alias("ends_sha256"))
