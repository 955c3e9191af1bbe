"""N-gram Jaccard join (10) with signature trees.

Documents are sets of word shingles; two link if their Jaccard similarity is PERCENT
or more. Equal sets form one class and are compared once. Then:

1. Prefix routing. In an order common to all sets, a linking pair shares one of the first
   n - ceil(3n/4) + 1 shingles of each. Only these are shuffled. Shingles that are
   frequent in the corpus (by a count table of fixed size over all documents) come last,
   so that common passages don't bring unrelated documents together.
2. First links. In each shingle's group every set is paired with the least id; the pairs
   that share enough prefix shingles are verified. This joins families of near
   copies without pairing all their members.
3. Signature trees. Groups that still hold several components get trees: a node
   has the OR of its members' prefix bitmaps and their range of sizes. A dual traversal
   drops node pairs whose largest possible overlap is too small or whose sets
   are all in one component. (A group that fits a leaf is paired without a tree.)
   The pairs left are counted over all groups, which gives their exact number of common
   prefix shingles; those that can still link are verified.
4. Families. Large families of near copies share most of their shingles, so that their pairs
   would come from hundreds of groups, each growing with the square of the family. Shingles
   of more than MERGE_ROWS sets are therefore grouped by their least id: a set is in
   such a family once and a pair comes from few places. Trees over tiles of a family
   drop pairs as above and by the parities of whole sets, which leave little more than the links,
   and give the others in batches of bounded size.

Verification counts whole shingle sets. Pairs are dropped only by upper bounds, so all
links between different components are found and the components are exact.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Window, functions as F

from threadglean.llm.components import components
from threadglean.llm.textbytes import LOWER, mix, pieces, shingles
from threadglean.operators.scale import cut_lineage, lookup_join, narrow_to, number_rows

WIDTH = 5
COUNT_BITS = 18
HUB_MEMBERS = 256
MERGE_ROWS = 64
MERGE_PINNED = 200_000
TILE_SETS = 2048
TILE_LEAF = 64
BATCH_PAIRS = 1 << 16
# Shingles up to this place in the order are a fifth of those that are not frequent.
CUT = 2**63 // 5
LEAF_SETS = 8
TOKEN_BYTES = 6


def prefix_length(n):
    return n - -(-3 * n // 4) + (n > 0)


def least_overlap(a, b):
    """Shingles that sets of these sizes must share: 100 i >= 75 (a + b - i)."""
    return -(-3 * (a + b) // 7)


def least_shared(a, b):
    """Prefix shingles that a linking pair shares at least."""
    rest = np.maximum(a - prefix_length(a), b - prefix_length(b))
    return np.maximum(1, least_overlap(a, b) - rest)


def can_link(a, b, rest_a, rest_b, common):
    """Whether sets of sizes a and b with so many common prefix shingles may link.

    rest: shingles beyond CUT, or -1 if the prefix ends before. Works on numpy arrays.
    A prefix shingle is sent as a part of its hash; two of a set that agree by chance
    count once, so one more than counted may be common.
    """
    common = common + 1
    sized = (4 * a >= 3 * b) & (4 * b >= 3 * a) & (common >= least_shared(a, b))
    known = (rest_a >= 0) & (rest_b >= 0)
    return sized & (~known | (common + np.minimum(rest_a, rest_b) >= least_overlap(a, b)))


def text_shingles(texts):
    """(value, owner), sorted and distinct; fewer than WIDTH words make one shingle."""
    start, end, first = texts.words()
    hashes = texts.hashes(start, end, LOWER)
    value, owner = shingles(hashes, first, WIDTH)
    counts = np.diff(first)
    short = np.flatnonzero((counts > 0) & (counts < WIDTH))
    if len(short):
        whole = counts[short].astype(np.uint64)
        for i in range(WIDTH - 1):
            more = counts[short] > i
            at = np.minimum(first[short] + i, len(hashes) - 1)
            whole = np.where(more, whole * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[at], whole)
        value = np.concatenate((value, mix(whole)))
        owner = np.concatenate((owner, short))
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[new], owner[new]


def frequent_places(docs, text_col="text"):
    """Which of 2**COUNT_BITS hash places hold clearly more shingles than the mean.

    Counts cover all documents; the table that reaches the driver has a fixed size.
    """
    def count(batches):
        table = np.zeros(1 << COUNT_BITS, np.int64)
        for batch in batches:
            for texts in pieces(batch.column(0)):
                value, _ = text_shingles(texts)
                table += np.bincount((value >> np.uint64(64 - COUNT_BITS)).astype(np.int64),
                                     minlength=1 << COUNT_BITS)
        if table.any():
            parts = table.reshape(256, -1)
            ends = np.arange(257) * parts.shape[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(256), pa.int32()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(table))],
                names=["part", "counts"])

    def add(table):
        sums = sum(np.asarray(x.values) for x in table["counts"])
        return pa.table([pa.array([table["part"][0].as_py()], pa.int32()), pa.array([sums.tolist()])],
                        names=["part", "counts"])

    rows = (docs.select(text_col).mapInArrow(count, "part int, counts array<long>")
            .groupBy("part").applyInArrow(add, "part int, counts array<long>").collect())
    table = np.zeros((256, (1 << COUNT_BITS) // 256), np.int64)
    for part, counts in rows:
        table[part] = counts
    table = table.ravel()
    mean = float(np.median(table))
    return table > mean + 8 * np.sqrt(mean) + 32


def bitmap(tokens, bits):
    out = np.zeros(bits // 64, np.uint64)
    place = tokens % np.uint64(bits)
    np.bitwise_or.at(out, (place >> np.uint64(6)).astype(np.int64),
                     np.uint64(1) << (place & np.uint64(63)))
    return out


def bitmap_bits(prefix):
    """A power of two, at least four places per prefix shingle."""
    return max(64, 1 << (4 * prefix - 1).bit_length())


def fold(words, bits, by=np.bitwise_or):
    """A longer bitmap as one of `bits` places, by OR of its parts (XOR for parities)."""
    return by.reduce(words.reshape(-1, bits // 64), axis=0)


def parities(key, owner, bits):
    """Bytes of each set's parity bitmap: place p has the number of its keys with key % bits = p, modulo 2.

    `bits` has the places of each set. Two bitmaps differ in at most as many places as
    there are shingles that only one of the sets has.
    """
    ends = np.concatenate(([0], np.cumsum(bits)))
    place = ends[owner] + (key & (bits[owner] - 1).astype(np.uint64)).astype(np.int64)
    odd = (np.bincount(place, minlength=int(ends[-1])) & 1).astype(np.uint8)
    packed = np.packbits(odd, bitorder="little").tobytes()
    ends = (ends // 8).tolist()
    return [packed[a:b] for a, b in zip(ends[:-1], ends[1:])]


def describe(docs, frequent, *, id_col="doc_id", text_col="text"):
    """doc_id, n, d1, d2 (digest of the set), rest, prefix, bits, odd: stored, one row per document.

    bits: bitmap of the prefix; odd: parity bitmap of the whole set, twice as long.
    """
    def run(batches):
        for batch in batches:
            for texts in pieces(batch.column(1)):
                value, owner = text_shingles(texts)
                late = frequent[(value >> np.uint64(64 - COUNT_BITS)).astype(np.int64)]
                key = (value >> np.uint64(1)) | (late.astype(np.uint64) << np.uint64(63))
                order = np.lexsort((key, owner))
                key, owner = key[order], owner[order]
                first = np.searchsorted(owner, np.arange(len(texts) + 1))
                n = np.diff(first)
                digest = []
                for salt in (0x8EBC6AF09C88C6E3, 0x589965CC75374CC3):
                    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(key ^ np.uint64(salt)))))
                    digest.append(pa.array((sums[first[1:]] - sums[first[:-1]]).view(np.int64)))
                prefix = prefix_length(n)
                inside = np.arange(len(key)) - first[owner] < prefix[owner]
                early = np.concatenate(([0], np.cumsum(key <= np.uint64(CUT))))
                early = early[first[1:]] - early[first[:-1]]
                rest = np.where(early < prefix, n - early, -1)
                tokens = key[inside] >> np.uint64(64 - 8 * TOKEN_BYTES)
                ends = np.concatenate(([0], np.cumsum(prefix)))
                raw = tokens.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - TOKEN_BYTES:].tobytes()
                maps = [bitmap(tokens[a:b], bitmap_bits(int(b - a))).tobytes() if b > a else b""
                        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                odd = parities(key, owner, np.array([16 * len(x) for x in maps], np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[texts.rows], pa.array(n, pa.int64()), *digest, pa.array(rest, pa.int64()),
                     pa.array([raw[TOKEN_BYTES * a:TOKEN_BYTES * b] for a, b in
                               zip(ends[:-1].tolist(), ends[1:].tolist())], pa.binary()),
                     pa.array(maps, pa.binary()), pa.array(odd, pa.binary())],
                    names=["doc_id", "n", "d1", "d2", "rest", "prefix", "bits", "odd"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return cut_lineage(slim.mapInArrow(
        run, "doc_id long, n long, d1 long, d2 long, rest long, prefix binary, bits binary, odd binary"))


def _tokens(batches):
    """token, id, n: the prefix of each set, a row per shingle."""
    for batch in batches:
        raw = batch.column(2)
        sizes = np.array([len(x.as_buffer()) // TOKEN_BYTES if x.is_valid else 0 for x in raw], np.int64)
        flat = np.frombuffer(b"".join(raw.to_pylist()), np.uint8).reshape(-1, TOKEN_BYTES)
        token = np.zeros(len(flat), np.int64)
        for i in range(TOKEN_BYTES):
            token = token << 8 | flat[:, i]
        rows = np.repeat(np.arange(batch.num_rows), sizes)
        for at in range(0, len(rows), 1 << 18):
            part = pa.array(rows[at:at + (1 << 18)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(token[at:at + (1 << 18)]), batch.column(0).take(part), batch.column(1).take(part)],
                names=["token", "id", "n"])


def _shared(batches):
    """Distinct rows of tokens that two sets or more have, with the group's least id.

    Input is sorted by (token, id, n); only the last row of a batch is held.
    """
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        token, ids, n = (np.asarray(batch.column(i)) for i in range(3))
        opened = None if held is None else held[3]
        if held is not None:
            token, ids, n = (np.concatenate(([h], x)) for h, x in zip(held[:3], (token, ids, n)))
        new = np.ones(len(token), bool)
        new[1:] = token[1:] != token[:-1]
        again = np.zeros(len(token), bool)
        again[1:] = ~new[1:] & (ids[1:] == ids[:-1]) & (n[1:] == n[:-1])
        token, ids, n, new = token[~again], ids[~again], n[~again], new[~again]
        head = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        hub, hub_n = ids[head][group], n[head][group]
        if opened is not None and token[0] == opened[0]:
            # The first group began in an earlier batch; its first row is out already or waits.
            hub[group == 0], hub_n[group == 0] = opened[1], opened[2]
        size = np.bincount(group)
        out = size[group] > 1
        if held is not None and held[4]:
            out[0] = False          # given with the batch before
            out[1:] |= (group == 0)[1:]
        # The last row waits: its group may go on.
        last_given = bool(out[-1]) or (len(token) == 1 and held is not None and held[4])
        opened = (token[-1], hub[-1], hub_n[-1])
        held = (token[-1], ids[-1], n[-1], opened, last_given)
        if out.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[out]) for x in (token, ids, n, hub, hub_n)],
                names=["token", "id", "n", "hub", "hub_n"])


class SignatureTree:
    """Sets sorted by component and size; a node is a stretch of them.

    Node numbers follow a heap: children 2i + 1 and 2i + 2. `bits` is a matrix of
    equally long bitmaps, `odd` one of equally long parities or None.
    """

    def __init__(self, sizes, parts, bits, odd=None, leaf=LEAF_SETS):
        self.sizes, self.parts, self.bits, self.odd, self.leaf = sizes, parts, bits, odd, leaf
        prefix = prefix_length(sizes)
        self.extra = prefix - np.bitwise_count(bits).sum(1).astype(np.int64)
        self.nodes = {}
        self._build(0, 0, len(sizes))

    def _build(self, node, lo, hi):
        if hi - lo <= self.leaf:
            both = np.bitwise_or.reduce(self.bits[lo:hi], axis=0)
        else:
            mid = (lo + hi) // 2
            both = self._build(2 * node + 1, lo, mid) | self._build(2 * node + 2, mid, hi)
        n, part = self.sizes[lo:hi], self.parts[lo:hi]
        self.nodes[node] = (lo, hi, both, int(n.min()), int(n.max()), int(self.extra[lo:hi].max()),
                            part[0] if part[0] == part[-1] else None)
        return both

    def is_leaf(self, node):
        return 2 * node + 1 not in self.nodes


def _may_link(a, b):
    """Whether sets of two nodes could link, by sizes, components and bitmaps."""
    _, _, bits_a, low_a, high_a, extra_a, part_a = a
    _, _, bits_b, low_b, high_b, extra_b, part_b = b
    if part_a is not None and part_a == part_b:
        return False
    if 4 * high_a < 3 * low_b or 4 * high_b < 3 * low_a:
        return False
    rest = max(high_a - prefix_length(high_a), high_b - prefix_length(high_b))
    need = max(1, least_overlap(low_a, low_b) - rest)
    most = int(np.bitwise_count(bits_a & bits_b).sum()) + min(extra_a, extra_b)
    return most >= need


def tree_pairs(left, right):
    """Positions (i, j) of pairs that may link, from the dual traversal of two trees, leaf by leaf.

    The same tree twice gives each pair once.
    """
    todo = [(0, 0)]
    same = left is right
    while todo:
        a, b = todo.pop()
        one, two = left.nodes[a], right.nodes[b]
        if not _may_link(one, two):
            continue
        if left.is_leaf(a) and right.is_leaf(b):
            i = np.repeat(np.arange(one[0], one[1]), two[1] - two[0])
            j = np.tile(np.arange(two[0], two[1]), one[1] - one[0])
            m, n = left.sizes[i], right.sizes[j]
            keep = (left.parts[i] != right.parts[j]) & (4 * m >= 3 * n) & (4 * n >= 3 * m)
            if same and a == b:
                keep &= i < j
            i, j, m, n = i[keep], j[keep], m[keep], n[keep]
            both = np.bitwise_count(left.bits[i] & right.bits[j]).sum(1).astype(np.int64)
            most = both + np.minimum(left.extra[i], right.extra[j])
            keep = most >= least_shared(m, n)
            i, j, m, n = i[keep], j[keep], m[keep], n[keep]
            if left.odd is not None:
                apart = np.bitwise_count(left.odd[i] ^ right.odd[j]).sum(1).astype(np.int64)
                # The shingles that only one of them has are m + n less twice the common ones.
                keep = m + n - apart >= 2 * least_overlap(m, n)
                i, j = i[keep], j[keep]
            if len(i):
                yield i, j
        elif same and a == b:
            todo += [(2 * a + 1, 2 * a + 1), (2 * a + 1, 2 * a + 2), (2 * a + 2, 2 * a + 2)]
        elif right.is_leaf(b) or (not left.is_leaf(a) and one[1] - one[0] >= two[1] - two[0]):
            todo += [(2 * a + 1, b), (2 * a + 2, b)]
        else:
            todo += [(a, 2 * b + 1), (a, 2 * b + 2)]


def group_pairs(sizes, parts, bits, left, right, odd=None, leaf=LEAF_SETS):
    """Positions (i, j) of pairs of rows `left` and `right` that may link, in parts of at
    most leaf * leaf pairs.

    One tree per length of bitmaps: sets that may link have lengths that are equal
    or one doubling apart, and the longer ones are folded for that.
    """
    def trees(rows):
        out = {}
        lengths = np.array([len(bits[i]) for i in rows], np.int64)
        for length in np.unique(lengths).tolist():
            own = rows[lengths == length]
            own = own[np.lexsort((sizes[own], parts[own]))]
            words = np.array([np.frombuffer(bits[i], np.uint64) for i in own])
            marks = None if odd is None else np.array([np.frombuffer(odd[i], np.uint64) for i in own])
            out[length] = own, SignatureTree(sizes[own], parts[own], words, marks, leaf)
        return out

    one = trees(left)
    two = one if left is right else trees(right)

    def cross(a, b):
        (rows_a, tree), (rows_b, other) = a, b
        length = 64 * tree.bits.shape[1]
        marks = None if odd is None else np.array([fold(w, 2 * length, np.bitwise_xor) for w in other.odd])
        folded = SignatureTree(other.sizes, other.parts, np.array([fold(w, length) for w in other.bits]), marks, leaf)
        for i, j in tree_pairs(tree, folded):
            yield rows_a[i], rows_b[j]

    for length, (rows_a, tree) in one.items():
        if length in two:
            rows_b, other = two[length]
            for i, j in tree_pairs(tree, other):
                yield rows_a[i], rows_b[j]
        if 2 * length in two:
            yield from cross(one[length], two[2 * length])
        if one is not two and 2 * length in one and length in two:
            yield from cross(two[length], one[2 * length])


PAIR = "a long, b long, n_a long, n_b long, rest_a long, rest_b long, common long"


def _counted(ids, sizes, rest, i, j):
    """A batch of the pairs (i, j), each once with its number, the lesser id first."""
    swap = ids[i] > ids[j]
    i, j = np.where(swap, j, i), np.where(swap, i, j)
    pairs = np.stack((ids[i], ids[j], sizes[i], sizes[j], rest[i], rest[j]))
    order = np.lexsort(pairs)
    pairs = pairs[:, order]
    new = np.ones(len(order), bool)
    new[1:] = (pairs[:, 1:] != pairs[:, :-1]).any(0)
    count = np.diff(np.append(np.flatnonzero(new), len(order)))
    return pa.RecordBatch.from_arrays(
        [*[pa.array(row) for row in pairs[:, new]], pa.array(count)],
        names=["a", "b", "n_a", "n_b", "rest_a", "rest_b", "common"])


def _leaf_pairs(batches):
    """Pairs within groups that fit a leaf; rows are sorted by token."""
    kept = None
    for batch in batches:
        now = [np.asarray(batch.column(c)) for c in range(5)]
        if kept is not None:
            now = [np.concatenate(x) for x in zip(kept, now)]
        token, ids, sizes, rest, parts = now
        kept = [x[max(0, len(token) - LEAF_SETS):] for x in now]
        fresh = len(token) - batch.num_rows
        found = []
        for gap in range(1, LEAF_SETS):
            i = np.arange(max(0, fresh - gap), len(token) - gap)
            j = i + gap
            keep = ((token[i] == token[j]) & (parts[i] != parts[j]) & (ids[i] != ids[j])
                    & (4 * sizes[i] >= 3 * sizes[j]) & (4 * sizes[j] >= 3 * sizes[i]))
            found.append((i[keep], j[keep]))
        i, j = (np.concatenate(x) for x in zip(*found))
        if len(i):
            yield _counted(ids, sizes, rest, i, j)


def _tree_pairs(table):
    """Pairs of a token's group, by signature trees."""
    ids, sizes, rest, parts = (np.asarray(table[c]) for c in ("id", "n", "rest", "part"))
    rows = np.arange(len(ids))
    found = list(group_pairs(sizes, parts, table["bits"].to_pylist(), rows, rows))
    i, j = (np.concatenate(x) for x in zip(*found)) if found else (rows[:0], rows[:0])
    keep = ids[i] != ids[j]
    return pa.Table.from_batches([_counted(ids, sizes, rest, i[keep], j[keep])])


def _family_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """a, b of the pairs of a family's tile, or of two of them, that may link, by signature trees."""
    table = pa.Table.from_batches(list(batches))
    ids, sizes, parts, tile = (np.asarray(table[c]) for c in ("id", "n", "part", "tile"))
    low, high = table["low"][0].as_py(), table["high"][0].as_py()
    left = np.flatnonzero(tile == low)
    right = left if low == high else np.flatnonzero(tile == high)
    held, n = [], 0

    def batch():
        a, b = (np.concatenate(x) for x in zip(*held))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    for i, j in group_pairs(sizes, parts, table["bits"].to_pylist(), left, right,
                            table["odd"].to_pylist(), TILE_LEAF):
        keep = ids[i] != ids[j]
        held.append((ids[i[keep]], ids[j[keep]]))
        n += len(held[-1][0])
        if n >= BATCH_PAIRS:
            yield batch()
            held, n = [], 0
    if n:
        yield batch()


def _linkable(batches):
    """a, b of the pairs whose counts let them link."""
    for batch in batches:
        a, b, rest_a, rest_b, common = (np.asarray(batch.column(c)) for c in range(2, 7))
        yield batch.select([0, 1]).filter(pa.array(can_link(a, b, rest_a, rest_b, common)))


def _compare(table):
    """a, b of the members whose set links with the hub's."""
    column = table["text"].combine_chunks()
    sets, hub = {}, []
    is_hub, ids = table["is_hub"].to_pylist(), table["id"].to_pylist()
    for texts in pieces(column):
        value, owner = text_shingles(texts)
        first = np.searchsorted(owner, np.arange(len(texts) + 1))
        for i in range(len(texts)):
            row = texts.rows.start + i
            found = value[first[i]:first[i + 1]].copy()
            if is_hub[row]:
                hub.append(found)
            else:
                sets.setdefault(ids[row], []).append(found)
    linked = []
    for other, members in sets.items():
        for member in members:
            for one in hub:
                common = len(np.intersect1d(one, member, assume_unique=True))
                if len(one) and 100 * common >= 75 * (len(one) + len(member) - common):
                    linked.append(other)
                    break
            else:
                continue
            break
    a = table["a"][0].as_py()
    return pa.table([pa.array([a] * len(linked), pa.int64()), pa.array(linked, pa.int64())], names=["u", "v"])


def verify(pairs, texts):
    """u, v: the pairs (a, b) of ids whose whole shingle sets link.

    `texts` has doc_id and text. Partners of an id are dealt over groups of about
    HUB_MEMBERS, so an id may have any number of them.
    """
    pairs = cut_lineage(pairs.distinct())
    counted = pairs.groupBy("a").count()
    dealt = pairs.join(counted, "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("count") / HUB_MEMBERS)).alias("salt"))
    members = dealt.select("a", "salt", F.col("b").alias("id"), F.lit(False).alias("is_hub")).unionByName(
        dealt.select("a", "salt").distinct().select("a", "salt", F.col("a").alias("id"), F.lit(True).alias("is_hub")))
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))
    few = narrow_to(texts, ids, "doc_id")
    return cut_lineage(
        members.join(few.withColumnRenamed("doc_id", "id"), "id")
        .groupBy("a", "salt").applyInArrow(_compare, "u long, v long"))


def _bitmaps_of(sets, ids, columns):
    """Distinct id and `columns` of the sets whose id is in `ids`."""
    few = narrow_to(sets.where("n > 0").select(F.col("doc_id").alias("id"), *columns), ids, "id")
    return few.join(ids, "id", "left_semi").distinct()


def families(shared):
    """(shingles, as `token`, that more than MERGE_ROWS sets have; their rows by family), or None twice.

    The shingles of one least id make one family, unless comparing its sets would
    cost more than comparing those of each shingle.
    """
    hot = cut_lineage(shared.groupBy("token").agg(F.count("*").alias("rows"), F.min("id").alias("hub")).where(
        F.col("rows") > MERGE_ROWS))
    if hot.isEmpty():
        return None, None
    large = lookup_join(shared.select("token", "id", "n"), hot, ["token"], "inner", "id", max_rows=MERGE_PINNED)
    each = hot.groupBy("hub").agg(F.sum(F.col("rows").cast("double") * F.col("rows")).alias("each"))
    merged = cut_lineage(large.select("hub", "id", "n").distinct().groupBy("hub").agg(F.count("*").alias("sets")).join(
        each, "hub").where(F.col("sets").cast("double") * F.col("sets") <= F.col("each")).select("hub", "sets"))
    members = cut_lineage(lookup_join(large, merged, ["hub"], "left", "id", max_rows=MERGE_PINNED).select(
        "hub", F.when(F.col("sets").isNull(), F.col("token")).otherwise(-1).alias("token"), "id", "n",
        F.coalesce("sets", "rows").alias("rows")).distinct())
    return hot, members


def families_paired(members, part, sets):
    """a, b of the pairs of the families that may link and are not in one component of `part`."""
    family = ["hub", "token"]
    placed = cut_lineage(members.join(part, "id", "left").withColumn(
        "part", F.coalesce("component", "id")).drop("component"))
    split = placed.groupBy(*family).agg(
        F.min("part").alias("least"), F.max("part").alias("most")).where("least < most").select(*family)
    placed = lookup_join(placed, cut_lineage(split), family, "inner", "id", max_rows=MERGE_PINNED)
    known = _bitmaps_of(sets, members.select("id").distinct(), ["n", "bits", "odd"])
    tiles = F.ceil(F.col("rows") / TILE_SETS).cast("int")
    dealt = (
        placed.withColumn("tile", F.pmod(F.xxhash64("id"), tiles).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
        .withColumns({"low": F.least("tile", "other"), "high": F.greatest("tile", "other")}))
    return dealt.join(known, ["id", "n"]).select(
        *family, "low", "high", "tile", "id", "n", "part", "bits", "odd").groupBy(
        *family, "low", "high").applyInArrow(_family_pairs, "a long, b long")


def join(docs, *, id_col="doc_id", text_col="text"):
    """doc_id, n_shingles, component_id of every row.

    The links inside a component are not part of the result: pairs that other links
    tie already are not verified. Null and empty texts, and texts without words, have no shingle and link with
    nothing. Rows that repeat a doc_id are one node, linked by any of
    their texts; rows with a null id link with nothing and have a null component.
    Other columns are not read. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    frequent = frequent_places(texts)
    sets = describe(texts, frequent)
    digest = ["n", "d1", "d2"]
    classes = cut_lineage(sets.where("n > 0 and doc_id is not null").groupBy(*digest).agg(
        F.min("doc_id").alias("id")))
    alone = sets.join(classes.withColumnRenamed("id", "doc_id"), ["doc_id", *digest], "left_semi")
    shared = cut_lineage(
        alone.select("doc_id", "n", "prefix").mapInArrow(_tokens, "token long, id long, n long")
        .repartition(partitions, "token").sortWithinPartitions("token", "id", "n")
        .mapInArrow(_shared, "token long, id long, n long, hub long, hub_n long"))

    small, large = F.least("n", "hub_n"), F.greatest("n", "hub_n")
    # What a set has beyond its prefix: ceil(3n/4) - 1; the larger set has more.
    beyond = F.ceil(3 * large / 4) - 1
    enough = F.col("common") >= F.greatest(F.lit(1), F.ceil(3 * (small + large) / 7) - beyond)
    first = (
        shared.where(F.col("id") != F.col("hub")).groupBy("hub", "id", "n", "hub_n")
        .agg(F.count("*").alias("common")).where((4 * small >= 3 * large) & enough)
        .select(F.col("hub").alias("a"), F.col("id").alias("b")))
    # An id with several sets ties their classes together.
    own = sets.where("n > 0 and doc_id is not null").select("doc_id", *digest).distinct()
    several = own.groupBy("doc_id").count().where("count > 1").select("doc_id")
    ties = own.join(several, "doc_id").join(classes, digest).select(
        F.col("doc_id").alias("u"), F.col("id").alias("v"))
    links = verify(first, texts).unionByName(ties)
    part = cut_lineage(components(links))
    hot, members = families(shared)
    # Groups with several components: small ones are paired at once, others by trees.
    info = alone.select(F.col("doc_id").alias("id"), "n", "rest").distinct().join(part, "id", "left").select(
        "id", "n", "rest", F.coalesce("component", "id").alias("part"))
    placed = shared.select("token", "id", "n")
    if hot is not None:
        placed = lookup_join(placed, hot.select("token"), ["token"], "left_anti", "id", max_rows=MERGE_PINNED)
    placed = placed.join(info, ["id", "n"])
    split = placed.groupBy("token").agg(
        F.min("part").alias("least"), F.max("part").alias("most"), F.count("*").alias("rows")
    ).where("least < most").select("token", "rows")
    rows = cut_lineage(placed.join(split, "token"))
    leaves = (
        rows.where(F.col("rows") <= LEAF_SETS).select("token", "id", "n", "rest", "part")
        .repartition(partitions, "token").sortWithinPartitions("token").mapInArrow(_leaf_pairs, PAIR))
    large = rows.where(F.col("rows") > LEAF_SETS)
    trees = (
        large.join(_bitmaps_of(sets, large.select("id").distinct(), ["n", "rest", "bits"]), ["id", "n", "rest"])
        .select("token", "id", "n", "rest", "part", "bits").groupBy("token").applyInArrow(_tree_pairs, PAIR))
    pair = ["a", "b", "n_a", "n_b", "rest_a", "rest_b"]
    counted = leaves.unionByName(trees).groupBy(*pair).agg(F.sum("common").alias("common"))
    second = counted.mapInArrow(_linkable, "a long, b long")
    if hot is not None:
        second = second.unionByName(families_paired(members, part, sets))
    links = links.unionByName(verify(second, texts))
    whole = cut_lineage(classes.join(components(links).withColumnRenamed("id", "node"),
                                     F.col("id") == F.col("node"), "left").select(
        *digest, F.coalesce("component", "id").alias("component_id")))
    return sets.select("doc_id", *digest).join(whole, digest, "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def _own_nodes(docs, id_col, text_col):
    """(docs with a `__node` for each text of an id, nodes that are not ids or None).

    An id's first text has the id as its node, its other texts have numbers that no id has.
    """
    docs = docs.withColumns({"__id": F.col(id_col).cast("long"), "__hash": F.xxhash64(text_col)})
    pairs = docs.where("__id is not null").select("__id", "__hash").distinct()
    several = cut_lineage(pairs.groupBy("__id").agg(
        F.count("*").alias("__texts"), F.min("__hash").alias("__first")).where("__texts > 1"))
    if several.isEmpty():
        return docs.withColumn("__node", F.col("__id")), None
    others = lookup_join(pairs, several, ["__id"], "inner", "__hash").where("__hash <> __first")
    others = number_rows(others.select("__id", "__hash"), ["__id", "__hash"], "__no")
    least, most, n = docs.agg(F.min("__id"), F.max("__id"), F.lit(several.agg(F.sum("__texts")).first()[0])).first()
    if most + n < 2**63:
        node = F.lit(most) + F.col("__no")
    elif least - n >= -2**63:
        node = F.lit(least) - F.col("__no")
    else:
        raise ValueError("ids leave no room for further nodes")
    others = cut_lineage(others.select("__id", "__hash", node.alias("__other")))
    marked = lookup_join(docs, others, ["__id", "__hash"], "left", text_col)
    marked = marked.withColumn("__node", F.coalesce("__other", "__id")).drop("__other")
    return cut_lineage(marked), others


def keep_one(docs, *, id_col="doc_id", text_col="text", tied=True):
    """The rows of `docs`, all columns as they are, of the least id of each component.

    With `tied`, rows that repeat an id are one node as in join(); without, each text of
    an id is a node of its own, so an id does not tie unlike texts together. Of rows
    that agree in id and text one stays. Rows with a null id all stay. An empty table stays empty.
    """
    columns = docs.columns
    if tied:
        marked = docs.withColumns({"__id": F.col(id_col).cast("long"), "__hash": F.xxhash64(text_col)})
        marked, others = marked.withColumn("__node", F.col("__id")), None
    else:
        marked, others = _own_nodes(docs, id_col, text_col)
    parts = join(marked, id_col="__node", text_col=text_col).where("component_id is not null")
    if others is None:
        gone = parts.where(F.col("component_id") != F.col("doc_id"))
    else:
        parts = cut_lineage(lookup_join(
            parts.select("doc_id", "component_id").distinct(),
            others.select(F.col("__other").alias("doc_id"), "__id"), ["doc_id"], "left", "component_id")
            .withColumn("__id", F.coalesce("__id", "doc_id")))
        least = parts.groupBy("component_id").agg(F.min("__id").alias("__least"))
        gone = lookup_join(parts, least, ["component_id"], "inner", "doc_id").where("__id <> __least")
    gone = gone.select(F.col("doc_id").alias("__gone")).distinct()
    named = marked.where(F.col("__id").isNotNull()).join(
        cut_lineage(gone), F.col("__node") == F.col("__gone"), "left_anti")
    window = Window.partitionBy("__id", "__hash").orderBy(F.lit(0))
    named = named.withColumn("__copy", F.row_number().over(window)).where(F.col("__copy") == 1)
    return named.select(*columns).unionByName(docs.where(F.col(id_col).isNull()))
