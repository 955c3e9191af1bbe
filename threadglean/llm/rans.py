"""Token ids as entropy-coded files (8): static range asymmetric numeral system.

A unit of the file holds whole documents in ascending doc_id order: one table
of symbol frequencies shared by its blocks, and the blocks. A block is coded by
LANES interleaved states, token i by lane i modulo LANES, so a step codes or decodes
one token of every lane at once. A unit's checkpoints give each block's first token,
number of tokens and place of its states and words, with a checksum, so blocks
can be decoded apart and in any order. Units are rows of Parquet files, which Spark writes,
commits and reads; after the loss of an executor its units are written again.

Layout of a unit, little-endian: MAGIC, header (documents, tokens, symbols, precision,
blocks), symbols and frequencies and documents' lengths (deflated, each with its
size), checkpoints, blocks.
"""

import os
import struct
import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Window, functions as F

from threadglean.llm.textbytes import WordCodes, pieces, pretokens
from threadglean.operators.scale import cut_lineage

MAGIC = b"TGRANS1\n"
LANES = 1024
BLOCK_TOKENS = 1 << 18
UNIT_TOKENS = 1 << 21
PRECISION = 18
_HEADER = struct.Struct("<qqqqq")
_POINT = struct.Struct("<qqqqII")  # first token, tokens, states at, words, steps' crc, payload crc
_LOW = np.uint64(1 << 32)
_SHIFT = np.uint64(32)


def frequency_table(counts, precision=PRECISION):
    """(symbols, frequencies): positive shares of 2**precision for the symbols that occur."""
    symbols = np.flatnonzero(counts)
    while len(symbols) > 1 << (precision - 2):
        precision += 1
    total, goal = int(counts.sum()), 1 << precision
    share = np.maximum(1, (counts[symbols].astype(np.float64) * goal / total).astype(np.int64))
    over = int(share.sum()) - goal
    while over > 0:
        # Raising rare symbols to 1 took too much: shrink what is above 1 in proportion.
        spare = share - 1
        cut = np.minimum(spare, -(-spare * over // int(spare.sum())))
        late = np.cumsum(cut) - cut >= over
        cut[late] = 0
        cut[np.cumsum(cut) > over] -= (np.cumsum(cut) - over)[np.cumsum(cut) > over]
        share -= cut
        over = int(share.sum()) - goal
    share[np.argmax(share)] -= over
    return symbols, share, precision


def encode_block(index, freq, cum, precision):
    """(states, words) of a block of symbol indexes."""
    n = len(index)
    steps = -(-n // LANES)
    state = np.full(LANES, _LOW, np.uint64)
    bits, rest = np.uint64(precision), np.uint64(64 - precision)
    whole = freq >= np.uint64(1 << precision)
    limit = np.where(whole, np.uint64(2**64 - 1), freq << (rest * ~whole))
    out = []
    for step in range(steps - 1, -1, -1):
        at = index[step * LANES:(step + 1) * LANES]
        x = state[:len(at)]
        f = freq[at]
        full = np.flatnonzero(x >= limit[at])
        if len(full):
            out.append((x[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
            x[full] >>= _SHIFT
        q = x // f
        state[:len(at)] = (q << bits) + (x - q * f) + cum[at]
    out.reverse()
    return state.astype("<u8"), np.concatenate(out) if out else np.zeros(0, "<u4")


def decode_block(states, words, n, slots, freq, cum, precision):
    """Symbol indexes of a block."""
    out = np.empty(n, np.int32)
    state = states.astype(np.uint64)
    bits, mask = np.uint64(precision), np.uint64((1 << precision) - 1)
    words = words.astype(np.uint64)
    at = 0
    for lo in range(0, n, LANES):
        hi = min(n, lo + LANES)
        x = state[:hi - lo]
        slot = x & mask
        symbol = slots[slot]
        out[lo:hi] = symbol
        x = freq[symbol] * (x >> bits) + slot - cum[symbol]
        low = np.flatnonzero(x < _LOW)
        if len(low):
            x[low] = (x[low] << _SHIFT) | words[at:at + len(low)]
            at += len(low)
        state[:hi - lo] = x
    if at != len(words) or (state != _LOW).any():
        raise ValueError("the block doesn't end in its first state")
    return out


def _packed(array):
    raw = zlib.compress(np.ascontiguousarray(array, "<i4").tobytes(), 1)
    return struct.pack("<q", len(raw)) + raw


def encode_unit(ids, lengths):
    """The bytes of a unit: `ids` of all its documents, `lengths` of each."""
    ids = np.asarray(ids, np.int64)
    parts, points, at = [], [], 0
    symbols = share = np.zeros(0, np.int64)
    precision = PRECISION
    if len(ids):
        symbols, share, precision = frequency_table(np.bincount(ids))
        place = np.zeros(int(symbols[-1]) + 1, np.int32)
        place[symbols] = np.arange(len(symbols))
        freq = share.astype(np.uint64)
        cum = np.cumsum(freq) - freq
        for first in range(0, len(ids), BLOCK_TOKENS):
            index = place[ids[first:first + BLOCK_TOKENS]]
            states, words = encode_block(index, freq, cum, precision)
            payload = states.tobytes() + words.tobytes()
            points.append(_POINT.pack(first, len(index), at, len(words),
                                      zlib.crc32(states.tobytes()), zlib.crc32(payload)))
            parts.append(payload)
            at += len(payload)
    head = _HEADER.pack(len(lengths), len(ids), len(symbols), precision, len(points))
    return b"".join([MAGIC, head, _packed(symbols), _packed(share), _packed(lengths),
                     *points, *parts])


class Unit:
    """A unit's table and checkpoints; blocks are decoded on demand."""

    def __init__(self, raw):
        if raw[:len(MAGIC)] != MAGIC:
            raise ValueError("not a unit of token ids")
        self.raw, at = raw, len(MAGIC) + _HEADER.size
        docs, self.tokens, n, self.precision, blocks = _HEADER.unpack_from(raw, len(MAGIC))
        arrays = []
        for _ in range(3):
            size, = struct.unpack_from("<q", raw, at)
            arrays.append(np.frombuffer(zlib.decompress(raw[at + 8:at + 8 + size]), "<i4"))
            at += 8 + size
        self.symbols, share, self.lengths = arrays
        if len(self.symbols) != n or len(self.lengths) != docs:
            raise ValueError("damaged header")
        self.freq = share.astype(np.uint64)
        self.cum = np.cumsum(self.freq) - self.freq
        self.slots = np.repeat(np.arange(n, dtype=np.int32), share)
        self.points = [_POINT.unpack_from(raw, at + i * _POINT.size) for i in range(blocks)]
        self.base = at + blocks * _POINT.size

    def block(self, i):
        """(first token, ids) of block i, whose checksum must hold."""
        first, n, at, words, _, crc = self.points[i]
        payload = self.raw[self.base + at:self.base + at + 8 * LANES + 4 * words]
        if zlib.crc32(payload) != crc:
            raise ValueError(f"checksum of block {i} doesn't hold")
        index = decode_block(np.frombuffer(payload, "<u8", LANES),
                             np.frombuffer(payload, "<u4", words, 8 * LANES), n,
                             self.slots, self.freq, self.cum, self.precision)
        return first, self.symbols[index]

    def ids(self):
        out = [self.block(i)[1] for i in range(len(self.points))]
        return np.concatenate(out) if out else np.zeros(0, "<i4")


_tokenizers = {}


def _tokenizer(path, pattern):
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        special = [t.content for t in model.get_added_tokens_decoder().values()]

        def encode(words):
            found = model.encode_batch_fast([w.decode("utf-8") for w in words], add_special_tokens=False)
            return [e.ids for e in found]

        _tokenizers[path] = (model, special, WordCodes(encode), regex.compile(pattern))
    return _tokenizers[path]


def token_ids(texts, path, pattern):
    """(ids, counts) of a piece's texts, as the tokenizers library gives them."""
    model, special, codes, compiled = _tokenizer(path, pattern)
    start, first = pretokens(texts, compiled)
    ids, counts = codes.expand(texts, start, first)
    raw = texts.data.tobytes()
    if any(s.encode() in raw for s in special):
        # A special string may cross pre-tokens: the library takes such texts whole.
        parts = np.split(ids, np.cumsum(counts)[:-1])
        for i in range(len(texts)):
            text = raw[texts.offsets[i]:texts.offsets[i + 1]].decode("utf-8")
            if any(s in text for s in special):
                parts[i] = np.array(model.encode(text, add_special_tokens=False).ids, np.int32)
        ids, counts = np.concatenate(parts), np.array([len(p) for p in parts])
    return ids, counts


def write_units(docs, tokenizer_file, pattern, *, end_id=2, id_col="doc_id", text_col="text",
                partitions=None, unit_tokens=UNIT_TOKENS):
    """Write the ids of all texts as units; the frame that reads the files back.

    Columns: part, unit (ascending with doc_id), n_tokens, doc_ids, payload. Null and
    empty texts have the end id alone. Null doc_ids come first; rows that share a
    doc_id stand together in the order of a hash of their text. Other
    columns are not read. A unit is closed at the end of the piece of texts
    (2 MB, or one longer text) that brings it to `unit_tokens` ids, which bounds memory. An empty table has no units.
    """
    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        part, unit = TaskContext.get().partitionId(), 0
        ids, lengths, names, held = [], [], [], 0

        def close():
            raw = encode_unit(np.concatenate(ids), np.concatenate(lengths))
            keys = pa.concat_arrays(names)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([unit], pa.int32()),
                 pa.array([held], pa.int64()),
                 pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
                 pa.array([raw], pa.binary())],
                names=["part", "unit", "n_tokens", "doc_ids", "payload"])

        for batch in batches:
            for texts in pieces(batch.column(1)):
                found, counts = token_ids(texts, tokenizer_file, pattern)
                stops = np.cumsum(counts)
                ids.append(np.insert(found, stops, end_id))
                lengths.append(counts + 1)
                names.append(batch.column(0)[texts.rows])
                held += len(ids[-1])
                if held >= unit_tokens:
                    yield close()
                    unit += 1
                    ids, lengths, names, held = [], [], [], 0
        if names:
            yield close()

    ordered = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        .repartitionByRange(partitions, "doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
    )
    return cut_lineage(ordered.mapInArrow(
        run, "part int, unit int, n_tokens long, doc_ids array<long>, payload binary"))


def read_units(units):
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the files."""

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                part, unit, keys = (batch.column(i)[row] for i in (0, 1, 2))
                parsed = Unit(batch.column(3)[row].as_py())
                ids = np.ascontiguousarray(parsed.ids(), "<u4")
                ends = np.concatenate(([0], np.cumsum(parsed.lengths, dtype=np.int64)))
                if ends[-1] != len(ids):
                    raise ValueError("documents and ids of a unit differ in number")
                raw, cut = memoryview(ids).cast("B"), (4 * ends).tolist()
                n = len(parsed.lengths)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.as_py()] * n, pa.int32()), pa.array([unit.as_py()] * n, pa.int32()),
                     keys.values, pa.array(ends[:-1]), pa.array(parsed.lengths.astype(np.int64)),
                     pa.array([zlib.crc32(raw[a:b]) for a, b in zip(cut, cut[1:])], pa.int64())],
                    names=["part", "unit", "doc_id", "inner", "n_tokens", "ids_crc32"])

    # Ids before a unit: those of earlier units of its part and of earlier parts.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("unit").rowsBetween(Window.unboundedPreceding, -1)
    sizes = units.select("part", "unit", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("all")).select(
        "part", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("before"))
    places = sizes.withColumn("within", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(
        parts, "part").select("part", "unit", (F.col("before") + F.col("within")).alias("base"))
    decoded = units.select("part", "unit", "doc_ids", "payload").mapInArrow(
        run, "part int, unit int, doc_id long, inner long, n_tokens long, ids_crc32 long")
    return decoded.join(places, ["part", "unit"]).select(
        "doc_id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")
