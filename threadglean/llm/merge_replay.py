"""Byte-level BPE (9) by replaying merges over a corpus of distinct words.

The distinct pre-tokens of a piece of text are laid out as one row of symbols.
An inverted index holds, for each rank, the places whose pair merges at that
rank; ranks are replayed in order over all words at once, and a merge updates
only the two neighbours of the place. If a merge makes a pair of a lower rank,
that rank is replayed before the rest, as when each word is merged alone.
"""

import base64
import hashlib
import heapq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import functions as F

from threadglean.llm.textbytes import WordCodes, pieces, pretokens


# Words of one replay, and words whose ids a worker keeps: both bound its memory.
REPLAY_WORDS = 20_000
KEPT_WORDS = 400_000


def read_ranks(path):
    """token bytes -> rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class MergeReplay:
    def __init__(self, ranks):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.byte = [ranks[bytes([b])] for b in range(256)]
        # Every pair of tokens whose bytes together are a token, with its rank.
        self.pair = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.pair[left << 20 | right] = rank

    def encode(self, words):
        """Ids of each word, merged by rank order over all words."""
        whole = self.ranks.get
        out = [None] * len(words)
        rest = []
        for i, word in enumerate(words):
            rank = whole(word)
            if rank is not None:
                out[i] = (rank,)
            else:
                rest.append(i)
        for at in range(0, len(rest), REPLAY_WORDS):
            part = rest[at:at + REPLAY_WORDS]
            for i, ids in zip(part, self._replay([words[i] for i in part])):
                out[i] = ids
        return out

    def _replay(self, words):
        # One symbol per byte, with a gap (-1) after each word.
        byte = self.byte
        sym = []
        for word in words:
            sym.extend(map(byte.__getitem__, word))
            sym.append(-1)
        n = len(sym)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        rank_of = self.pair.get
        index = {}
        for at, (left, right) in enumerate(zip(sym, sym[1:])):
            if left >= 0 and right >= 0:
                rank = rank_of(left << 20 | right)
                if rank is not None:
                    index.setdefault(rank, []).append(at)
        heap = list(index)
        heapq.heapify(heap)
        while heap:
            rank = heapq.heappop(heap)
            places = index.pop(rank, None)
            if not places:
                continue
            places.sort()
            for done, at in enumerate(places):
                left = sym[at]
                if left < 0:
                    continue
                gone = after[at]
                right = sym[gone]
                if right < 0 or rank_of(left << 20 | right) != rank:
                    continue
                sym[at], sym[gone] = rank, -2
                far = after[at] = after[gone]
                before[far] = at
                lower = False
                right = sym[far]
                if right >= 0:
                    new = rank_of(rank << 20 | right)
                    if new is not None:
                        lower = new < rank
                        if new in index:
                            index[new].append(at)
                        else:
                            index[new] = [at]
                            heapq.heappush(heap, new)
                near = before[at]
                left = sym[near] if near >= 0 else -1
                if left >= 0:
                    new = rank_of(left << 20 | rank)
                    if new is not None:
                        lower = lower or new < rank
                        if new in index:
                            index[new].append(near)
                        else:
                            index[new] = [near]
                            heapq.heappush(heap, new)
                if lower and done + 1 < len(places):
                    index.setdefault(rank, []).extend(places[done + 1:])
                    heapq.heappush(heap, rank)
                    break
        out, ids = [], []
        for s in sym:
            if s >= 0:
                ids.append(s)
            elif s == -1:
                out.append(ids)
                ids = []
        return out


_codecs = {}


def _codec(path, pattern):
    if (path, pattern) not in _codecs:
        replay = MergeReplay(read_ranks(path))
        sizes = np.array([len(t) for t in replay.tokens], np.int64)
        _codecs[path, pattern] = (
            WordCodes(replay.encode, KEPT_WORDS), regex.compile(pattern), sizes, np.cumsum(sizes) - sizes,
            np.frombuffer(b"".join(replay.tokens), np.uint8))
    return _codecs[path, pattern]


def decode_bytes(ids, sizes, begins, flat):
    """The bytes of all ids, one after another."""
    size = sizes[ids]
    shift = np.repeat(begins[ids] - (np.cumsum(size) - size), size)
    return flat[shift + np.arange(len(shift))]


def encode_decode(docs, ranks_file, pattern, *, id_col="doc_id", text_col="text", with_ids=False, keep=()):
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row (and `ids` on demand).

    Null and empty texts have no ids. Rows that repeat, and null ids, are kept;
    columns in `keep` come last, as they are, and others are not read. decoded_sha256 is taken from the bytes that the
    ids stand for. Memory: a piece of about 2 MB or one longer text, and the
    worker's table of words. An empty table gives an empty one.
    """

    def run(batches):
        codes, compiled, sizes, begins, flat = _codec(ranks_file, pattern)
        for batch in batches:
            for texts in pieces(batch.column(1)):
                start, first = pretokens(texts, compiled)
                ids, counts = codes.expand(texts, start, first)
                raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
                back = decode_bytes(ids, sizes, begins, flat)
                chars = np.concatenate(([0], np.cumsum(sizes[ids])))
                ends = np.concatenate(([0], np.cumsum(counts)))
                spans = list(zip(ends[:-1].tolist(), ends[1:].tolist()))
                view = memoryview(back)
                cut = chars[ends].tolist()
                columns = [
                    batch.column(0)[texts.rows], pa.array(counts, pa.int64()),
                    pa.array([hashlib.sha256(raw[4 * a:4 * b]).hexdigest() for a, b in spans]),
                    pa.array([hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(cut, cut[1:])])]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(
                        pa.array(ends, pa.int32()), pa.array(ids, pa.int32())))
                    names.append("ids")
                columns += [batch.column(2 + k)[texts.rows] for k in range(len(keep))]
                yield pa.RecordBatch.from_arrays(columns, names=names + list(keep))

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *keep)
    return slim.mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
        + ", ids array<int>" * with_ids
        + "".join(f", `{c}` {slim.schema[c].dataType.simpleString()}" for c in keep))
