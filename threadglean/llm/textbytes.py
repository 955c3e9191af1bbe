"""Words and pre-tokens of Arrow text columns, found on the UTF-8 bytes with numpy.

A batch is worked on in pieces of bounded bytes that hold whole texts, so memory
follows the piece and the longest single text, not the batch.
"""

import numpy as np
import pyarrow as pa
import regex

PIECE_BYTES = 1024 * 1024

# The white space bytes of the word rule [^\x20\x09-\x0D]+.
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# Anything ASCII that is not a letter parts words of the letter rule.
NOT_LETTER = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_SEED = np.random.default_rng(20240607)
_BYTE = _SEED.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = int(_SEED.integers(2**62, 2**63)) | 1
_powers = {}


def mix(x):
    """Spread 64-bit values over all bits (in place)."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(base, n):
    """base**0 .. base**(n-1) modulo 2**64, kept for the worker's life."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, PIECE_BYTES + 2), base % 2**64, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if n <= PIECE_BYTES + 2:  # those of a longer text are not kept
            _powers[base] = have
    return have[:n]


class Texts:
    """Whole texts of a piece: `data` bytes, `offsets` of each text (n + 1)."""

    def __init__(self, data, offsets, rows, valid):
        self.data, self.offsets, self.rows, self.valid = data, offsets, rows, valid
        self._sums = None

    def __len__(self):
        return len(self.offsets) - 1

    def words(self, apart=WHITE):
        """(start, end, first): byte spans of words and each text's first word (n + 1)."""
        word = ~apart[self.data]
        if not len(word):
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(len(self.offsets), np.int64)
        begins, ends = word.copy(), word.copy()
        begins[1:] &= ~word[:-1]
        ends[:-1] &= ~word[1:]
        edges = self.offsets[(self.offsets > 0) & (self.offsets < len(word))]
        begins[edges] = word[edges]
        ends[edges - 1] = word[edges - 1]
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        return start, end, np.searchsorted(start, self.offsets)

    def hashes(self, start, end, fold=None):
        """64-bit hashes of byte spans; `fold` maps bytes first (lower case)."""
        n = len(self.data)
        if self._sums is None or self._sums[0] is not fold:
            values = _BYTE[self.data if fold is None else fold[self.data]]
            values *= _power(_BASE, n)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(values, out=sums[1:])
            self._sums = (fold, sums)
        sums = self._sums[1]
        out = (sums[end] - sums[start]) * _power(pow(_BASE, -1, 2**64), n + 1)[start]
        out += (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return mix(out)

    def bytes_of(self, start, end):
        view = memoryview(np.ascontiguousarray(self.data))
        return [bytes(view[a:b]) for a, b in zip(start.tolist(), end.tolist())]


def pieces(column, limit=PIECE_BYTES):
    """Texts of an Arrow string column, in pieces of about `limit` bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    n = len(column)
    if not n:
        return
    valid = np.asarray(column.is_valid())
    column = column.fill_null("")
    _, raw_offsets, raw = column.buffers()
    offsets = np.frombuffer(raw_offsets, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        to = min(to, n)
        yield Texts(data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at],
                    slice(at, to), valid[at:to])
        at = to
    # What Arrow holds beyond its use goes back, as a worker serves many tasks.
    pa.default_memory_pool().release_unused()


def shingles(hashes, first, width):
    """(values, owner): one hash per run of `width` words, with the text it is in."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[i:i + n]
    mix(out)
    counts = np.diff(first)
    owner = np.repeat(np.arange(len(counts)), counts)[:n]
    whole = np.arange(n) + width <= first[owner + 1]
    return out[whole], owner[whole]


# Classes of bytes for the pre-token pattern.
_LETTER, _DIGIT, _SPACE, _OTHER, _RARE = range(5)
_CLASS = np.full(256, _RARE, np.uint8)
for _b in range(128):
    _c = chr(_b)
    _CLASS[_b] = (_LETTER if _c.isalpha() else _DIGIT if _c.isdigit()
                  else _SPACE if _b in (9, 10, 11, 12, 13, 32) else _RARE if 28 <= _b <= 31 else _OTHER)
# Two-byte letters U+00C0 to U+024F; their exceptions are caught below.
_CLASS[0xC3:0xCA] = _LETTER
_CLASS[0x80:0xC0] = _LETTER


def pretokens(texts, pattern):
    """(start, first): the pre-tokens, which tile each text, as `pattern` gives them.

    Texts of ASCII and Latin letters are cut by byte classes, which is the
    pattern public_tokenizers.PATTERN; a text with any other character goes
    through the pattern itself.
    """
    data, offsets = texts.data, texts.offsets
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    kind = _CLASS[data]
    follow = (data >= 0x80) & (data < 0xC0)
    lead = (data >= 0xC3) & (data < 0xCA)
    rare = kind == _RARE
    rare[1:] |= follow[1:] & ~lead[:-1]
    rare[1:] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))
    rare[1:] |= (data[:-1] == 0xC9) & (data[1:] > 0x8F)
    rare_texts = np.unique(np.searchsorted(offsets, np.flatnonzero(rare), "right") - 1)

    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    edge[1:n] |= kind[1:] != kind[:-1]
    space = kind == _SPACE
    begins = edge[:n].copy()
    # The last white space byte before a word is a token of its own, or belongs to it.
    last_space = np.flatnonzero(space & edge[1:])
    text_end = np.zeros(n + 1, bool)
    text_end[offsets] = True
    last_space = last_space[~text_end[last_space + 1]]
    begins[last_space] = True
    joined = last_space[data[last_space] == 0x20] + 1
    begins[joined] = False
    # Contractions: an apostrophe that starts a token, before letters.
    quote = np.flatnonzero((data == 0x27) & begins)
    quote = quote[quote + 1 < n]
    quote = quote[~text_end[quote + 1]]
    if len(quote):
        a = data[quote + 1]
        b = data[np.minimum(quote + 2, n - 1)]
        b = np.where((quote + 2 < n) & ~text_end[np.minimum(quote + 2, n)], b, 0)
        one = np.isin(a, np.frombuffer(b"stmd", np.uint8))
        two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | (
            (a == ord("l")) & (b == ord("l")))
        size = np.where(one, 1, np.where(two, 2, 0))
        quote, size = quote[size > 0], size[size > 0]
        begins[quote + 1] = False
        after = quote + 1 + size
        begins[after[after < n]] = True
    start = np.flatnonzero(begins)
    if len(rare_texts):
        exact = pattern if hasattr(pattern, "finditer") else regex.compile(pattern)
        first = np.searchsorted(start, offsets)
        parts, done = [], 0
        for t in rare_texts.tolist():
            parts.append(start[done:first[t]])
            text = bytes(data[offsets[t]:offsets[t + 1]]).decode("utf-8")
            found = [len(m.encode("utf-8")) for m in exact.findall(text)]
            parts.append(offsets[t] + np.concatenate(([0], np.cumsum(found)[:-1])).astype(np.int64))
            done = first[t + 1]
        parts.append(start[done:])
        start = np.concatenate(parts)
    return start, np.searchsorted(start, offsets)


class WordCodes:
    """Ids of distinct words, kept in a worker; `encode` maps a list of bytes to id lists.

    Words are looked up by their hash in a sorted array, about 30 bytes for each. Beyond `keep`
    words the table starts anew, so that memory stays bounded.
    """

    def __init__(self, encode, keep=1_500_000):
        self.encode, self.keep = encode, keep
        self._reset()

    def _reset(self):
        self.hashes, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.begins, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.flat, self.used = np.zeros(0, np.int32), 0

    def _add(self, hashes, at, words):
        """Slots of new words, whose hashes belong at these places of the sorted array."""
        ids = self.encode(words)
        sizes = np.fromiter(map(len, ids), np.int32, len(ids))
        total, base = int(sizes.sum()), len(self.sizes)
        if self.used + total > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros(max(total, len(self.flat) // 2), np.int32)))
        self.flat[self.used:self.used + total] = np.fromiter((i for word in ids for i in word), np.int32, total)
        slots = np.arange(base, base + len(ids), dtype=np.int32)
        self.begins = np.concatenate((self.begins, self.used + np.cumsum(sizes, dtype=np.int32) - sizes))
        self.sizes = np.concatenate((self.sizes, sizes))
        self.used += total
        self.hashes, self.slots = np.insert(self.hashes, at, hashes), np.insert(self.slots, at, slots)
        return slots

    def expand(self, texts, start, first):
        """(ids, counts): all ids of the pieces' texts and their number per text."""
        end = np.append(start[1:], len(texts.data))
        distinct, where, index = np.unique(texts.hashes(start, end), return_index=True, return_inverse=True)
        if len(self.hashes) > self.keep:
            self._reset()
        at = np.searchsorted(self.hashes, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == distinct[inside]
        slot = np.zeros(len(distinct), np.int32)
        slot[known] = self.slots[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            words = texts.bytes_of(start[where[new]], end[where[new]])
            slot[new] = self._add(distinct[new], at[new], words)
        begin, size = self.begins[slot][index], self.sizes[slot][index].astype(np.int64)
        stop = np.cumsum(size)
        ids = self.flat[np.repeat(begin - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)]
        sums = np.concatenate(([0], stop))
        return ids, np.diff(sums[first])
