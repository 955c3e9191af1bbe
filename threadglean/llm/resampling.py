"""Target-distribution importance resampling (11) with a head-tail vocabulary.

A feature is a run of 1 to `max_n` words; its bucket is the crc32 of its bytes modulo
`buckets`. The gain of a bucket compares its share among the target's features with that
among the corpus' features; a document's weight is the sum over its features, and a draw
without replacement proportional to the exponential of the weights takes the highest
scores, weight plus Gumbel noise from a digest of the id.

A crc32 is linear: that of a run of words follows from those of its words. So workers hold
the head of the vocabulary, the exact crc32 of the most frequent words and, for
max_n >= 2, the buckets of the most frequent pairs, looked up by 64-bit hashes. The words of
the tail take their crc32 from their bytes, all words of a piece at once. Both feed the same
bucket totals, and which words are in the head changes the work and not the result.
"""

import math
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from threadglean.llm.textbytes import LOWER, mix, pieces
from threadglean.operators.scale import cut_lineage, number_rows

HEAD_WORDS = 32_768     # words and pairs of the head, of HEAD_BYTES at most: some 1.5 MB in all
HEAD_BYTES = 64
TASK_WORDS = 8_192      # words of a task that may enter the head
DIRECT_BYTES = 64       # longer words are hashed one by one

# The bytes that part words, [\x00-\x2F\x3A-\x60\x7B-\x7F], once A-Z are folded.
APART = np.zeros(256, bool)
APART[0x00:0x30] = APART[0x3A:0x61] = APART[0x7B:0x80] = True
APART[0x41:0x5B] = False


def _crc_table():
    """crc32 step of each byte, from the polynomial."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1).astype(np.uint32)
    return step


_STEP = _crc_table()


def crc_of_spans(data, start, end):
    """crc32 of byte spans, byte by byte over all spans at once."""
    size = end - start
    out = np.full(len(start), 0xFFFFFFFF, np.uint32)
    order = np.argsort(-size, kind="stable")
    longest = int(np.searchsorted(-size[order], -DIRECT_BYTES))
    for i in order[:longest].tolist():
        out[i] = zlib.crc32(data[start[i]:end[i]]) ^ 0xFFFFFFFF
    rest = order[longest:]
    begin, state = start[rest], out[rest]
    live = np.searchsorted(-size[rest], -np.arange(1, DIRECT_BYTES + 1), "right")
    for at, n in enumerate(live.tolist()):
        if not n:
            break
        now = state[:n]
        state[:n] = _STEP[(now ^ data[begin[:n] + at]) & 0xFF] ^ (now >> 8)
    out[rest] = state
    return out ^ np.uint32(0xFFFFFFFF)


@lru_cache(maxsize=256)
def _zeros_table(size):
    """Four tables by byte that carry a crc32 over `size` zero bytes."""
    table = np.array([np.arange(256, dtype=np.uint64) << np.uint64(8 * k) for k in range(4)]).astype(np.uint32)
    step, left = None, size
    while left:
        step = _one_zero() if step is None else _apply(step, step)
        if left & 1:
            table = _apply(step, table)
        left >>= 1
    return table


def _one_zero():
    value = np.array([np.arange(256, dtype=np.uint64) << np.uint64(8 * k) for k in range(4)]).astype(np.uint32)
    return _STEP[value & 0xFF] ^ (value >> 8)


def _apply(table, values):
    return (table[0][values & 0xFF] ^ table[1][values >> 8 & 0xFF]
            ^ table[2][values >> 16 & 0xFF] ^ table[3][values >> 24])


def crc_joined(left, right, right_size):
    """crc32 of each left string followed by the right one of `right_size` bytes."""
    out = np.empty(len(left), np.uint32)
    for size in np.unique(right_size).tolist():
        same = right_size == size
        out[same] = _apply(_zeros_table(size), left[same])
    return out ^ right


def _find(keys, hashes):
    """(place, whether it is there) of hashes in the sorted keys of the head."""
    if not len(keys):
        return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
    at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
    return at, keys[at] == hashes


def _pair_hashes(left, right):
    return mix(left * np.uint64(0xD6E8FEB86659FD93) + right)


class Head:
    """Exact crc32 states of frequent words and buckets of frequent pairs."""

    def __init__(self, words=(), pairs=(), buckets=10_000):
        self.words, self.crcs = self._table(words, buckets=None)
        self.pairs, self.pair_buckets = self._table(pairs, buckets)

    @staticmethod
    def _table(entries, buckets):
        """Sorted hashes of (hash, bytes) entries, with the crc32 or bucket of each."""
        keys = np.array([h for h, _ in entries], np.int64).view(np.uint64)
        values = np.array([zlib.crc32(text) for _, text in entries], np.uint32)
        order = np.argsort(keys)
        return keys[order], values[order] if buckets is None else values[order] % np.uint32(buckets)

    def word_crcs(self, texts, start, end, hashes):
        at, known = _find(self.words, hashes)
        out = np.empty(len(start), np.uint32)
        out[known] = self.crcs[at[known]] if len(self.words) else 0
        tail = ~known
        out[tail] = crc_of_spans(LOWER[texts.data] if tail.any() else texts.data, start[tail], end[tail])
        return out


def _features(texts, head, buckets, max_n):
    """(bucket, owner, words per text) of the features of a piece."""
    start, end, first = texts.words(APART)
    hashes = texts.hashes(start, end, LOWER)
    words = np.diff(first)
    owner = np.repeat(np.arange(len(words)), words)
    crc, size = head.word_crcs(texts, start, end, hashes), end - start
    found, owners = [crc % np.uint32(buckets)], [owner]
    space = np.full(len(crc), zlib.crc32(b" "), np.uint32)
    tail = crc_joined(space, crc, size) if max_n > 1 else crc   # " word"
    run, last = crc, np.arange(len(crc))
    for n in range(2, max_n + 1):
        keep = np.flatnonzero(last + 1 < first[owner[last] + 1]) if len(last) else last
        run, last = run[keep], last[keep] + 1
        if n == 2:
            at, known = _find(head.pairs, _pair_hashes(hashes[last - 1], hashes[last]))
            bucket = np.empty(len(run), np.uint32)
            bucket[known] = head.pair_buckets[at[known]] if len(head.pairs) else 0
            run = run.copy()
            unknown = np.flatnonzero(~known) if max_n == 2 else np.arange(len(run))
            run[unknown] = crc_joined(run[unknown], tail[last[unknown]], size[last[unknown]] + 1)
            bucket[~known] = run[~known] % np.uint32(buckets)
        else:
            run = crc_joined(run, tail[last], size[last] + 1)
            bucket = run % np.uint32(buckets)
        found.append(bucket)
        owners.append(owner[last])
    return np.concatenate(found), np.concatenate(owners), words


def _frequent(max_n):
    """kind, hash, bytes, n: the most frequent short words (1) and pairs (2) of a task.

    Only what a piece holds twice is counted, and the rarest leave a task's table when it is
    full: counts only choose the head.
    """
    def run(batches):
        tables = {kind: {} for kind in range(1, min(max_n, 2) + 1)}
        for batch in batches:
            for texts in pieces(batch.column(0)):
                start, end, first = texts.words(APART)
                hashes, lowered = texts.hashes(start, end, LOWER), None
                for kind, table in tables.items():
                    if kind == 1:
                        keys, a, b = hashes, start, end
                    else:
                        inner = np.ones(max(len(start) - 1, 0), bool)
                        inner[first[(first > 0) & (first < len(start))] - 1] = False
                        at = np.flatnonzero(inner)
                        keys, a, b = _pair_hashes(hashes[at], hashes[at + 1]), start[at], end[at + 1]
                    short = b - a <= HEAD_BYTES
                    keys, a, b = keys[short], a[short], b[short]
                    distinct, where, counts = np.unique(keys, return_index=True, return_counts=True)
                    often = counts > 1
                    for h, i, n in zip(distinct[often].tolist(), where[often].tolist(), counts[often].tolist()):
                        have = table.get(h)
                        if have is not None:
                            have[1] += n
                        else:
                            if lowered is None:
                                lowered = LOWER[texts.data]
                            text = bytes(lowered[a[i]:b[i]])
                            table[h] = [text if kind == 1 else _spaced(text), n]
                    if len(table) > 4 * TASK_WORDS:
                        tables[kind] = dict(_most(table))
        for kind, table in tables.items():
            rows = _most(table)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([kind] * len(rows), pa.int32()),
                     pa.array(np.array([h for h, _ in rows], np.uint64).view(np.int64)),
                     pa.array([x[0] for _, x in rows], pa.binary()), pa.array([x[1] for _, x in rows], pa.int64())],
                    names=["kind", "hash", "word", "n"])
    return run


def _spaced(text):
    """Two words with what parts them made one space."""
    raw = np.frombuffer(text, np.uint8)
    gap = np.flatnonzero(APART[raw])
    return text[:gap[0]] + b" " + text[gap[-1] + 1:]


def _most(table):
    return sorted(table.items(), key=lambda x: (-x[1][1], x[0]))[:TASK_WORDS]


def head_of(texts, *, max_n=1, buckets=10_000, head_words=HEAD_WORDS):
    """The head of all texts (a frame with the column `text`): at most `head_words` words and
    as many pairs, of HEAD_BYTES bytes at most, reach the driver."""
    counted = texts.mapInArrow(_frequent(max_n), "kind int, hash long, word binary, n long").groupBy(
        "kind", "hash").agg(F.min("word").alias("word"), F.sum("n").alias("n"))
    entries = []
    for kind in (1, 2):
        best = counted.where(F.col("kind") == kind).orderBy(F.desc("n"), "hash").limit(head_words)
        entries.append([(r.hash, bytes(r.word)) for r in best.select("hash", "word").collect()]
                       if kind <= max_n else [])
    return Head(*entries, buckets)


def bucket_totals(texts, head, *, buckets=10_000, max_n=1):
    """Features per bucket of all texts, as an array of `buckets` numbers.

    A task sends one count per bucket it has met, at most `buckets` rows.
    """
    shared = texts.sparkSession.sparkContext.broadcast(head)

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for piece in pieces(batch.column(0)):
                total += np.bincount(_features(piece, shared.value, buckets, max_n)[0], minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(total[met])], names=["bucket", "n"])

    rows = texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[np.asarray(rows["bucket"])] = np.asarray(rows["n"])
    return out


def gains_of(corpus, target):
    """floor(1000 ln(share in target / share in corpus)) of each bucket, with one added."""
    n = len(corpus)
    s, t = float(corpus.sum() + n), float(target.sum() + n)
    return np.array([math.floor(1000 * math.log((b + 1) * s / ((a + 1) * t)))
                     for a, b in zip(corpus.tolist(), target.tolist())], np.int64)


def weigh(docs, head, gains, *, id_col="doc_id", text_col="text", max_n=1):
    """doc_id, n_words, n_features and weight of every row."""
    shared = docs.sparkSession.sparkContext.broadcast((head, gains))

    def run(batches):
        for batch in batches:
            for texts in pieces(batch.column(1)):
                head, gains = shared.value
                bucket, owner, words = _features(texts, head, len(gains), max_n)
                n = len(words)
                features = np.bincount(owner, minlength=n)
                # Whole numbers of far under 2**53, which doubles add exactly.
                weight = np.bincount(owner, gains[bucket].astype(float), minlength=n).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[texts.rows], pa.array(words, pa.int64()), pa.array(features, pa.int64()),
                     pa.array(weight)], names=["doc_id", "n_words", "n_features", "weight"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(seed):
    """floor(-1000 ln(-ln u)) with u from the first 32 bits of sha256(seed:doc_id)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(docs, target, *, id_col="doc_id", text_col="text", target_text_col="text", max_n=1,
             buckets=10_000, seed=2024, percent=10, least_words=20):
    """doc_id, n_features, weight, score and rank of every row; drawn rows have a rank.

    Of the N rows with an id and `least_words` words, floor(percent * N / 100) are drawn: the
    highest scores, ties to the smaller id. A null or empty text has no features and weight 0;
    a row with a null id has no score and is never drawn, but its features count
    in the corpus. Rows that share an id are rows of their own with the same noise; equal
    ones are interchangeable. An empty target gives every document gains against an even
    target, an empty table an empty result. Other columns are not read.

    Texts are read three times and never shuffled; per row, four numbers are sorted by
    ranges for the ranks.
    """
    texts, aim = docs.select(F.col(text_col).alias("text")), target.select(F.col(target_text_col).alias("text"))
    head = head_of(texts, max_n=max_n, buckets=buckets)
    gains = gains_of(bucket_totals(texts, head, buckets=buckets, max_n=max_n),
                     bucket_totals(aim, head, buckets=buckets, max_n=max_n))
    weighed = weigh(docs, head, gains, id_col=id_col, text_col=text_col, max_n=max_n)
    able = F.col("doc_id").isNotNull() & (F.col("n_words") >= least_words)
    scored = cut_lineage(weighed.withColumn("score", F.col("weight") + noise(seed)).withColumn("able", able))
    drawn = scored.where("able").count() * percent // 100
    order = [F.desc("able"), F.desc("score"), "doc_id", "weight", "n_features"]
    ranked = number_rows(scored, order, "place", small_limit=0)
    rank = F.when(F.col("able") & (F.col("place") <= drawn), F.col("place"))
    return ranked.select("doc_id", "n_features", "weight", F.col("score").cast("long").alias("score"),
                         rank.alias("rank"))
