"""Substring deduplication (4) over compressed FM-indexes.

A word goes if a window of WINDOW words that covers it also starts in a document with
a smaller id. Equal windows meet because both carry the same minimizer, the
least hash of the GRAM-word groups inside: runs of consecutive windows with one
minimizer form segments, and only segments whose minimizer occurs in two documents or
more are looked at again. Segments are dealt to shards by minimizer, where equal ones become one with the
least document id. Minimizers of very many documents, HOT_KEYS at most, are sent to all tasks;
their segments are taken where the texts stand and equal ones become one before that
shuffle, so a passage that very many documents share does not pile up; only if very many
different ones remain is that minimizer dealt window by window.

Each shard indexes its segments: the text of word numbers, sorted by contexts of
WINDOW words, its Burrows-Wheeler transform in a wavelet matrix of packed bits.
Then its segments are streamed from their ends: backward search extends the match by a
word, and past WINDOW words first drops the last one, so every window's interval
takes one step. The least document id of an interval decides about the window.
"""

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from threadglean.llm.textbytes import mix, pieces, shingles
from threadglean.operators.scale import cut_lineage

WINDOW = 13
GRAM = 6
RUN = 32           # windows of a segment at most
HOT_DOCS = 1000    # equal segments of a minimizer in more documents are joined first
HOT_KEYS = 500_000      # at most so many minimizers, those of the most documents, are joined first
HOT_SEGMENTS = 1000     # a minimizer with more different segments is dealt window by window
SHARD_SEGMENTS = 15_000


class Wavelet:
    """Wavelet matrix: rank of a symbol before a place, in one step per bit."""

    def __init__(self, symbols, bits):
        self.bits, self.levels, n = bits, [], len(symbols)
        now = symbols
        for bit in range(bits - 1, -1, -1):
            ones = (now >> bit & 1).astype(bool)
            padded = np.zeros((n // 64 + 1) * 64, bool)
            padded[:n] = ones
            packed = np.packbits(padded, bitorder="little").view(np.uint64)
            before = np.zeros(len(packed) + 1, np.int64)
            np.cumsum(np.bitwise_count(packed), out=before[1:])
            self.levels.append((bit, packed, before, n - int(ones.sum())))
            now = np.concatenate((now[~ones], now[ones]))
        # Where each symbol's stretch begins after the last level.
        order = np.zeros(1 << bits, np.int64)
        heads = np.flatnonzero(np.concatenate(([True], now[1:] != now[:-1]))) if n else []
        order[now[heads] if n else []] = heads
        self.heads = order

    def rank(self, symbol, place):
        at = place.copy()
        for bit, packed, before, zeros in self.levels:
            cell = at >> 6
            mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = before[cell] + np.bitwise_count(packed[cell] & mask)
            at = np.where(symbol >> bit & 1, zeros + ones, at - ones)
        return at - self.heads[symbol]


def _ranked(high, low):
    """Ranks (equal for equal pairs) and the order of pairs of ranks."""
    key = high * (int(low.max(initial=0)) + 1) + low
    order = np.argsort(key, kind="stable")
    fresh = np.concatenate(([False], np.diff(key[order]) != 0))
    ranks = np.empty(len(key), np.int64)
    ranks[order] = np.cumsum(fresh)
    return ranks, order, fresh


def _shifted(ranks, by):
    """Ranks of the suffixes `by` places on; beyond the end comes first."""
    out = np.zeros(len(ranks), np.int64)
    out[:len(ranks) - by] = ranks[by:] + 1
    return out


class FmIndex:
    """Over word numbers (positive) of segments that each end in 0."""

    def __init__(self, text, width=WINDOW):
        self.n = n = len(text)
        # Contexts of 1, 2, 4, ... words, then of width - 1 and width words.
        by, ranks = 1, text
        while by * 2 <= width - 1:
            ranks = _ranked(ranks, _shifted(ranks, by))[0]
            by *= 2
        shorter, _, _ = _ranked(ranks, _shifted(ranks, width - 1 - by))
        full, self.order, fresh = _ranked(ranks, _shifted(ranks, width - by))
        self.block = np.cumsum(fresh)                       # stretch of equal windows
        self.block_start = np.flatnonzero(np.concatenate(([True], fresh[1:]))) if n else fresh
        # Stretches of equal contexts one word shorter: what remains after a drop.
        level = shorter[self.order]
        heads = np.flatnonzero(np.concatenate(([True], np.diff(level) != 0)))
        which = np.cumsum(np.concatenate(([0], np.diff(level) != 0)))
        self.parent_lo = heads[which]
        self.parent_hi = np.append(heads[1:], n)[which]
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text))))
        self.bwt = Wavelet(text[self.order - 1], max(1, int(text.max(initial=1)).bit_length()))

    def extend(self, lo, hi, symbol):
        """Intervals of `symbol` followed by what the intervals stand for."""
        base = self.first[symbol]
        return base + self.bwt.rank(symbol, lo), base + self.bwt.rank(symbol, hi)

    def least(self, values):
        """For each stretch of equal windows, the least value of its places."""
        return np.minimum.reduceat(values[self.order], self.block_start)


def match_segments(text, starts, lengths, values, width=WINDOW):
    """(owner, window, least value) for every window of every segment.

    `starts` and `lengths` give the segments in `text`, `values` one value per segment.
    """
    index = FmIndex(text, width)
    value_of = np.full(len(text), np.iinfo(np.int64).max)
    value_of[np.arange(len(text))] = np.repeat(values, lengths + 1)
    least = index.least(value_of)
    lo, hi = np.zeros(len(starts), np.int64), np.full(len(starts), len(text))
    out = []
    for step in range(int(lengths.max(initial=0))):
        live = np.flatnonzero(lengths > step)
        a, b = lo[live], hi[live]
        if step >= width:
            a, b = index.parent_lo[a], index.parent_hi[a]
        place = lengths[live] - 1 - step
        lo[live], hi[live] = a, b = index.extend(a, b, text[starts[live] + place])
        if step >= width - 1:
            out.append((live, place, least[index.block[a]]))
    if not out:
        return [np.zeros(0, np.int64)] * 3
    return [np.concatenate(x) for x in zip(*out)]


class Windows:
    """Word spans, hashes and minimizers of the windows of a piece of texts."""

    def __init__(self, texts):
        self.texts = texts
        self.start, self.end, self.first = texts.words()
        self.hashes = texts.hashes(self.start, self.end)
        grams = shingles(self.hashes, np.array([0, len(self.hashes)]), GRAM)[0]
        n = len(self.start) - WINDOW + 1
        counts = np.diff(self.first)
        owner = np.repeat(np.arange(len(counts)), counts)
        if n <= 0:
            self.at = self.owner = np.zeros(0, np.int64)
            self.minimizer = np.zeros(0, np.uint64)
            return
        width, least, reach = WINDOW - GRAM + 1, grams, 1
        while reach * 2 <= width:
            least = np.minimum(least[:len(least) - reach], least[reach:])
            reach *= 2
        least = np.minimum(least[:n], least[width - reach:width - reach + n])
        whole = np.arange(n) + WINDOW <= self.first[owner[:n] + 1]
        self.at = np.flatnonzero(whole)
        self.owner, self.minimizer = owner[self.at], least[self.at]

    def runs(self):
        """(first window, windows, owner, minimizer) of the segments."""
        n = len(self.at)
        if not n:
            return self.at, self.at, self.owner, self.minimizer
        new = np.ones(n, bool)
        new[1:] = ((self.minimizer[1:] != self.minimizer[:-1]) | (self.at[1:] != self.at[:-1] + 1)
                   | (self.owner[1:] != self.owner[:-1]))
        head = np.flatnonzero(new)
        since = np.arange(n) - np.repeat(head, np.diff(np.append(head, n)))
        head = np.flatnonzero(since % RUN == 0)
        size = np.diff(np.append(head, n))
        return self.at[head], size, self.owner[head], self.minimizer[head]

    def joined(self):
        """(bytes, begin of each word): all words, each followed by one space."""
        size = self.end - self.start
        begin = np.cumsum(size + 1) - (size + 1)
        out = np.full(int((size + 1).sum()), 0x20, np.uint8)
        word = np.repeat(np.arange(len(size)), size)
        inner = np.arange(len(word)) - np.repeat(np.cumsum(size) - size, size)
        out[begin[word] + inner] = self.texts.data[self.start[word] + inner]
        return out, begin

    def keys(self, first, words):
        """Two hashes of runs of words, of 64 bits; the second is used in part."""
        out = []
        for factor in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB):
            f = np.uint64(factor)
            n = len(self.hashes)
            powers = np.full(n + 1, f, np.uint64)
            powers[0] = 1
            powers = np.multiply.accumulate(powers)
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(self.hashes ^ f) * powers[:n])))
            inverse = np.full(n + 1, pow(factor, -1, 2**64), np.uint64)
            inverse[0] = 1
            inverse = np.multiply.accumulate(inverse)
            value = (sums[first + words] - sums[first]) * inverse[first]
            out.append(mix(value + words.astype(np.uint64)).view(np.int64))
        return out


def _slices(data, begin, end):
    """Arrow binary array of stretches of `data`."""
    size = end - begin
    stop = np.concatenate(([0], np.cumsum(size)))
    place = np.repeat(begin - stop[:-1], size) + np.arange(stop[-1])
    return pa.Array.from_buffers(
        pa.large_binary(), len(size),
        [None, pa.py_buffer(stop.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[place]))]
    ).cast(pa.binary())


def _minimizers(batches):
    """doc_id, mark, h: the distinct minimizers of each text."""
    for batch in batches:
        for texts in pieces(batch.column(2)):
            _, _, owner, h = Windows(texts).runs()
            order = np.lexsort((h, owner))
            owner, h = owner[order], h[order]
            new = np.ones(len(h), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])
            rows = pa.array(owner[new] + texts.rows.start)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(h[new].view(np.int64))],
                names=["doc_id", "mark", "h"])


def _listed(column, rows):
    """(value, owner) of a list column's rows."""
    part = column.slice(rows.start, rows.stop - rows.start)
    sizes = np.array([len(x) if x.is_valid else 0 for x in part], np.int64)
    flat = part.flatten()
    return np.asarray(flat).astype(np.int64).view(np.uint64), np.repeat(np.arange(len(sizes)), sizes)


def _tagged(h, owner):
    return h * np.uint64(0x9E3779B97F4A7C15) + mix(owner.astype(np.uint64) + np.uint64(1))


def _listed_rows(batch, *columns):
    """The rows with an entry in one of these list columns."""
    sizes = [pc.fill_null(pc.list_value_length(batch.column(c)), 0) for c in columns]
    some = [pc.greater(x, 0) for x in sizes]
    return batch.filter(reduce(pc.or_, some))


def _chosen(windows, whole, single, rows):
    """(first window, words, owner, route) of the segments listed in a column of `whole`, or by window."""
    first, size, owner, h = windows.runs()
    tag = _tagged(h, owner)
    take = np.isin(tag, np.concatenate([_tagged(*_listed(column, rows)) for column in whole]))
    cut = np.flatnonzero(np.isin(tag, _tagged(*_listed(single, rows))))
    count = size[cut]
    each = np.repeat(first[cut] - (np.cumsum(count) - count), count) + np.arange(count.sum())
    return (np.concatenate((first[take], each)),
            np.concatenate((size[take] + WINDOW - 1, np.full(len(each), WINDOW))),
            np.concatenate((owner[take], np.repeat(owner[cut], count))), h[take].view(np.int64))


def _places(batches):
    """doc_id, mark, k1, k2, start: where each listed segment stands."""
    for batch in batches:
        batch = _listed_rows(batch, 3, 4, 5)
        for texts in pieces(batch.column(2)):
            windows = Windows(texts)
            first, words, owner, _ = _chosen(
                windows, [batch.column(3), batch.column(4)], batch.column(5), texts.rows)
            k1, k2 = windows.keys(first, words)
            rows = pa.array(owner + texts.rows.start)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(k1),
                 pa.array(k2.astype(np.int32)), pa.array((first - windows.first[owner]).astype(np.int32))],
                names=["doc_id", "mark", "k1", "k2", "start"])


def _texts_of(windows, first, words):
    """The words of runs, each followed by one space but the last."""
    data, begin = windows.joined()
    last = first + words - 1
    return _slices(data, begin[first], begin[last] + windows.end[last] - windows.start[last])


def _segment_rows(batch, texts, windows, first, words, owner, route):
    doc = batch.column(0).take(pa.array(owner + texts.rows.start))
    return pa.RecordBatch.from_arrays(
        [pa.array(route), _texts_of(windows, first, words), doc, doc], names=["route", "segment", "low", "high"])


def _segments(batches):
    """route, segment, low, high: the segments whose minimizers are listed as those of few documents."""
    for batch in batches:
        batch = _listed_rows(batch, 3)
        none = pa.nulls(len(batch), batch.column(3).type)
        for texts in pieces(batch.column(2)):
            windows = Windows(texts)
            yield _segment_rows(batch, texts, windows, *_chosen(windows, [batch.column(3)], none, texts.rows))


def _hot_segments(keys):
    """The segments whose minimizers are in the broadcast `keys`, equal ones of a piece as one."""
    def run(batches):
        for batch in batches:
            for texts in pieces(batch.column(2)):
                windows = Windows(texts)
                first, size, owner, h = windows.runs()
                take = np.flatnonzero(np.isin(h, keys.value))
                rows = _segment_rows(
                    batch, texts, windows, first[take], size[take] + WINDOW - 1, owner[take], h[take].view(np.int64))
                once = pa.Table.from_batches([rows]).group_by(["route", "segment"]).aggregate(
                    [("low", "min"), ("high", "max")]).rename_columns(rows.schema.names)
                yield from once.to_batches()
    return run


def _cut(batches):
    """The windows of segments as segments of their own, each with a route of its own."""
    for batch in batches:
        column = batch.column(1).cast(pa.large_binary()).cast(pa.large_string())
        for texts in pieces(column):
            windows = Windows(texts)
            words = np.full(len(windows.at), WINDOW)
            rows = pa.array(windows.owner + texts.rows.start)
            yield pa.RecordBatch.from_arrays(
                [pa.array(windows.keys(windows.at, words)[0]), _texts_of(windows, windows.at, words),
                 batch.column(2).take(rows), batch.column(3).take(rows)],
                names=["route", "segment", "low", "high"])


def _search(table):
    """k1, k2, least: the least document id of every window of a shard's segments."""
    column = table["segment"].combine_chunks().cast(pa.large_binary()).cast(pa.large_string())
    windows = Windows(next(pieces(column, 1 << 62)))
    lengths = np.diff(windows.first)
    k1, k2 = windows.keys(windows.first[:-1], lengths)
    # Equal segments are indexed once.
    order = np.lexsort((k2, k1))
    new = np.ones(len(order), bool)
    new[1:] = (k1[order][1:] != k1[order][:-1]) | (k2[order][1:] != k2[order][:-1])
    heads, once = np.flatnonzero(new), order[new]
    low = np.minimum.reduceat(np.asarray(table["low"])[order], heads)
    high = np.maximum.reduceat(np.asarray(table["high"])[order], heads)
    k1, k2, lengths = k1[once], k2[once], lengths[once]
    word = np.repeat(windows.first[once] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    _, number = np.unique(windows.hashes[word], return_inverse=True)
    begins = np.cumsum(lengths + 1) - (lengths + 1)
    text = np.zeros(len(number) + len(lengths), np.int64)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    text[np.arange(len(number)) + owner] = number + 1
    owner, window, least = match_segments(text, begins, lengths, low)
    order = np.lexsort((window, owner))
    least = least[order]
    ends = np.concatenate(([0], np.cumsum(lengths - WINDOW + 1)))
    # Segments of one document that no smaller document shares decide nothing.
    telling = (high > low) | (np.minimum.reduceat(least, ends[:-1]) < low)
    out = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(least))
    keep = pa.array(np.flatnonzero(telling))
    return pa.table([pa.array(k1).take(keep), pa.array(k2.astype(np.int32)).take(keep), out.take(keep)],
                    names=["k1", "k2", "least"])


def _joined(segments):
    """Equal segments as one."""
    return segments.groupBy("route", "segment").agg(F.min("low").alias("low"), F.max("high").alias("high"))


def find_spans(docs, *, id_col="doc_id", text_col="text", carry=()):
    """(base, hits): texts with a mark, and per doc_id and mark the windows that go.

    `hits` has doc_id, mark and `found`: arrays of the word positions at which repeated
    windows start. The mark tells texts of one id apart and is 0 if no id repeats. Columns to
    `carry` go along in a struct `rest`; texts are shuffled once, and both joins read that
    shuffle.
    """
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"))
    repeated = not ids.dropna().groupBy("doc_id").count().where("count > 1").isEmpty()
    base = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.hash(text_col) if repeated else F.lit(0)).alias("mark"),
        F.col(text_col).alias("text"), *[F.struct(*carry).alias("rest")] * bool(carry))
    marked = base.where("doc_id is not null").select("doc_id", "mark", "text").mapInArrow(
        _minimizers, "doc_id long, mark int, h long")
    shared = cut_lineage(marked.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"))
    total = shared.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shards = max(1, -(-total // SHARD_SEGMENTS))
    is_hot = F.col("n") > max(HOT_DOCS, total // HOT_KEYS)
    kind = "route long, segment binary, low long, high long"
    keys = np.asarray(shared.where(is_hot).select("h").toArrow()["h"]).view(np.uint64)
    keys = docs.sparkSession.sparkContext.broadcast(np.sort(keys))
    hot = cut_lineage(_joined(base.where("doc_id is not null").select("doc_id", "mark", "text").mapInArrow(
        _hot_segments(keys), kind)))
    wide = cut_lineage(hot.groupBy(F.col("route").alias("h")).agg(F.count("*").alias("n")).where(
        F.col("n") > HOT_SEGMENTS).select("h", F.lit(True).alias("cut")))
    routes = shared.join(wide, "h", "left").select(
        "h", F.when(~is_hot, 0).when(F.col("cut").isNull(), 1).otherwise(2).alias("way"))
    wanted = cut_lineage(
        marked.join(routes, "h").groupBy("doc_id", "mark").agg(*[
            F.collect_set(F.when(F.col("way") == way, F.col("h"))).alias(name)
            for way, name in enumerate(["few", "many", "wide"])]))
    # `rest` is handed over, unread, so that this shuffle of texts is the final join's too.
    listed = base.join(wanted, ["doc_id", "mark"], "left").select(
        "doc_id", "mark", "text", "few", "many", "wide", *["rest"] * bool(carry))
    of_wide = F.col("route") == F.col("h")
    windows = _joined(hot.join(wide, of_wide, "left_semi").mapInArrow(_cut, kind))
    segments = listed.mapInArrow(_segments, kind).unionByName(
        hot.join(wide, of_wide, "left_anti")).unionByName(windows)
    found = segments.withColumn("shard", F.pmod("route", F.lit(shards))).groupBy("shard").applyInArrow(
        _search, "k1 long, k2 int, least array<long>")
    places = listed.mapInArrow(_places, "doc_id long, mark int, k1 long, k2 int, start int")
    hits = places.join(found, ["k1", "k2"]).select(
        "doc_id", "mark", F.filter(
            F.transform("least", lambda v, i: F.when(v < F.col("doc_id"), F.col("start") + i)),
            lambda x: x.isNotNull()).alias("at")).where(F.size("at") > 0)
    # Equal rows of one id find the same places.
    hits = hits.groupBy("doc_id", "mark").agg(F.collect_set("at").alias("found"))
    return base, hits


def _with_windows(base, hits):
    """`base` with `windows`: the positions found for a row's own text."""
    return base.join(hits, ["doc_id", "mark"], "left").withColumn("windows", F.flatten("found"))


def _stay(texts, listed):
    """(windows, kept words) of a piece whose repeated windows are listed."""
    windows = Windows(texts)
    at, owner = listed
    edge = np.zeros(len(windows.start) + WINDOW + 1, np.int64)
    at = at.view(np.int64) + windows.first[owner]
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return windows, np.cumsum(edge)[:len(windows.start)] == 0


def dedup(docs, *, id_col="doc_id", text_col="text", with_text=False):
    """doc_id, n_words, n_removed, kept_sha256 of every row (and the `kept` text).

    Words are runs of bytes other than ASCII white space; the kept words are joined by one
    space. Null and empty texts have no words; texts under WINDOW words keep all.
    Rows that share a doc_id are judged apart and take nothing from one another;
    rows with a null id keep all words and take from none. Other columns are not read. An
    empty table gives an empty one.
    """
    base, hits = find_spans(docs, id_col=id_col, text_col=text_col)

    def run(batches):
        for batch in batches:
            for texts in pieces(batch.column(1)):
                windows, stay = _stay(texts, _listed(batch.column(2), texts.rows))
                data, begin = windows.joined()
                size = windows.end - windows.start + 1
                kept_bytes = data[np.repeat(stay, size)]
                sums = np.concatenate(([0], np.cumsum(size * stay)))[windows.first]
                view, words = memoryview(np.ascontiguousarray(kept_bytes)), np.diff(windows.first)
                kept = [bytes(view[a:max(a, b - 1)]) for a, b in zip(sums[:-1].tolist(), sums[1:].tolist())]
                counted = np.concatenate(([0], np.cumsum(stay)))[windows.first]
                columns = [
                    batch.column(0)[texts.rows], pa.array(words, pa.int64()),
                    pa.array(words - np.diff(counted), pa.int64()),
                    pa.array([hashlib.sha256(k).hexdigest() for k in kept])]
                names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
                if with_text:
                    columns.append(pa.array(kept, pa.binary()).cast(pa.string()))
                    names.append("kept")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return _with_windows(base, hits).select("doc_id", "text", "windows").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text)


def rewrite(docs, *, id_col="doc_id", text_col="text", length_col="n_chars"):
    """All rows and columns of `docs`; texts with repeated windows hold their kept words only.

    The kept words are joined by one space; `length_col`, if there is one, is set to the
    characters of such a text. Texts that keep all words stay as they are. A text that
    keeps none is empty; an empty table stays empty.
    """
    base, hits = find_spans(docs, id_col=id_col, text_col=text_col,
                            carry=[c for c in docs.columns if c != text_col])

    def run(batches):
        for batch in batches:
            for texts in pieces(batch.column(0)):
                windows, stay = _stay(texts, _listed(batch.column(1), texts.rows))
                data, begin = windows.joined()
                size = windows.end - windows.start + 1
                view = memoryview(np.ascontiguousarray(data[np.repeat(stay, size)]))
                sums = np.concatenate(([0], np.cumsum(size * stay)))[windows.first]
                gone = np.concatenate(([0], np.cumsum(~stay)))[windows.first]
                kept = [bytes(view[a:max(a, b - 1)]).decode("utf-8") if lost else None
                        for a, b, lost in zip(sums[:-1].tolist(), sums[1:].tolist(), np.diff(gone).tolist())]
                rows = slice(texts.rows.start, texts.rows.stop)
                cut = pa.array(kept, pa.string())
                whole = batch.column(0)[rows].cast(pa.string())
                text = pa.array([k if k is not None else w for k, w in zip(cut.to_pylist(), whole.to_pylist())],
                                pa.string())
                yield pa.RecordBatch.from_arrays(
                    [text, pa.array([k is not None for k in kept]), batch.column(2)[rows]],
                    names=["text", "cut", "rest"])

    joined = _with_windows(base, hits).select("text", "windows", "rest")
    kind = base.schema["rest"].dataType.simpleString()
    made = joined.mapInArrow(run, f"text string, cut boolean, rest {kind}")
    columns = []
    for name in docs.columns:
        if name == text_col:
            columns.append(F.col("text").alias(name))
        elif name == length_col:
            length = F.when(F.col("cut"), F.char_length("text")).otherwise(F.col("rest")[name])
            columns.append(length.cast(docs.schema[name].dataType).alias(name))
        else:
            columns.append(F.col("rest")[name].alias(name))
    return made.select(*columns)
