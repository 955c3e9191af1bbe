"""Toxicity (1) by a chain of linear classifiers.

Categories are predicted one after another; the probability of each earlier
category is a feature of the later ones. While training, these probabilities come out
of fold: from models that have not seen the row, so later models learn to
trust them as far as they hold on new rows.

Features are distinct lower-cased words and word beginnings of 3 to 6 bytes, hashed
to 2**BITS places; each category keeps those that tell its classes apart best (by
chi-square, and with LEAST_CHI at least), counted over the whole training sample on the
executors.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from threadglean.llm.textbytes import LOWER, NOT_LETTER, pieces

BITS = 20
BEGINNINGS = (3, 4, 5, 6)
LEAST_CHI = 6.0  # by chance in about one of 70 features


def text_features(texts):
    """(place, owner): the distinct hashed features of each text of a piece."""
    start, end, first = texts.words(NOT_LETTER)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    found = [(texts.hashes(start, end, LOWER), owner)]
    for n in BEGINNINGS:
        longer = np.flatnonzero(end - start > n)
        hashed = texts.hashes(start[longer], start[longer] + n, LOWER)
        found.append((hashed * np.uint64(2 * n + 1) + np.uint64(n), owner[longer]))
    place = np.concatenate([h >> np.uint64(64 - BITS) for h, _ in found]).astype(np.int64)
    pairs = np.unique(np.concatenate([o for _, o in found]) << BITS | place)
    return pairs & ((1 << BITS) - 1), pairs >> BITS


@dataclass
class Chain:
    """`places` of chosen features; for each category its bias, weights, chain weights."""

    categories: list
    places: np.ndarray
    models: list

    def probabilities(self, place, owner, n):
        """One column per category for `n` texts with these features."""
        slots = np.full(1 << BITS, -1, np.int32)
        slots[self.places] = np.arange(len(self.places))
        slot = slots[place]
        known = slot >= 0
        slot, owner = slot[known], owner[known]
        out = []
        for bias, weights, chained in self.models:
            logit = bias + np.bincount(owner, weights[slot], n)
            for p, w in zip(out, chained):
                logit = logit + w * p
            out.append(1 / (1 + np.exp(-np.clip(logit, -40, 40))))
        return out


def fit_logistic(index, owner, extra, y, width, penalty=0.1, steps=400):
    """(bias, weights, extra weights) of an L2-penalised logistic regression.

    Rows are sparse 0/1 features (`index` of row `owner`) and dense `extra`
    columns. A class that does not occur gives a constant.
    """
    n, k = len(y), len(extra)
    rate = y.mean() if n else 0.0
    if rate in (0.0, 1.0):
        return (40.0 if rate else -40.0), np.zeros(width), np.zeros(k)
    theta = np.zeros(width + k + 1)
    theta[-1] = np.log(rate / (1 - rate))
    dense = np.array(extra).reshape(k, n)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        logit = theta[-1] + np.bincount(owner, theta[index], n) + theta[width:-1] @ dense
        off = 1 / (1 + np.exp(-np.clip(logit, -40, 40))) - y
        grad = np.concatenate((np.bincount(index, off[owner], width), dense @ off, [off.sum()]))
        grad[:-1] += penalty * theta[:-1]
        grad /= n
        m += 0.1 * (grad - m)
        v += 0.01 * (grad * grad - v)
        theta -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return theta[-1], theta[:width], theta[width:-1]


def train(docs, labels, categories, *, id_col="doc_id", text_col="text", max_rows=8192,
          features=512, folds=5, min_rows=3, seed=5):
    """A `Chain` for `categories`: (name, 0/1 expression over `labels`) in chain order.

    At most `max_rows` labelled documents, chosen by a hash of their id, are
    used; that bounds what reaches the driver. A document labelled more than
    once has a category if any label says so; rows with a null label or id are not used.
    Without labels, or documents, the probability of every category is 0. `features` hashed
    features with `min_rows` texts each, the ones that tell most, enter a model;
    `folds` is the number of parts for out-of-fold probabilities.
    """
    names = [name for name, _ in categories]
    marked = labels.select(F.col(id_col).cast("long").alias("id"),
                           *[F.expr(e).cast("int").alias(f"y{i}") for i, (_, e) in enumerate(categories)])
    marked = marked.dropna().groupBy("id").agg(
        *[F.max(f"y{i}").alias(f"y{i}") for i in range(len(names))])
    chosen = marked.orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(max_rows).toArrow()
    spark = docs.sparkSession
    if not chosen.num_rows:
        return Chain(names, np.zeros(0, np.int64), [(-40.0, np.zeros(0), np.zeros(i)) for i in range(len(names))])
    chosen = spark.createDataFrame(chosen, marked.schema)
    sample = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(chosen), "id")
    k = len(names)

    def count(batches):
        for batch in batches:
            y = np.array([batch.column(2 + i).to_numpy() for i in range(k)]).T
            for texts in pieces(batch.column(1)):
                place, owner = text_features(texts)
                own = y[texts.rows][owner]
                seen = np.unique(place)
                at = np.searchsorted(seen, place)
                sums = [np.bincount(at, minlength=len(seen))]
                sums += [np.bincount(at, own[:, i], len(seen)).astype(np.int64) for i in range(k)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seen, pa.int64()), *[pa.array(s, pa.int64()) for s in sums]],
                    names=["place", "n", *[f"n{i}" for i in range(k)]])

    counted = sample.mapInArrow(count, "place long, n long" + "".join(f", n{i} long" for i in range(k)))
    counted = counted.groupBy("place").agg(
        F.sum("n").alias("n"), *[F.sum(f"n{i}").alias(f"n{i}") for i in range(k)])
    totals = sample.agg(F.count("*"), *[F.coalesce(F.sum(f"y{i}"), F.lit(0)) for i in range(k)]).first()
    rows = totals[0]
    own = []
    counted = counted.where(F.col("n") >= min_rows).persist()
    for i in range(k):
        # Chi-square of the 2 x 2 table feature x class.
        a, n, pos = F.col(f"n{i}"), F.col("n"), float(totals[1 + i])
        spread = n * (rows - n) * pos * (rows - pos)
        chi = F.when(spread > 0, rows * (a * float(rows) - n * pos) ** 2 / spread).otherwise(0)
        best = counted.select("place", chi.alias("chi")).where(F.col("chi") >= LEAST_CHI)
        own.append([r[0] for r in best.orderBy(F.desc("chi"), "place").limit(features).collect()])
    counted.unpersist()
    places = np.array(sorted(set().union(*own)), np.int64)

    def hits(batches):
        slots = np.full(1 << BITS, -1, np.int32)
        slots[places] = np.arange(len(places))
        for batch in batches:
            for texts in pieces(batch.column(1)):
                place, owner = text_features(texts)
                slot = slots[place]
                owner, slot = owner[slot >= 0], slot[slot >= 0]
                ends = np.searchsorted(owner, np.arange(len(texts) + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[texts.rows],
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(slot, pa.int32())),
                     *[batch.column(2 + i)[texts.rows] for i in range(k)]],
                    names=["id", "hit", *[f"y{i}" for i in range(k)]])

    table = sample.mapInArrow(
        hits, "id long, hit array<int>" + "".join(f", y{i} int" for i in range(k))
    ).toArrow().sort_by("id").combine_chunks()
    sizes = np.array([len(h) for h in table["hit"]], np.int64)
    all_owner = np.repeat(np.arange(len(sizes)), sizes)
    all_index = np.array([p for h in table["hit"] for p in h.as_py()], np.int64)
    ids = np.asarray(table["id"]).astype(np.uint64)
    fold = ((ids * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % folds
    earlier, models = [], []
    for i in range(k):
        y = np.asarray(table[f"y{i}"]).astype(float)
        mine = np.isin(all_index, np.searchsorted(places, own[i]))
        index, owner = all_index[mine], all_owner[mine]
        models.append(fit_logistic(index, owner, earlier, y, len(places)))
        out = np.zeros(len(y))
        for f in range(folds if i + 1 < k else 0):
            rest = fold != f
            order = np.cumsum(rest) - 1
            used = rest[owner]
            bias, weights, chained = fit_logistic(
                index[used], order[owner[used]], [e[rest] for e in earlier], y[rest], len(places))
            logit = bias + np.bincount(owner, weights[index], len(y)) + sum(
                w * e for w, e in zip(chained, earlier))
            out = np.where(rest, out, 1 / (1 + np.exp(-np.clip(logit, -40, 40))))
        earlier.append(out)
    return Chain(names, places, models)


def score(docs, chain, *, id_col="doc_id", text_col="text", threshold=0.5):
    """doc_id, p_<category> of each category and `rejected` (the last one's verdict).

    Whole texts are scored. Rows that repeat, and null ids, are kept; a null or empty
    text has no feature and is not rejected. Other columns are not read. An empty table
    gives an empty one.
    """
    names = [f"p_{name}" for name in chain.categories]

    def run(batches):
        for batch in batches:
            for texts in pieces(batch.column(1)):
                p, rejected = _verdict(texts, chain, threshold)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[texts.rows], *[pa.array(x) for x in p], pa.array(rejected)],
                    names=["doc_id", *names, "rejected"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(
        run, ", ".join(["doc_id long", *[f"{n} double" for n in names], "rejected boolean"]))


def _verdict(texts, chain, threshold):
    place, owner = text_features(texts)
    p = chain.probabilities(place, owner, len(texts))
    some = np.bincount(owner, minlength=len(texts)) > 0
    return p, (p[-1] >= threshold) & some


def keep_clean(docs, chain, *, text_col="text", threshold=0.5):
    """The rows of `docs`, all columns as they are, that the chain does not reject; an empty
    table stays empty."""
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for texts in pieces(batch.column(at)):
                keep[texts.rows] = ~_verdict(texts, chain, threshold)[1]
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
