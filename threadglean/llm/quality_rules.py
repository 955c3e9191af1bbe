"""Quality rules (13), with DataFrame functions only.

Base rules count words, symbols, repeated lines and repeated 3-word windows of a text. A
text that passes them is judged by a log-likelihood ratio: its words and word pairs are
hashed into BUCKETS, and each bucket has a gain, floor(1000 * ln(share among the grams of
trusted documents / share among the grams of the whole corpus)), both with one added. The
sum of gains, divided by the number of grams, must reach a bar, so texts of any length face
the same one. Half of the trusted documents give the gains, the other half the bar: the
level that all of those but HELD_LOW in a thousand reach. Halves are taken by a
digest of the id; the same tables always give the same verdict on every document.

All trusted documents take part, unless the caller sets a bound. Everything about one text is
worked out inside its row. Trusted rows are found in two steps: a filter of fixed size goes to
all tasks and leaves the rows whose ids may be trusted, then a join by id is exact. Only the
texts of the half that gives the gains are shuffled for it, and levels in place of the texts of
the other half. Only the filter (2 ** FILTER_BITS bits), counts of buckets (BUCKETS rows at most)
and of levels (one row for each thousandth of a nat, so some ten thousands at most) leave the executors.
"""

import math

import numpy as np
from pyspark.sql import functions as F

from threadglean.operators.scale import cut_lineage

BUCKETS = 65_536
HELD_LOW = 5          # held-out trusted documents in a thousand that stay below the bar
MAX_TRUSTED = 8_192   # the bound in the SQL of the query, which itself has none
PAIR_FACTOR = 1_000_003
FILTER_BITS = 25      # 4 MB; 2.5 million ids let 7 % of the other rows through, more ids more of them

# Places in one of Spark's bitmaps, white space that parts words, and the symbols that are counted.
BITMAP_PLACES = 32_768
LOOKED_UP = 64        # repeated windows of a text that are looked up one by one; with more, all are sorted
WHITE = "[ \\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]"


def _let(value, body):
    """`body(value)` with `value` worked out once per row."""
    return F.transform(F.array(value), body)[0]


def words_of(text):
    """The runs of characters other than ASCII white space."""
    return F.filter(F.split(text, WHITE), lambda w: w != "")


def _next(values, by=1):
    """The list from `by` places on; the length must not overflow when the start is added."""
    return F.slice(values, by + 1, 2**30)


def _windows(values, width, body):
    """`body` of each `width` neighbours in the list."""
    starts = F.slice(values, 1, F.greatest(F.size(values) - (width - 1), F.lit(0)))
    return F.transform(starts, lambda v, i: body(v, *[F.get(values, i + j) for j in range(1, width)]))


def gram_buckets(words):
    """The bucket of each word, by its crc32, and of each pair of words in a row, by both."""
    def grams(crcs):
        return F.concat(F.transform(crcs, lambda c: c % BUCKETS),
                        _windows(crcs, 2, lambda a, b: (a * PAIR_FACTOR + b) % BUCKETS))

    return _let(F.transform(words, lambda w: F.crc32(w.cast("binary"))), grams)


def repeat_words(words, width=3):
    """Words inside windows of `width` words that stand in the text twice or more.

    Windows are told apart by 64-bit hashes within their text. Most texts repeat none or few,
    which a sort of the hashes alone tells; only windows of those are then sorted with their places.
    """
    def covered(windows):
        """Equal windows are neighbours once sorted; their places cover words from left to right."""
        twins = F.filter(F.arrays_zip(windows.alias("x"), _next(windows).alias("y")),
                         lambda z: z["x"]["h"] == z["y"]["h"])
        places = F.sort_array(F.array_distinct(F.flatten(
            F.transform(twins, lambda z: F.array(z["x"]["at"], z["y"]["at"])))))
        return _let(places, lambda p: F.aggregate(
            F.arrays_zip(p.alias("now"), _next(p).alias("next")), F.lit(0).cast("long"),
            lambda n, z: n + F.least(F.coalesce(z["next"] - z["now"], F.lit(width)), F.lit(width))))

    def counted(windows, repeated):
        placed = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at")))
        near = F.filter(placed, lambda z: (F.size(repeated) > LOOKED_UP) | F.array_contains(repeated, z["h"]))
        return F.when(F.size(repeated) > 0, _let(F.sort_array(near), covered)).otherwise(F.lit(0).cast("long"))

    def repeats(windows):
        twins = _let(F.sort_array(windows), lambda x: F.filter(x, lambda h, i: h == F.get(x, i + 1)))
        return _let(F.array_distinct(twins), lambda repeated: counted(windows, repeated))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return _let(_let(hashes, lambda h: _windows(h, width, F.xxhash64)), repeats)


def dup_lines(text):
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^ \\x09-\\x0D]"))
    return _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def _buckets(docs, text_col):
    words = words_of(F.coalesce(F.col(text_col), F.lit("")))
    return docs.select(F.explode(_let(words, gram_buckets)).alias("bucket"))


def _counts(docs, text_col):
    """Grams per bucket as an array of BUCKETS numbers."""
    found = _buckets(docs, text_col).groupBy("bucket").agg(F.count("*").alias("n")).toArrow()
    out = np.zeros(BUCKETS, np.int64)
    out[np.asarray(found["bucket"])] = np.asarray(found["n"])
    return out


def trusted_ids(labels, *, id_col="doc_id", good="quality = 1", max_trusted=None):
    """doc_id, held: the ids of all trusted documents, or the `max_trusted` ones with the least md5;
    `held` tells the half that sets the bar."""
    ids = labels.where(good).select(F.col(id_col).cast("long").alias("doc_id")).dropna().distinct()
    marked = ids.withColumn("digest", F.md5(F.col("doc_id").cast("string").cast("binary")))
    if max_trusted is not None:
        marked = marked.orderBy("digest", "doc_id").limit(max_trusted)
    return marked.select("doc_id", (F.ascii(F.right("digest", F.lit(1))) % 2 == 1).alias("held"))


def maybe_among(docs, ids):
    """The rows of `docs` whose doc_id is among `ids`, and a few more.

    The ids are sent as one bit each, at a place given by their hash, so that the filter has
    the same size for any number of them.
    """
    place = F.xxhash64("doc_id").bitwiseAND(F.lit(2**FILTER_BITS - 1))
    part, bit = F.floor(place / BITMAP_PLACES), place % BITMAP_PLACES
    bitmaps = ids.groupBy(part.alias("__part")).agg(F.bitmap_construct_agg(bit).alias("__bits"))
    byte = F.substring("__bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))
    known = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (bit % 8).cast("int")) == 1
    return docs.withColumn("__part", part).join(F.broadcast(bitmaps), "__part").where(known).select(*docs.columns)


def _among(docs, ids):
    """The rows of `docs` whose doc_id is among `ids`, by a shuffle without a sort of the rows."""
    return docs.join(ids.hint("shuffle_hash"), "doc_id")


def fit(docs, trusted, *, id_col="doc_id", text_col="text"):
    """(gains, bar): the gain of each bucket, and the least gain per gram, in thousandths of a nat.

    `trusted` is the frame of trusted_ids(); it is stored, for it is read four times.
    Without held-out documents the bar is None, and the base rules alone decide.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    stored = cut_lineage(trusted)
    fitting, held = [stored.where(test).select("doc_id") for test in ("not held", "held")]

    raw, target = _counts(slim, "text"), _counts(_among(maybe_among(slim, fitting), fitting), "text")
    s, t = int(raw.sum()) + BUCKETS, int(target.sum()) + BUCKETS
    gains = [math.floor(1000 * math.log((b + 1) * s / ((a + 1) * t))) for a, b in zip(raw.tolist(), target.tolist())]
    # Failed rows are dropped at the end, not by a filter, which would work the verdict out once more.
    level = F.when(~F.col("base_failed"), F.floor(F.col("gain") / F.col("n_grams")))
    judged = judge(maybe_among(slim, held), (gains, None)).select("doc_id", level.alias("level"))
    levels = _among(judged, held).groupBy("level").agg(F.count("*").alias("n"))
    return gains, _bar([r for r in levels.toArrow().to_pylist() if r["level"] is not None])


def _bar(levels):
    """The level that all but HELD_LOW in a thousand reach, from the documents of each level."""
    place = sum(r["n"] for r in levels) * HELD_LOW // 1000
    for r in sorted(levels, key=lambda r: r["level"]):
        place -= r["n"]
        if place < 0:
            return r["level"]
    return None


def judge(docs, fitted, *, id_col="doc_id", text_col="text"):
    """The id of every row with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, n_grams, gain (the sum) and kept. `fitted` comes from fit().

    A null or empty text has no words, so it fails the base rules. Rows are judged
    alone: repeated rows and ids get equal rows, a null id is handed on. Other columns
    are not read. An empty table gives an empty one, and gains of an empty corpus are 0.
    """
    gains, bar = fitted
    # Folded to one literal, which goes to the tasks with their code.
    table = F.split(F.lit(",".join(map(str, gains))), ",").cast("array<long>")
    text = F.coalesce(F.col(text_col), F.lit(""))

    def measures(words):
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
            repeat_words(words).alias("n_repeat_words"),
            _let(gram_buckets(words), lambda b: F.struct(
                F.size(b).cast("long").alias("n"),
                F.aggregate(b, F.lit(0).cast("long"), lambda total, k: total + F.get(table, k.cast("int"))).alias("gain"),
            )).alias("grams"))

    measured = docs.select(
        F.col(id_col), _let(words_of(text), measures).alias("m"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        dup_lines(text).alias("n_dup_lines"))
    n = F.col("m.n_words")
    failed = (n < 50) | (F.col("m.n_repeat_words") * 100 > n * 50)
    passed = F.lit(True) if bar is None else F.col("m.grams.gain") >= F.col("m.grams.n") * bar
    return measured.select(
        id_col, n.alias("n_words"), "m.word_chars", "n_symbols", "n_dup_lines",
        F.col("m.n_repeat_words").alias("n_repeat_words"), failed.alias("base_failed"),
        F.col("m.grams.n").alias("n_grams"), F.col("m.grams.gain").alias("gain"),
        (~failed & passed).alias("kept"))


def keep_good(docs, fitted, *, text_col="text"):
    """The rows of `docs` that judge() keeps, with all their columns."""
    marked = docs.select(F.struct(*docs.columns).alias("__row"), F.col(text_col).alias("__text"))
    judged = judge(marked, fitted, id_col="__row", text_col="__text")
    return judged.where("kept").select("__row.*")
