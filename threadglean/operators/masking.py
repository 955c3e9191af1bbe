"""Masking by a lexicon held in a table (E1), of any number of words and phrases.

`functions.text.mask_pattern` puts a whole lexicon into one pattern, which suits
thousands of words. Here a text is cut into word runs, and its runs (and rows of runs, as
long as the lexicon's phrases) are looked up in the lexicon: in a copy on each executor
while the lexicon is small, else by a shuffled join of slim rows. A text is then masked by
a pattern of the entries found in it and of the fixed spellings, so the result is that of
one pattern of the whole lexicon.
"""

from pyspark.sql import functions as F

from threadglean import constants as K
from threadglean.functions.text import _WORD
from threadglean.operators import scale

# Word runs by which a phrase is looked up; longer phrases by their first ones.
PHRASE_WORDS = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FIXED = "|".join(K.OBFUSCATION_PATTERNS)
_FIXED_AHEAD = "(?=[" + "".join(K.OBFUSCATION_FIRST_LETTERS) + "])"


def _folded(text):
    """A-Z in lower case; other letters are matched as they are listed."""
    return F.translate(text, _UPPER, _LOWER)


def _runs(text):
    return F.regexp_extract_all(text, F.lit(f"({_WORD}+)"), F.lit(1))


def lexicon_entries(lexicon, word_col="word"):
    """key, n_runs, kind and word of each distinct word or phrase of a lexicon, with the fixed extra
    words and without the fixed false positives.

    `key` joins the word runs by one space; `kind` tells by two bits whether the word starts
    and ends within a run.
    """
    extra = lexicon.sparkSession.createDataFrame([(w,) for w in K.EXTRA_MASKED_WORDS], "word string")
    words = (lexicon.select(F.col(word_col).cast("string").alias("word")).unionByName(extra)
             .select(_folded("word").alias("word"))
             .where((F.col("word") != "") & ~F.col("word").isin(K.NEVER_MASKED_WORDS)).distinct())
    starts, ends = (F.col("word").rlike(x).cast("int") for x in (f"^{_WORD}", f"{_WORD}\\z"))
    runs = F.slice(_runs(F.col("word")), 1, PHRASE_WORDS)
    return words.select(F.array_join(runs, " ").alias("key"), F.size(runs).alias("n_runs"),
                        (starts * 2 + ends).alias("kind"), "word")


def _pattern(entries):
    """The pattern of the entries (kind, word) of one text, tried as a pattern of the whole lexicon
    tries them: by kind, the longest first. Words of a kind share their boundaries, so most
    places of a text are passed by after one look."""
    parts = []
    for kind in (3, 2, 1, 0):
        before = f"(?<!{_WORD})" if kind & 2 else f"(?<={_WORD})"
        after = f"(?!{_WORD})" if kind & 1 else f"(?={_WORD})"
        own = F.sort_array(F.transform(
            _of_kind(entries, kind), lambda e: F.struct(-F.char_length(e["word"]), e["word"].alias("word"))))
        words = F.transform(own, lambda e: F.concat(
            F.lit(r"\Q"), F.replace(e["word"], F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E")))
        listed = F.array_join(words, "|")
        parts.append(F.when(listed != "", F.concat(F.lit(before + "(?:"), listed, F.lit(")" + after))))
    return F.concat(F.lit("(?i)(?:"), F.concat_ws("|", *parts, F.lit(_FIXED)), F.lit(")"))


def _of_kind(entries, kind):
    return F.filter(entries, lambda e: e["kind"] == kind)


def _rows_of(runs, n):
    """All rows of `n` word runs, joined by one space."""
    if n == 1:
        return runs
    names = [f"r{i}" for i in range(n)]
    rows = F.arrays_zip(*[F.slice(runs, i + 1, 2**30).alias(name) for i, name in enumerate(names)])
    whole = F.filter(rows, lambda z: z[names[-1]].isNotNull())
    return F.transform(whole, lambda z: F.concat_ws(" ", *[z[name] for name in names]))


def _looked_up(runs, sizes):
    """All rows of so many word runs of a text, each once."""
    return F.array_distinct(F.concat(*[_rows_of(runs, n) for n in sizes]))


def mask_by_lookup(df, text_col, lexicon, word_col="word", *, pinned=scale.NARROW_PIN_ROWS):
    """`df` with the words and phrases of a lexicon table masked in `text_col`.

    A lexicon of up to `pinned` rows goes to all executors, a larger one is joined by a
    shuffle of (text digest, word runs). Entries without any letter or digit
    can't be looked up and join the pattern of every text: at most scale.PIN_MAX_ROWS.
    Equal texts are looked up once; a null text stays null.
    """
    entries = scale.cut_lineage(lexicon_entries(lexicon, word_col))
    sizes = sorted(r.n_runs for r in entries.where("n_runs > 0").select("n_runs").distinct().collect())
    bare = [r.word for r in entries.where("n_runs = 0").select("word").limit(scale.PIN_MAX_ROWS + 1).collect()]
    if len(bare) > scale.PIN_MAX_ROWS:
        raise ValueError(f"more than {scale.PIN_MAX_ROWS} lexicon entries without a letter or digit")
    text = F.col(text_col)
    digests = ["__d1", "__d2"]
    marked = df.select("*", *[F.when(text.isNotNull(), F.xxhash64(F.lit(i), text)).alias(d)
                              for i, d in enumerate(digests)])
    asked = marked.where(text.isNotNull()).select(
        *digests, F.explode(_looked_up(_runs(_folded(text)), sizes)).alias("key"))
    found = scale.lookup_join(asked, entries.where("n_runs > 0").select("key", "kind", "word"), "key", "inner",
                              digests, max_rows=pinned)
    hits = found.groupBy(*digests).agg(F.collect_set(F.struct("kind", "word")).alias("__hits"))
    joined = scale.skew_join(marked, hits, digests, "left", spread=_spread(df))
    listed = F.col("__hits")
    if bare:
        always = F.array(*[F.struct(F.lit(0).alias("kind"), F.lit(w).alias("word")) for w in bare])
        listed = F.coalesce(F.concat("__hits", always), always)
    pattern = F.when(listed.isNull(), F.lit(f"(?i){_FIXED_AHEAD}(?:{_FIXED})")).otherwise(_pattern(listed))
    masked = F.regexp_replace(text, pattern, F.lit(K.MASK))
    return joined.select(*[masked.alias(c) if c == text_col else F.col(c) for c in df.columns])


def _spread(df):
    """Columns that deal out the rows of one text: all that can be hashed."""
    return [f.name for f in df.schema.fields if f.dataType.typeName() != "map"]
