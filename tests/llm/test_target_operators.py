"""Resampling (11), the conversation prefix trie (12) and quality rules (13)."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import words
from tests.llm.data import awkward, empty, frame
from threadglean.llm import prefix_trie, quality_rules, resampling
from threadglean.llm.textbytes import pieces

LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def folded(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


# --- resampling

def features(text, max_n):
    w = LETTERS.findall(folded(text))
    return [" ".join(w[i:i + n]) for n in range(1, max_n + 1) for i in range(len(w) - n + 1)], len(w)


def resampled(docs, target, max_n=1, buckets=10_000, percent=10, least=20):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s = Counter(bucket(f) for _, t in docs for f in features(t, max_n)[0])
    t = Counter(bucket(f) for x in target for f in features(x, max_n)[0])
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    rows = []
    for i, text in docs:
        found, n = features(text, max_n)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t)))
                     for b in map(bucket, found))
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(found), weight, score, n])
    able = sorted((r for r in rows if r[0] is not None and r[4] >= least), key=lambda r: (-r[3], r[0], r[2], r[1]))
    ranks = defaultdict(list)
    for place, r in enumerate(able[:len(able) * percent // 100], 1):
        ranks[tuple(r)].append(place)
    return Counter((*r[:4], ranks[tuple(r)].pop() if ranks[tuple(r)] else None) for r in rows)


@pytest.mark.parametrize("max_n, head_words, percent", [(1, 32_768, 10), (1, 3, 45), (2, 40, 45), (3, 32_768, 45)])
def test_resampling_equals_brute_force(spark, monkeypatch, max_n, head_words, percent):
    rows = awkward()
    target = frame(spark, [(1, "w1 w2 W3 the of naïve", "s"), (2, rows[4][1], "s"), (3, None, "s")])
    head = resampling.head_of
    monkeypatch.setattr(resampling, "head_of", lambda t, **kw: head(t, head_words=head_words, **kw))
    got = resampling.resample(frame(spark, rows), target, max_n=max_n, buckets=500, percent=percent)
    want = resampled([r[:2] for r in rows], [r.text for r in target.collect()], max_n, 500, percent)
    assert Counter(tuple(r) for r in got.collect()) == want
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sum(r[4] is not None for r in want.elements()) > 2


def test_resampling_without_rows_or_target(spark):
    assert resampling.resample(empty(spark), empty(spark)).count() == 0
    rows = [(i, "some words " * 12, "s") for i in range(10)]
    got = resampling.resample(frame(spark, rows), empty(spark)).collect()
    assert sorted(r.rank for r in got if r.rank) == [1] and len(got) == 10


def test_crc_of_spans_and_joined_strings():
    rng = random.Random(3)
    strings = [bytes(rng.randrange(256) for _ in range(n)) for n in (0, 1, 2, 5, 63, 64, 65, 300, 5, 1)]
    data = np.frombuffer(b"".join(strings), np.uint8)
    end = np.cumsum([len(x) for x in strings])
    start = end - [len(x) for x in strings]
    crcs = resampling.crc_of_spans(data, start, end)
    assert crcs.tolist() == [zlib.crc32(x) for x in strings]
    some = [i for i, x in enumerate(strings) if x]
    joined = resampling.crc_joined(crcs[some], crcs[some[::-1]], (end - start)[some[::-1]])
    assert joined.tolist() == [zlib.crc32(strings[a] + strings[b]) for a, b in zip(some, some[::-1])]


def test_head_holds_frequent_words_and_changes_nothing(spark):
    texts = spark.createDataFrame([("the the of  the\nOF a-b a b a b",), ("x " * 400,)], "text string")
    head = resampling.head_of(texts, max_n=2, head_words=4)
    assert set(head.crcs.tolist()) == {zlib.crc32(w) for w in (b"x", b"a", b"b", b"the")}
    assert zlib.crc32(b"a b") % 10_000 in head.pair_buckets.tolist()
    (piece,) = pieces(texts.toArrow()["text"])
    for max_n in (1, 2, 3):
        with_head, without = (resampling._features(piece, h, 10_000, max_n) for h in (head, resampling.Head()))
        assert all((a == b).all() for a, b in zip(with_head, without))


# --- prefix trie

TURNS = "conv_id long, turn long, role string, text string, shard long, n long, own boolean, depth string"


def turn_frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, None, "d") for r in rows], TURNS).repartition(6)


def trie(rows):
    """Rows of the contract from (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), (role or "", text or "")))
    own = {c: [t for _, t in sorted(x, key=lambda y: y[0])] for c, x in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        seq = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + own[c][h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return Counter((m[0], len(p), members[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()) for p, m in members.items())


def conversations(seed, n=260, turns=7):
    """Conversations of few different turns, copies, gaps and nulls; no two turns tie."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        if rng.random() < 0.1:
            continue
        c = c * 7 if rng.random() < 0.1 else c
        if any(r[0] == c for r in rows):
            continue
        for t in range(rng.choice([1, 2, 3, turns])):
            turn = None if t == 0 and rng.random() < 0.2 else t
            text = None if rng.random() < 0.1 else rng.choice(["", "a", "bé漢", "hello there", "x" * 30])
            rows.append((c, turn, rng.choice(["user", "assistant", None]), text))
    same = [(0, "user", "same"), (1, "assistant", "words"), (2, "user", "again")]
    rows += [(5000 + c, *t) for c in range(150) for t in same]
    rows += [(2000, t, "user", f"turn {t}") for t in range(300)] + [(2001, t, "user", f"turn {t}") for t in range(290)]
    return rows + [(None, 1, "user", "lost"), (-5, 0, "user", "minus"), (-130, 1, "user", "minus")]


@pytest.mark.parametrize("shard_sequences", [1, 3, 4096])
def test_trie_equals_brute_force(spark, shard_sequences):
    rows = conversations(shard_sequences)
    got = prefix_trie.nodes(turn_frame(spark, rows), shard_sequences=shard_sequences)
    assert Counter(tuple(r) for r in got.collect()) == trie(rows)


def test_trie_of_hot_copies_and_a_shared_start(spark):
    rows = [(c, t, "user", f"same {t}" if t < 5 or c % 3 == 0 else f"own {c} {t}") for c in range(400) for t in range(7)]
    got = prefix_trie.nodes(turn_frame(spark, rows), shard_sequences=16)
    assert Counter(tuple(r) for r in got.collect()) == trie(rows)


def test_trie_of_no_and_turnless_conversations(spark):
    assert prefix_trie.nodes(turn_frame(spark, [])).count() == 0
    assert prefix_trie.nodes(turn_frame(spark, [(None, 1, "user", "x")])).count() == 0
    # Conversation 5 has one turn, gives it up (h > 0), and its family has no first one.
    c = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 >= 1)
    got = prefix_trie.nodes(turn_frame(spark, [(c, 0, "user", "gone")])).collect()
    assert [tuple(r)[:7] for r in got] == [(c, 0, None, 1, 0, 1, 0)]
    assert Counter(map(tuple, got)) == trie([(c, 0, "user", "gone")])


def test_ties_and_repeated_rows_are_turns_of_their_own(spark):
    rows = [(100, 1, "user", "b"), (100, 1, "user", "a"), (100, 1, "user", "a")]
    got = prefix_trie.nodes(turn_frame(spark, rows))
    assert got.where("depth = 3").count() == 1 and got.count() == 4


def test_double_array_holds_what_was_added():
    rng = np.random.default_rng(5)
    sequences = sorted({tuple(rng.integers(0, 6, rng.integers(0, 9)).tolist()) for _ in range(400)})
    trie_, state = prefix_trie.DoubleArray(4), {(): 0}
    for depth in range(8):
        pairs = sorted({(state[s[:depth]], s[depth]) for s in sequences if len(s) > depth})
        if pairs:
            trie_.grow(*np.array(pairs).T)
        for s in sequences:
            if len(s) > depth:
                state[s[:depth + 1]] = int(trie_.step(np.array([state[s[:depth]]]), np.array([s[depth]]))[0])
    assert len(set(state.values())) == len(state) and min(state.values()) == 0
    for s in sequences:
        for c in range(7):
            found = trie_.step(np.array([state[s]]), np.array([c]))[0]
            assert found == state.get(s + (c,), -1)


# --- quality rules

def rules(text):
    w, text = words(text), text or ""
    spans = defaultdict(list)
    for i in range(len(w) - 2):
        spans[tuple(w[i:i + 3])].append(i)
    covered = {j for at in spans.values() if len(at) > 1 for i in at for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if words(x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
            len(covered), failed)


def grams(text):
    c = [zlib.crc32(w.encode()) for w in words(text)]
    n, f = quality_rules.BUCKETS, quality_rules.PAIR_FACTOR
    return [x % n for x in c] + [(x * f + y) % n for x, y in zip(c, c[1:])]


def odd_texts():
    rng = random.Random(4)
    lines = ["a b c", "", " \t", "| x ** 5 & <b>", "déjà 漢字 ##", "a b c", "\x0b\x0c\r"]
    out = [(200 + i, "\n".join(rng.choice(lines) for _ in range(rng.randrange(40))), "s") for i in range(40)]
    return out + [(300, "word " * 20_000, "s"), (301, "\n" * 5_000, "s"), (302, "a b a b c a b c d " * 9, "s")]


def test_rules_equal_brute_force(spark):
    rows = awkward() + odd_texts()
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(60)] + [(None, 1), (4, 1)],
                                   "doc_id long, quality int")
    trusted = quality_rules.trusted_ids(labels)
    ids = {r.doc_id for r in trusted.collect()}
    assert ids == set(range(0, 60, 2))
    held = {r.doc_id for r in trusted.collect() if r.held}
    assert held == {i for i in ids if ord(hashlib.md5(str(i).encode()).hexdigest()[-1]) % 2}
    gains, bar = fitted = quality_rules.fit(docs, trusted)
    s = Counter(b for _, t, _ in rows for b in grams(t))
    t = Counter(b for i, x, _ in rows if i in ids - held for b in grams(x))
    n = quality_rules.BUCKETS
    want = [math.floor(1000 * math.log((t[b] + 1) * (sum(s.values()) + n) / ((s[b] + 1) * (sum(t.values()) + n))))
            for b in range(n)]
    assert gains == want
    levels = sorted(sum(want[b] for b in grams(x)) // len(grams(x)) for i, x, _ in rows if i in held and not rules(x)[5])
    assert bar == levels[len(levels) * 5 // 1000]
    expected = Counter()
    for i, text, _ in rows:
        base, found = rules(text), grams(text)
        gain = sum(want[b] for b in found)
        kept = not base[5] and gain >= bar * len(found)
        expected[(i, *base, len(found), gain, kept)] += 1
    got = quality_rules.judge(docs, fitted)
    assert Counter(tuple(r) for r in got.collect()) == expected
    kept = quality_rules.keep_good(docs, fitted)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(
        x[0] for x in expected.elements() if x[-1])


def test_rules_use_a_bounded_number_of_trusted_documents(spark):
    labels = spark.createDataFrame([(i, 1) for i in range(100)], "doc_id long, quality int")
    got = [r.doc_id for r in quality_rules.trusted_ids(labels, max_trusted=7).collect()]
    assert got == sorted(range(100), key=lambda i: (hashlib.md5(str(i).encode()).hexdigest(), i))[:7]


def test_rules_use_all_trusted_documents(spark):
    n = quality_rules.MAX_TRUSTED + 500
    labels = spark.range(n).selectExpr("id as doc_id", "1 as quality")
    trusted = quality_rules.trusted_ids(labels)
    assert trusted.count() == n
    docs = spark.range(n).selectExpr("id as doc_id", "concat('w', id % 7, repeat(' x', 60 + cast(id % 5 as int))) as text")
    gains, bar = quality_rules.fit(docs, trusted)
    held = {r.doc_id for r in trusted.where("held").collect()}
    texts = {i: f"w{i % 7}" + " x" * (60 + i % 5) for i in range(n)}
    t = Counter(b for i, x in texts.items() if i not in held for b in grams(x))
    s = Counter(b for x in texts.values() for b in grams(x))
    k = quality_rules.BUCKETS
    assert gains == [math.floor(1000 * math.log((t[b] + 1) * (s.total() + k) / ((s[b] + 1) * (t.total() + k))))
                     for b in range(k)]
    assert quality_rules._bar([{"level": 3, "n": 1}, {"level": -2, "n": 5}, {"level": 9, "n": 1994}]) == 9
    assert quality_rules._bar([{"level": 3, "n": 6}, {"level": -2, "n": 5}, {"level": 9, "n": 1989}]) == 3


def test_rules_join_few_texts_and_store_none_to_find_the_trusted(spark, monkeypatch):
    rng = random.Random(8)
    n, vocabulary = 4_000, ["".join(rng.choices("abcdefghijklmnop", k=3)) for _ in range(60)]
    texts = {i: " ".join(rng.choices(vocabulary, k=300)) for i in range(n)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4).localCheckpoint()
    labels = spark.createDataFrame([(i, 1) for i in range(0, n, 20)], "doc_id long, quality int")
    trusted = quality_rules.trusted_ids(labels).localCheckpoint()
    held = {r.doc_id for r in trusted.where("held").collect()}
    stored, store, joined, join = [], quality_rules.cut_lineage, [], getattr(quality_rules, "_among", None)
    monkeypatch.setattr(quality_rules, "cut_lineage", lambda df: stored.append(df.columns) or store(df))
    monkeypatch.setattr(quality_rules, "_among", lambda df, ids: joined.append((df.columns, df.count())) or join(df, ids),
                        raising=False)
    gains, bar = quality_rules.fit(docs, trusted)
    assert stored == [["doc_id", "held"]]
    assert [columns for columns, _ in joined] == [["doc_id", "text"], ["doc_id", "level"]]
    assert sum(rows for _, rows in joined) <= n // 20 + 5
    fitting = set(range(0, n, 20)) - held
    t, s = Counter(b for i in fitting for b in grams(texts[i])), Counter(b for x in texts.values() for b in grams(x))
    k = quality_rules.BUCKETS
    want = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + k) / ((s[b] + 1) * (t.total() + k)))) for b in range(k)]
    levels = sorted(sum(want[b] for b in grams(texts[i])) // len(grams(texts[i])) for i in held if not rules(texts[i])[5])
    assert gains == want and bar == levels[len(levels) * 5 // 1000]


@pytest.mark.parametrize("bits", [15, quality_rules.FILTER_BITS])
def test_rules_filter_keeps_all_trusted_rows(spark, monkeypatch, bits):
    """A filter that is full lets others through, and the exact join drops them."""
    monkeypatch.setattr(quality_rules, "FILTER_BITS", bits)
    docs = spark.range(-20_000, 40_000).selectExpr("id as doc_id", "id % 7 as n").union(
        spark.createDataFrame([(None, 1), (3, 2), (4, 2)], "doc_id long, n long"))
    ids = spark.range(-30_000, 30_000, 3).selectExpr("id as doc_id")
    near = quality_rules.maybe_among(docs, ids)
    want = Counter((i, i % 7 if i >= 0 else -(-i % 7)) for i in range(-20_000, 30_000) if i % 3 == 0) + Counter([(3, 2)])
    assert near.columns == docs.columns
    assert Counter(map(tuple, quality_rules._among(near, ids).collect())) == want
    assert want.total() <= near.count() < (docs.count() if bits == 15 else 1.01 * want.total())
    assert quality_rules.maybe_among(docs, ids.limit(0)).count() == 0


def test_rules_without_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    gains, bar = fitted = quality_rules.fit(empty(spark), quality_rules.trusted_ids(labels))
    assert set(gains) == {0} and bar is None and quality_rules.judge(empty(spark), fitted).count() == 0


def test_verdicts_on_labelled_documents(spark):
    """Fitted on one half of the labelled documents, judged on the other."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id < 6000")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    fitted = quality_rules.fit(docs, quality_rules.trusted_ids(labels.where("doc_id % 2 = 0")))
    told = quality_rules.judge(docs, fitted).where("not base_failed").join(labels.where("doc_id % 2 = 1"), "doc_id")
    share = {r.quality: r.share for r in told.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert share[1] > 0.98 and share[0] < 0.1
