"""Token counts (5), entropy-coded ids (8), byte-level BPE (9), substring dedup (4), shingle join (10)."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers as P
import regex
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import brute
from tests.llm.data import awkward, empty, frame
from threadglean.llm import fm_dedup, jaccard_join, merge_replay, rans, textbytes, token_counts
from threadglean.llm.components import components

ALPHABET = list("ab's't're ve ll  d\n\n\t 12!? é×ÿɏ…　\x1c\x85_''<|>▁😀") + [
    " '", "'ll", "  ", "\r\n", "¿", "<|endoftext|>", "</s>", "the"]


def odd_texts(n, seed=2):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def tuples(df):
    return Counter(tuple(r) for r in df.collect())


def test_pretokens_follow_the_pattern():
    texts, pattern = odd_texts(20_000) + [None, "", "'s", "a's "], regex.compile(P.PATTERN)
    for piece in textbytes.pieces(pa.array(texts), 5_000):
        start, first = textbytes.pretokens(piece, pattern)
        found = piece.bytes_of(start, np.append(start[1:], len(piece.data)))
        for i, text in enumerate(texts[piece.rows]):
            assert found[first[i]:first[i + 1]] == [m.encode() for m in pattern.findall(text or "")]


def test_words_are_runs_of_other_bytes():
    texts = odd_texts(3_000, 4) + [None, "", "a\x0bb\x0cc"]
    for piece in textbytes.pieces(pa.array(texts), 700):
        start, end, first = piece.words()
        found = piece.bytes_of(start, end)
        for i, text in enumerate(texts[piece.rows]):
            assert found[first[i]:first[i + 1]] == [w.encode() for w in brute.words(text)]


# --- token counts

def test_token_counts(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    rows = awkward() + [(200 + i, t, "s") for i, t in enumerate(odd_texts(1500))]
    got = tuples(token_counts.count_tokens(frame(spark, rows), P.path("piece_bpe_32k.model"), limit=20))
    want = Counter()
    for i, text, _ in rows:
        n = len(model.encode(text or ""))
        want[i, len((text or "").encode()), n, n > 20] += 1
    assert got == want
    assert token_counts.count_tokens(empty(spark), P.path("piece_bpe_32k.model")).count() == 0


def test_token_counts_with_a_small_table(spark):
    table = token_counts.UnitCounts(P.path("piece_bpe_32k.model"), keep=16_000)
    texts = odd_texts(800, 9)
    assert [table.count(t) for t in texts * 2] == [len(table.model.encode(t)) for t in texts * 2]
    assert table.whole and all(len(table.model.encode(w)) == 1 for w in list(table.whole)[:200])


# --- merge replay

def test_merge_replay_equals_tiktoken(spark):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = merge_replay.read_ranks(path)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = awkward() + [(200 + i, t, "s") for i, t in enumerate(odd_texts(1000, 3))]
    got = tuples(merge_replay.encode_decode(frame(spark, rows), path, P.PATTERN))
    want = Counter()
    for i, text, _ in rows:
        ids = library.encode_ordinary(text or "")
        want[i, len(ids), brute.sha_ids(ids), hashlib.sha256((text or "").encode()).hexdigest()] += 1
    assert got == want
    with_ids = merge_replay.encode_decode(frame(spark, rows[:30]), path, P.PATTERN, with_ids=True).collect()
    assert all(brute.sha_ids(r.ids) == r.ids_sha256 for r in with_ids)
    assert merge_replay.encode_decode(empty(spark), path, P.PATTERN).count() == 0


def test_a_merge_may_make_a_pair_of_lower_rank():
    # "abca" outranks "abc": after one "abc", the word's next merge comes before the other "abc".
    tokens = [bytes([b]) for b in range(256)] + [b"bc", b"abca", b"abc", b"ab"]
    replay = merge_replay.MergeReplay({t: i for i, t in enumerate(tokens)})
    library = tiktoken.Encoding("own", pat_str=r"\p{L}+", mergeable_ranks=replay.ranks, special_tokens={})
    rng = random.Random(5)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 14))).encode() for _ in range(3000)]
    assert [list(x) for x in replay.encode(words)] == [library.encode_ordinary(w.decode()) for w in words]


# --- entropy-coded ids

@pytest.mark.parametrize("n,kinds", [(0, 1), (1, 5), (1023, 3), (1025, 2), (70_000, 50_000), (300_000, 40), (5000, 1)])
def test_rans_round_trip(n, kinds):
    ids = np.random.default_rng(n).zipf(1.2, n).clip(1, kinds) - 1 if n else np.zeros(0, int)
    unit = rans.Unit(rans.encode_unit(ids, [n]))
    assert (unit.ids() == ids).all()
    for i in reversed(range(len(unit.points))):  # blocks decode apart
        first, part = unit.block(i)
        assert (part == ids[first:first + len(part)]).all()


def test_rans_many_rare_symbols():
    ids = np.concatenate([np.arange(50_000), np.zeros(900_000, int)])
    assert (rans.Unit(rans.encode_unit(ids, [len(ids)])).ids() == ids).all()
    symbols, share, precision = rans.frequency_table(np.bincount(ids))
    assert share.sum() == 1 << precision and share.min() > 0 and len(symbols) == 50_000


def test_rans_finds_damage():
    raw = bytearray(rans.encode_unit(np.arange(5000) % 17, [5000]))
    raw[-3] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        rans.Unit(bytes(raw)).ids()


def test_rans_files(spark):
    path = P.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = awkward() + [(200 + i, t, "s") for i, t in enumerate(odd_texts(600, 6))]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    units = rans.write_units(frame(spark, rows), path, P.PATTERN, unit_tokens=300)
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert units.count() > 8
    got = rans.read_units(units).collect()
    encoded = [(i, library.encode(t or "", add_special_tokens=False).ids + [2]) for i, t, _ in rows]
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter(
        (i, len(ids), brute.ids_crc32(ids)) for i, ids in encoded)
    at, last = 0, -1
    for r in sorted(got, key=lambda r: r.start):
        key = -1 if r.doc_id is None else r.doc_id
        assert r.start == at and key >= last
        at, last = at + r.n_tokens, key
    assert rans.read_units(rans.write_units(empty(spark), path, P.PATTERN)).count() == 0


# --- substring dedup

@pytest.mark.parametrize("hot,shard", [(1000, 60_000), (2, 200)])
def test_substring_dedup(spark, monkeypatch, hot, shard):
    monkeypatch.setattr(fm_dedup, "HOT_DOCS", hot)
    monkeypatch.setattr(fm_dedup, "SHARD_SEGMENTS", shard)
    rows = awkward(3)
    got = tuples(fm_dedup.dedup(frame(spark, rows)))
    assert got == brute.substring_dedup([(i, t) for i, t, _ in rows])
    assert sum(n * r[2] for r, n in got.items()) > 500


@pytest.mark.parametrize("wide", [2, 1000])
def test_common_passage_in_many_documents(spark, monkeypatch, wide):
    """Minimizers of more than three documents, dealt whole or, beyond `wide` segments, by window."""
    monkeypatch.setattr(fm_dedup, "HOT_DOCS", 3)
    monkeypatch.setattr(fm_dedup, "HOT_SEGMENTS", wide)
    passage = [f"p{i}" for i in range(70)]
    rows = [(i, " ".join([f"a{i}"] * (i % 5) + passage[i % 7:70 - i % 11] + [f"b{i}"] * (i % 4)), "s") for i in range(60)]
    got = Counter(tuple(r) for r in fm_dedup.dedup(frame(spark, rows)).collect())
    assert got == brute.substring_dedup([r[:2] for r in rows])


@pytest.mark.parametrize("keys", [40, 500_000])
def test_hot_segments_are_taken_where_the_texts_stand(spark, monkeypatch, keys):
    """Lists of hot minimizers are not made into rows, and texts are not shuffled for them;
    with very few keys to send, those of fewer documents are dealt like others."""
    monkeypatch.setattr(fm_dedup, "HOT_DOCS", 3)
    monkeypatch.setattr(fm_dedup, "HOT_SEGMENTS", 2)
    monkeypatch.setattr(fm_dedup, "HOT_KEYS", keys)
    passage = [f"p{i}" for i in range(70)]
    rows = [(i, " ".join(passage[i % 7:70 - i % 11] + [f"b{i}"] * (i % 4)), "s") for i in range(60)]
    base, hits = fm_dedup.find_spans(frame(spark, rows))
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and plan.count("MapInArrow _segments") == 1
    got = Counter(tuple(r) for r in fm_dedup.dedup(frame(spark, rows)).collect())
    assert got == brute.substring_dedup([r[:2] for r in rows])


def test_many_rows_of_one_id_stay_linear(spark):
    """Unlike texts of one id keep their own places, and equal rows find them once."""
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(1, passage, "s")] + [(7, f"x{i % 900} {passage}", "s") for i in range(1800)]
    base, hits = fm_dedup.find_spans(frame(spark, rows))
    assert hits.count() == 900 and hits.selectExpr("max(size(flatten(found)))").first()[0] == 18
    got = Counter(tuple(r) for r in fm_dedup.dedup(frame(spark, rows)).collect())
    assert got == brute.substring_dedup([r[:2] for r in rows])


def test_substring_dedup_empty(spark):
    assert fm_dedup.dedup(empty(spark)).count() == 0
    assert fm_dedup.rewrite(empty(spark)).count() == 0


def test_rewrite_keeps_rows_and_columns(spark):
    rows = awkward(4)
    docs = frame(spark, rows)
    got = fm_dedup.rewrite(docs)
    assert got.columns == docs.columns and got.dtypes == docs.dtypes
    kept = Counter((r.doc_id, " ".join(brute.words(r.text))) for r in got.collect())
    cut = Counter((r.doc_id, r.kept) for r in fm_dedup.dedup(docs, with_text=True).collect())
    assert kept == cut
    texts = {(i, t) for i, t, _ in rows}
    for r in got.collect():
        assert (r.doc_id, r.text) in texts or r.n_chars == len(r.text)
        assert (r.n, r.id, r.slot, r.mark, r["count"]) == (1, 7, 3, "m", "c")


def test_fm_index_intervals():
    rng = np.random.default_rng(3)
    segments = [rng.integers(1, 4, rng.integers(13, 40)) for _ in range(50)]
    text = np.concatenate([np.append(s, 0) for s in segments])
    lengths = np.array([len(s) for s in segments])
    starts = np.cumsum(lengths + 1) - lengths - 1
    values = rng.permutation(len(segments))
    owner, window, least = fm_dedup.match_segments(text, starts, lengths, values)
    where = {}
    for s, v in zip(segments, values.tolist()):
        for j in range(len(s) - 12):
            key = tuple(s[j:j + 13])
            where[key] = min(v, where.get(key, v))
    assert len(owner) == sum(lengths - 12)
    for o, w, v in zip(owner.tolist(), window.tolist(), least.tolist()):
        assert where[tuple(segments[o][w:w + 13])] == v


# --- shingle join

@pytest.mark.parametrize("seed,tile", [(5, 20_000), (6, 3)])
def test_shingle_join(spark, monkeypatch, seed, tile):
    monkeypatch.setattr(jaccard_join, "TILE_SETS", tile)
    monkeypatch.setattr(jaccard_join, "HUB_MEMBERS", 2)
    rows = awkward(seed)
    got = tuples(jaccard_join.join(frame(spark, rows)))
    assert got == brute.jaccard([(i, t) for i, t, _ in rows])
    assert any(r[0] is not None and r[2] != r[0] for r in got)


def family(n, first, rng, most=30):
    """Copies of one text of 100 words, of which 0 to `most` words were replaced."""
    base = [f"b{first}w{i}" for i in range(100)]
    out = []
    for k in range(n):
        words = list(base)
        for at in rng.sample(range(100), rng.randrange(most)):
            words[at] = f"e{rng.randrange(10**6)}"
        out.append((first + k, " ".join(words), "s"))
    return out


@pytest.mark.parametrize("tile,leaf,pairs", [(2048, 64, 1 << 16), (20, 4, 5)])
def test_shingle_join_of_families(spark, monkeypatch, tile, leaf, pairs):
    monkeypatch.setattr(jaccard_join, "MERGE_ROWS", 3)
    monkeypatch.setattr(jaccard_join, "TILE_SETS", tile)
    monkeypatch.setattr(jaccard_join, "TILE_LEAF", leaf)
    monkeypatch.setattr(jaccard_join, "BATCH_PAIRS", pairs)
    rng = random.Random(tile)
    a, b = family(60, 100, rng, 12), family(40, 500, rng, 25)
    # Texts of both families and of other lengths, shingles with few sets beside those of many.
    mixed = [(900 + k, " ".join(a[k][1].split()[:60 + 3 * k] + b[k][1].split()[:5 * k]), "s") for k in range(20)]
    rows = [*a, *b, *mixed, *awkward(9)]
    assert tuples(jaccard_join.join(frame(spark, rows))) == brute.jaccard([(i, t) for i, t, _ in rows])


def test_large_families_are_not_compared_pair_by_pair(spark, monkeypatch):
    verify, counts = jaccard_join.verify, []

    def counted(pairs, texts):
        counts.append(pairs.count())
        return verify(pairs, texts)

    monkeypatch.setattr(jaccard_join, "verify", counted)
    rows = family(300, 1, random.Random(3), 14)
    got = tuples(jaccard_join.join(frame(spark, rows)))
    assert got == brute.jaccard([(i, t) for i, t, _ in rows])
    assert sum(counts) < 20 * len(rows)


def test_families_are_paired_in_bounded_batches(monkeypatch):
    """A tile in which all pairs may link; each goes once, some at a time."""
    monkeypatch.setattr(jaccard_join, "TILE_LEAF", 8)
    monkeypatch.setattr(jaccard_join, "BATCH_PAIRS", 100)
    n = 60
    key, owner = np.tile(np.arange(200, dtype=np.uint64) * np.uint64(977), n), np.repeat(np.arange(n), 200)
    odd = jaccard_join.parities(key, owner, np.full(n, 512))
    bits = jaccard_join.bitmap(key[:51], 256).tobytes()
    columns = {"low": [0] * n, "high": [0] * n, "tile": [0] * n, "id": list(range(n)), "n": [200] * n,
               "part": list(range(n)), "bits": [bits] * n, "odd": odd}
    whole = pa.RecordBatch.from_pydict(columns)
    batches = list(jaccard_join._family_pairs(iter([whole.slice(0, 25), whole.slice(25)])))
    pairs = [(r["a"], r["b"]) for x in batches for r in x.to_pylist()]
    assert sorted(pairs) == [(i, j) for i in range(n) for j in range(i + 1, n)]
    assert max(x.num_rows for x in batches) <= 100 + 64


def test_parities_bound_the_symmetric_difference():
    rng = np.random.default_rng(2)
    sets = [rng.choice(2000, rng.integers(1, 300), False).astype(np.uint64) for _ in range(30)]
    key, owner = np.concatenate(sets), np.repeat(np.arange(30), [len(x) for x in sets])
    for places in (64, 1024):
        odd = [np.frombuffer(x, np.uint64) for x in jaccard_join.parities(key, owner, np.full(30, places))]
        half = [jaccard_join.fold(x, 64, np.bitwise_xor) for x in odd]
        for i in range(30):
            for j in range(i):
                most = len(np.setxor1d(sets[i], sets[j]))
                assert np.bitwise_count(odd[i] ^ odd[j]).sum() <= most
                assert np.bitwise_count(half[i] ^ half[j]).sum() <= most
    none = jaccard_join.parities(key[owner == 1], owner[owner == 1], np.array([0, 64, 0, 128]))
    assert [len(x) for x in none] == [0, 8, 0, 16]


def chain(n, step):
    """Texts that each link with their neighbours only, and texts of one common passage."""
    words = [f"v{i}" for i in range(n * step + 200)]
    return [(1000 + i, " ".join(words[i * step:i * step + 100]), "s") for i in range(n)]


def test_shingle_join_of_a_chain_and_a_common_passage(spark):
    rng = random.Random(8)
    passage = " ".join(f"p{i}" for i in range(80))
    rows = chain(25, 6) + [
        (i, passage + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.choice([10, 22, 30, 40]))), "s")
        for i in range(60)]
    assert tuples(jaccard_join.join(frame(spark, rows))) == brute.jaccard([(i, t) for i, t, _ in rows])


def test_shingle_join_at_the_border(spark):
    # 8 words: 4 shingles; one more word: 4 of 5 in common (80 %); two more: 4 of 6.
    base = "a b c d e f g h"
    rows = [(1, base, "s"), (2, base + " i", "s"), (3, base + " j k", "s"), (4, "a b c d", "s"), (5, "A B C D", "s"),
            (6, "a b c d e f g", "s")]  # 3 of 4 with the first: exactly 75 %
    assert tuples(jaccard_join.join(frame(spark, rows))) == brute.jaccard([(i, t) for i, t, _ in rows])


def test_shingle_join_empty_and_keep_one(spark):
    assert jaccard_join.join(empty(spark)).count() == 0
    rows = awkward(7)
    docs = frame(spark, rows)
    got = jaccard_join.keep_one(docs)
    assert got.columns == docs.columns
    part = {r[0]: r[2] for r in brute.jaccard([(i, t) for i, t, _ in rows])}
    want = {(i, t) for i, t, _ in rows if i is not None and part[i] == i}
    assert Counter((r.doc_id, r.text) for r in got.collect() if r.doc_id is not None) == Counter(want)
    assert got.where("doc_id is null").count() == 3


@pytest.mark.parametrize("top", [0, 2**63 - 20])
def test_keep_one_does_not_tie_unlike_texts_of_an_id(spark, top):
    x = [" ".join(f"x{k}y{i}" for i in range(30)) for k in range(6)]
    rows = [(3, x[0]), (7, x[0]), (7, x[1]), (7, x[2] + " end"), (8, x[1]), (9, x[2]), (9, x[3]),
            (9, x[3]), (2, x[4]), (9, x[4]), (10, x[5]), (10, None), (11, ""), (11, x[5])]
    rows = [(top + i, t, "s") for i, t in rows]
    # Brute force: every distinct row is a document of its own.
    own = sorted({(i, t) for i, t, _ in rows}, key=lambda r: (r[0], r[1] or ""))
    part = {k: c for k, _, c in brute.jaccard([(k, t) for k, (_, t) in enumerate(own)])}
    want = Counter(own[k] for k in part if own[k][0] == own[part[k]][0])
    got = corpus_pipeline.drop_near_duplicates(spark, frame(spark, rows), None)
    assert Counter((r.doc_id, r.text) for r in got.collect()) == want
    assert {t for _, t in want} >= {x[0], x[1], x[3], x[4], x[5]}


def test_shared_tokens_over_batches():
    rng = random.Random(4)
    rows = sorted({(rng.randrange(30), rng.randrange(12)) for _ in range(200)})
    rows = sorted(rows + rows[::7])
    names = ["token", "id", "n"]
    for cut in (1, 2, 3, 7, 500):
        batches = [pa.RecordBatch.from_arrays([pa.array([t for t, _ in rows[a:a + cut]]),
                                               pa.array([i for _, i in rows[a:a + cut]]),
                                               pa.array([i + 5 for _, i in rows[a:a + cut]])], names=names)
                   for a in range(0, len(rows), cut)]
        got = [tuple(r.values()) for b in jaccard_join._shared(batches) for r in b.to_pylist()]
        groups = {}
        for t, i in rows:
            groups.setdefault(t, set()).add(i)
        want = [(t, i, i + 5, min(g), min(g) + 5) for t, g in sorted(groups.items()) if len(g) > 1 for i in sorted(g)]
        assert sorted(got) == want, cut


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 50)] + [
        (rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(70)] + [(500, 500)]
    df = spark.createDataFrame(links, "u long, v long")
    got = {(r.id, r.component) for r in components(df).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    part = brute.components(linked, [(a, b) for a, b in links if a != b])
    assert got == set(part.items())
    assert components(df.where("u < 0")).count() == 0
