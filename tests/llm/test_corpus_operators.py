"""Toxicity (1), sharding (2), mixing (3), the registered queries and the pipeline."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.compare import connect, differences
from tests.llm.data import awkward, empty, frame
from threadglean.llm import mixing, queries, sharding, toxicity

SF_DIR = "/root/testdata/sf0.001"
CATEGORIES = [("rude", "rude"), ("toxic", "toxic")]


# --- sharding

def slim(docs):
    return docs.select("doc_id", "source", sharding.text_crc32(docs.text).alias("text_crc32"), "shard", "slot")


def test_shards_match_the_mixture(spark):
    rows = awkward() + [(1000 + i, f"t{i}", "hot" if i % 3 else f"s{i % 5}") for i in range(700)]
    got = sharding.assign_shards(slim(frame(spark, rows)), 8, order_cols=("doc_id", "text_crc32")).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _, _ in rows)
    sizes, per_source = defaultdict(list), defaultdict(Counter)
    for r in got:
        sizes[r.shard].append(r.slot)
        per_source[r.source][r.shard] += 1
    assert sorted(sizes) == list(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in sizes.values())
    assert max(map(len, sizes.values())) - min(map(len, sizes.values())) <= 1
    for source, counts in per_source.items():
        n = sum(counts.values())
        # A stretch of an eighth holds an eighth of each source, up to its ends.
        assert all(abs(counts[s] - n / 8) < 2 for s in range(8)), source


def test_shards_equal_a_plain_version_and_depend_on_rows_only(spark):
    rows = [(i, f"text {i}", f"s{i % 4 if i % 3 else 0}") for i in range(300)]
    docs = slim(frame(spark, rows))
    got = {r.doc_id: (r.shard, r.slot) for r in sharding.assign_shards(docs, 7).collect()}
    assert got == {r.doc_id: (r.shard, r.slot) for r in sharding.assign_shards(docs.repartition(11), 7).collect()}
    dealt = docs.selectExpr("doc_id", "source", "xxhash64(17, doc_id) AS h", "xxhash64(17, source) AS t").collect()
    by_source = defaultdict(list)
    for r in dealt:
        by_source[r.source].append(r)
    placed = []
    for source, own in by_source.items():
        for rank, r in enumerate(sorted(own, key=lambda r: (r.h, r.doc_id)), 1):
            placed.append(((rank - 0.5) / len(own), r.t, source, rank, r.doc_id))
    n, begin = len(placed), {}
    for p, (*_, doc) in enumerate(sorted(placed)):
        shard = p * 7 // n
        begin.setdefault(shard, p)
        assert got[doc] == (shard, p - begin[shard])


def test_shards_of_few_and_no_rows(spark):
    rows = [(1, "a", "s"), (2, "b", None), (3, "c", "s")]
    got = sharding.assign_shards(slim(frame(spark, rows)), 8).collect()
    assert len({r.shard for r in got}) == 3 and {r.slot for r in got} == {0}
    assert sharding.assign_shards(slim(empty(spark)), 8).count() == 0


def test_text_size_and_crc(spark):
    rows = [(1, "é漢a", "s"), (2, "", "s"), (3, None, "s")]
    docs = frame(spark, rows)
    got = docs.select("doc_id", sharding.text_size(docs.text), sharding.text_crc32(docs.text)).collect()
    assert {tuple(r) for r in got} == {(1, 7, zlib.crc32("é漢a".encode())), (2, 1, 0), (3, 1, 0)}


def test_written_shards(spark, tmp_path):
    rows = [(i, f"text {i}", f"s{i % 4}") for i in range(80)]
    path = str(tmp_path / "shards")
    sharding.write_shards(sharding.assign_shards(slim(frame(spark, rows)), 5), path)
    assert spark.read.parquet(path).groupBy("shard").count().count() == 5


# --- mixing

@pytest.mark.parametrize("weights", [[1, 1, 1], [5, 3, 1, 1], [0.5, 0.31, 0.19], [7], list(range(1, 30))])
def test_periods_stay_within_one_block(weights):
    shares = mixing.whole_shares(weights, 256)
    assert sum(shares) == 256 and min(shares) >= 1
    slots = mixing.one_period(shares)
    assert sorted(s for own in slots for s in own) == list(range(256))
    for own, share in zip(slots, shares):
        out = np.zeros(256)
        out[own] = 1
        assert np.abs(np.cumsum(out) - np.arange(1, 257) * share / 256).max() < 1


def simulated(blocks, weights, period):
    """Earliest deadline first, slot by slot, without the period's arithmetic."""
    left, order = dict(enumerate(blocks)), []
    while any(left.values()):
        active = [i for i in left if left[i]]
        shares = mixing.whole_shares([weights[i] for i in active], period)
        done, slot = [0] * len(active), 0
        while True:
            ready = [(-(-(d + 1) * period // s), k) for k, (d, s) in enumerate(zip(done, shares)) if d * period // s <= slot]
            k = min(ready)[1]
            if not left[active[k]]:
                break
            order.append(active[k])
            left[active[k]] -= 1
            done[k] += 1
            slot += 1
    return order


@pytest.mark.parametrize("blocks,weights", [([5, 9, 30], [1, 1, 1]), ([100, 3, 40, 1], [2, 5, 1, 1]), ([3], [2])])
def test_phases_equal_a_simulation(blocks, weights):
    period = max(16, 4 * len(blocks))
    order = {}
    for i, _, first, taken, at, p, slots in mixing.phases(blocks, weights, 16):
        for q in range(taken):
            order[at + q // len(slots) * p + slots[q % len(slots)]] = (i, first + q)
    assert sorted(order) == list(range(sum(blocks)))
    assert [order[s][0] for s in sorted(order)] == simulated(blocks, weights, period)
    for i, n in enumerate(blocks):
        assert [b for _, (j, b) in sorted(order.items()) if j == i] == list(range(n))


def test_mix(spark):
    rows = awkward() + [(1000 + i, f"t{i}", "hot" if i % 3 else f"s{i % 5}") for i in range(500)]
    docs = frame(spark, rows).drop("slot").withColumnRenamed("shard", "phase")
    got = mixing.mix(docs, block=4, weights={"hot": 3.0, "s1": 2.0}).collect()
    assert Counter((r.doc_id, r.text, r.source) for r in got) == Counter(rows)
    assert sorted(r.position for r in got) == list(range(len(rows)))
    got.sort(key=lambda r: r.position)
    assert [r.slot for r in got] == sorted(r.slot for r in got)
    members = defaultdict(list)
    for r in got:
        members[r.slot].append(r)
    assert all(len({(r.source, r.block) for r in own}) == 1 and len(own) <= 4 for own in members.values())
    # Until the first source runs out, every source is less than a block from its weight.
    counts = Counter(s for _, _, s in rows)
    pull = {s: {"hot": 3.0, "s1": 2.0}.get(s, 1.0) for s in counts}
    seen = Counter()
    for slot, own in sorted(members.items()):
        if own[0].phase:
            break
        seen[own[0].source] += 1
        for s in counts:
            assert abs(seen[s] - (slot + 1) * pull[s] / sum(pull.values())) < 1 + (slot + 1) / 1024
    assert mixing.mix(empty(spark)).count() == 0


def served(blocks, weights):
    """Blocks of every source that are due after each slot, slot by slot at the exact weights."""
    due, out = [0.0] * len(blocks), []
    for _ in range(sum(blocks)):
        room = 1.0
        while room > 1e-9:
            active = [i for i, n in enumerate(blocks) if n - due[i] > 1e-9]
            if not active:
                break
            total = sum(weights[i] for i in active)
            step = min(room, min((blocks[i] - due[i]) * total / weights[i] for i in active))
            for i in active:
                due[i] += step * weights[i] / total
            room -= step
        out.append(list(due))
    return np.array(out)


def lags(order, blocks, weights):
    """The largest distance of a source from its weight, in blocks, over all slots."""
    out = np.zeros((len(order), len(blocks)))
    out[np.arange(len(order)), order] = 1
    return np.abs(np.cumsum(out, 0) - served(blocks, weights)).max()


@pytest.mark.parametrize("blocks,weights", [
    ([600] * 20, [1.0] * 20),
    ([12_000, 3], [1.0, 1e-5]),
    ([n * n for n in range(1, 33)], [float(n) for n in range(1, 33)]),
    ([5000, 3000, 7, 2500, 1], [0.31, 0.05, 0.01, 0.6, 0.03]),
])
def test_every_slot_is_within_one_block_of_the_exact_weights(blocks, weights):
    for chunk in (1 << 20, 997):
        i, j, slots, phase = (np.concatenate(x) for x in zip(*mixing.schedule(blocks, weights, chunk)))
        assert len(slots) > 10_000 and (slots == np.arange(sum(blocks))).all()
        assert all((j[i == s] == np.arange(n)).all() for s, n in enumerate(blocks))
        assert lags(i, blocks, weights) < 1 + 1e-6
        assert phase[0] == 0 and (np.diff(phase) >= 0).all()


def test_mixed_rows_keep_to_the_exact_weights(spark, monkeypatch):
    docs = spark.range(11_000).selectExpr("id AS doc_id", "concat('s', id % 20) AS source")
    got = [r for r in mixing.mix(docs, block=1).orderBy("position").collect()]
    assert [r.position for r in got] == [r.slot for r in got] == list(range(11_000))
    assert lags([int(r.source[1:]) for r in got], [550] * 20, [1.0] * 20) < 1 + 1e-6
    # The same schedule from several chunks and a shuffle join.
    monkeypatch.setattr(mixing, "PLAN_PIN_ROWS", 0)
    monkeypatch.setattr(mixing, "CHUNK_SLOTS", 100)
    assert got == mixing.mix(docs, block=1).orderBy("position").collect()


def test_many_sources_stay_a_table(spark, monkeypatch):
    docs = spark.range(16_000).selectExpr("id AS doc_id", "concat('host', id % 11000) AS source")
    with monkeypatch.context() as patch:
        patch.setattr(mixing, "PLAN_PIN_ROWS", 1000)
        patch.setattr(type(docs), "collect", lambda self: pytest.fail("sources were collected"))
        mixed = mixing.mix(docs, block=1)
    got = mixed.collect()
    assert sorted(r.doc_id for r in got) == sorted(r.position for r in got) == list(range(16_000))
    # 5,000 hosts have two documents, the others one; the weights are the square roots.
    phases = Counter(r.phase for r in got)
    first = 6000 + 5000 * 2 ** 0.5
    assert abs(phases[0] - first) < 1 and phases[1] == 16_000 - phases[0]


def test_mixed_files_are_in_order(spark):
    rows = [(i, f"t{i}", f"s{i % 7 % 3}") for i in range(300)]
    got = [r.position for r in mixing.in_order(mixing.mix(frame(spark, rows))).collect()]
    assert got == list(range(300))


# --- toxicity

def labelled(seed, n=600):
    """Texts in which toxic ones hold words of a family, mostly also rude ones."""
    rng = random.Random(seed)
    plain = [f"{a}{b}" for a in ("wan", "tor", "mel", "sip", "gar") for b in ("do", "ri", "ka", "ne", "lu", "si")]
    docs, labels = [], []
    for i in range(n):
        w = [rng.choice(plain) for _ in range(rng.choice([5, 20, 60, 200]))]
        toxic, rude = rng.random() < 0.2, rng.random() < 0.2
        for _ in range(3 * toxic):
            w.insert(rng.randrange(len(w)), "Zorlo" + rng.choice(["p", "ka", "ment", "ing", "u"]) + rng.choice([".", ""]))
        for _ in range(3 * rude):
            w.insert(rng.randrange(len(w)), rng.choice(["BAH", "pfui"]))
        docs.append((i, " ".join(w), "s"))
        labels.append((i, int(rude), int(toxic or (rude and i % 2))))
    return docs, labels


def test_chain_on_held_out_rows(spark):
    docs, labels = labelled(1)
    marks = spark.createDataFrame(labels, "doc_id long, rude int, toxic int")
    table = frame(spark, docs)
    chain = toxicity.train(table, marks.where("doc_id < 400"), CATEGORIES)
    truth = {i: t for i, _, t in labels}
    got = [(r.rejected, truth[r.doc_id]) for r in toxicity.score(table, chain).where("doc_id >= 400").collect()]
    assert sum(bool(a) == bool(b) for a, b in got) / len(got) > 0.85
    # The second model uses the first one's probability: some toxic texts are rude only.
    assert chain.models[1][2].shape == (1,) and chain.models[1][2][0] > 0.2


def test_chain_bounds_its_sample(spark):
    docs, labels = labelled(2, 300)
    marks = spark.createDataFrame(labels, "doc_id long, rude int, toxic int")
    chain = toxicity.train(frame(spark, docs), marks, CATEGORIES, max_rows=50, features=10)
    assert len(chain.places) <= 20


def test_chain_on_awkward_rows(spark):
    docs, labels = labelled(3, 200)
    marks = spark.createDataFrame(
        labels + [(100, 1, 1), (101, 1, 1), (1, None, 1), (None, 1, 1), (2, 0, 1), (999_999, 1, 1)],
        "doc_id long, rude int, toxic int")
    table = frame(spark, docs + awkward())
    chain = toxicity.train(table, marks, CATEGORIES)
    got = toxicity.score(table, chain)
    assert got.columns == ["doc_id", "p_rude", "p_toxic", "rejected"]
    assert got.count() == table.count() and got.where("rejected is null or p_toxic is null").count() == 0
    kept = toxicity.keep_clean(table, chain)
    assert kept.dtypes == table.dtypes and kept.count() == got.where("not rejected").count()
    for text in (None, "", " \n"):
        assert toxicity.score(frame(spark, [(1, text, "s")]), chain).first().rejected is False
    assert toxicity.score(empty(spark), chain).count() == 0 == toxicity.keep_clean(empty(spark), chain).count()


def test_chain_without_labels_or_with_one_class(spark):
    docs, labels = labelled(4, 40)
    marks = spark.createDataFrame(labels, "doc_id long, rude int, toxic int")
    table = frame(spark, docs)
    chain = toxicity.train(table, marks.where("false"), CATEGORIES)
    assert toxicity.score(table, chain).where("rejected").count() == 0
    chain = toxicity.train(table, marks.selectExpr("doc_id", "0 AS rude", "0 AS toxic"), CATEGORIES)
    assert toxicity.score(table, chain).where("rejected").count() == 0


def test_toxic_documents_of_the_tables(spark):
    got = queries.op1_chain_toxicity(spark, SF_DIR).join(
        spark.read.parquet(f"{SF_DIR}/labels.parquet").withColumnRenamed("toxic", "truth"), "doc_id")
    assert got.where("toxic <> (truth = 1)").count() == 0


# --- registered queries

@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_queries_equal_their_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.ORACLES[name]) == ""


def test_all_queries_are_registered():
    found = entry.queries()
    assert set(queries.QUERIES) <= set(found) and found["pipeline"] is corpus_pipeline.run
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))


# --- the pipeline

def test_pipeline_equals_its_stages_by_brute_force(spark):
    import hashlib

    import public_tokenizers as P
    import tiktoken

    from tests.llm import brute
    from threadglean.llm.merge_replay import read_ranks

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rejected = {r.doc_id for r in queries.op1_chain_toxicity(spark, SF_DIR).where("toxic").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id not in rejected]
    part = {i: c for (i, _, c) in brute.jaccard(rows)}
    rows = [(i, t) for i, t in rows if part[i] == i]
    removed = {i: n for (i, _, n, _) in brute.substring_dedup(rows)}
    digest = {i: s for (i, _, _, s) in brute.substring_dedup(rows)}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={},
                                mergeable_ranks=read_ranks(P.path("byte_bpe_multi_50k.tiktoken")))
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in rows)
    texts = dict(rows)
    for r in got:
        assert r.n_tokens == len(r.ids) and brute.sha_ids(r.ids) == r.ids_sha256
        if removed[r.doc_id]:
            assert r.decoded_sha256 == digest[r.doc_id]
        else:
            assert list(r.ids) == library.encode_ordinary(texts[r.doc_id])
            assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def brute_schedule(blocks, weights):
    """The source of every slot: of the blocks that are due in part, the one that must be out first."""
    due = served(blocks, weights)
    release = [[int(np.argmax(due[:, i] > j + 1e-7)) for j in range(n)] for i, n in enumerate(blocks)]
    deadline = [[int(np.argmax(due[:, i] > j + 1 - 1e-7)) + 1 for j in range(n)] for i, n in enumerate(blocks)]
    done, order = [0] * len(blocks), []
    for slot in range(sum(blocks)):
        _, i = min((deadline[i][d], i) for i, d in enumerate(done) if d < blocks[i] and release[i][d] <= slot)
        order.append(i)
        done[i] += 1
    return order


def brute_positions(spark, docs):
    """Positions of (doc_id, text) rows by a brute-force schedule."""
    rows = docs.selectExpr("doc_id", "text", "source", "xxhash64(29, doc_id, xxhash64(text)) AS deal").collect()
    by_source = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.deal):
        by_source[r.source].append((r.doc_id, r.text))
    names = sorted(by_source, key=lambda s: (s is not None, str(s)))
    counts = [len(by_source[s]) for s in names]
    out, done = [], Counter()
    for i in brute_schedule([-(-n // 16) for n in counts], [n ** 0.5 for n in counts]):
        out += by_source[names[i]][16 * done[i]:16 * done[i] + 16]
        done[i] += 1
    return out


def test_the_pipeline_returns_the_schedule(spark):
    import hashlib

    rows = awkward() + [(1000 + i, f"t{i}", "hot" if i % 3 else f"s{i % 5}") for i in range(900)]
    docs = frame(spark, rows)
    want = brute_positions(spark, docs)
    got = {r.position: (r.doc_id, r.decoded_sha256) for r in corpus_pipeline.encode(spark, docs, SF_DIR).collect()}
    digest = [(i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in want]
    assert [got[p] for p in range(len(rows))] == digest
    # The files of the stage before hold the same order.
    stored = corpus_pipeline.mix_sources(spark, docs, SF_DIR).collect()
    assert [(r.doc_id, r.text) for r in stored] == want


def test_the_whole_pipeline_returns_the_schedule(spark, monkeypatch):
    given = []
    stage = corpus_pipeline.encode
    monkeypatch.setattr(corpus_pipeline, "STAGES", [
        *corpus_pipeline.STAGES[:-1], ("byte_bpe", lambda s, docs, d: given.append(docs) or stage(s, docs, d))])
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    want = brute_positions(spark, given[0])
    assert [r.doc_id for r in sorted(got, key=lambda r: r.position)] == [i for i, _ in want]


def test_stages_keep_the_columns(spark):
    docs = frame(spark, awkward())
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, SF_DIR)
        assert got.columns == docs.columns, name
        assert stage(spark, empty(spark), SF_DIR).count() == 0
