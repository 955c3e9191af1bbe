"""Embedding near-duplicates (6) and nearest neighbours (7)."""

import numpy as np
import pytest

from tests.llm import brute
from threadglean.llm import projection_search, subspace_join

SCHEMA = ("vec_id long, embedding array<float>, label int, links long, n long, block int, cell int, "
          "dim int, key string, shard int")


def vectors(seed=1, n=400, dim=24):
    """Families of near copies, exact copies, scaled copies and awkward rows."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, dim))
    rows = []
    for i in range(n):
        v = rng.standard_normal(dim)
        if i % 3 == 0:
            v = centres[i % 12] + rng.standard_normal(dim) * rng.choice([0.0, 0.1, 0.25, 0.35])
        if i % 17 == 0:
            v = v * 50
        rows.append((i, v.astype(np.float32).tolist(), int(i % 4 > 0) if i % 11 else None))
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * dim, [nan] + [1.0] * (dim - 1), [inf] * dim, [None] + [1.0] * (dim - 1), [1.0, 0.0],
           [1.0, 0.01]]
    rows += [(1000 + i, v, 1) for i, v in enumerate(odd)]
    rows += [(1100 + i, rows[6][1], 1) for i in range(30)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 5, 1, 2, 3, None, "k", 9) for r in rows], SCHEMA).repartition(4)


@pytest.mark.parametrize("cell,tile", [(4096, 4096), (60, 4096), (40, 25)])
def test_near_duplicates(spark, monkeypatch, cell, tile):
    monkeypatch.setattr(subspace_join, "CELL_ROWS", cell)
    monkeypatch.setattr(subspace_join, "TILE_ROWS", tile)
    rows = vectors(cell)
    got = subspace_join.near_duplicates(frame(spark, rows)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == brute.near_vectors(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert sum(r.n_links for r in got) > 1000


def test_near_duplicates_repeated_rows_null_ids_and_empty(spark):
    rows = vectors(3, 60)
    again = rows + [rows[0]] * 3 + [(None, rows[6][1], 1)]
    got = {(r.vec_id, r.n_links) for r in subspace_join.near_duplicates(frame(spark, again)).collect()}
    once = {i: n for i, n, _ in brute.near_vectors(rows)}
    assert (0, once[0] + 3) in got or rows[0][2] is None
    assert (None, 0) in got
    assert subspace_join.near_duplicates(frame(spark, rows).where("false")).count() == 0


def test_blocks_cover_every_pair_within_budget():
    rng = np.random.default_rng(5)
    dim, cosine = 20, 0.9
    a = rng.standard_normal((300, dim))
    b = a + rng.standard_normal((300, dim)) * rng.uniform(0, 0.5, (300, 1))
    a, b = subspace_join._unit(a), subspace_join._unit(b)
    turn = subspace_join.rotation(dim)
    within = np.zeros(300, bool)
    for p in subspace_join.blocks_of(dim):
        gap = ((a @ turn - b @ turn)[:, p] ** 2).sum(1)
        within |= gap <= (2 - 2 * cosine) * (p.stop - p.start) / dim + 1e-9
    assert within[(a * b).sum(1) >= cosine].all()


def test_cells_reach_the_ball():
    rng = np.random.default_rng(6)
    points = rng.standard_normal((500, 8))
    cuts = subspace_join.Cuts(points[:100], 5)
    home = np.empty(500, int)
    row, cell = cuts.cells(points)
    home[row] = cell
    reached = set(zip(*(x.tolist() for x in cuts.cells(points, 0.8))))
    apart = ((points[:, None] - points[None]) ** 2).sum(2)
    for i, j in np.argwhere(apart <= 0.64):
        assert (i, home[j]) in reached


@pytest.mark.parametrize("shard", [8192, 70])
def test_nearest_neighbours(spark, monkeypatch, shard):
    monkeypatch.setattr(projection_search, "SHARD_ROWS", shard)
    monkeypatch.setattr(projection_search, "QUERY_ROWS", 2)
    rows = vectors(7)
    got = projection_search.nearest(frame(spark, rows), every=20).collect()
    want = brute.nearest([(i, v) for i, v, _ in rows], every=20)
    found = {(r.query_id, r.vec_id) for r in got}
    assert len(found & {(q, i) for q, _, i, _ in want}) >= 0.9 * len(want)
    assert len(got) == len(want)
    vector = {i: np.array(v, float) for i, v, _ in rows if v and None not in v}
    last = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        assert r.score == pytest.approx(float(np.linalg.norm(vector[r.query_id] - vector[r.vec_id])), abs=1e-12)
        assert last.get(r.query_id, (0, -1.0, -1))[1:] < (r.score, r.vec_id)
        assert r["rank"] == last.get(r.query_id, (0,))[0] + 1
        last[r.query_id] = (r["rank"], r.score, r.vec_id)


def test_nearest_with_repeats_few_rows_and_none(spark):
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.0, 1.0], 1), (2, [0.0, 1.0], 1),
            (None, [1.0, 1.0], 1)]
    got = [(r.query_id, r["rank"], r.vec_id) for r in projection_search.nearest(frame(spark, rows)).collect()]
    assert sorted(got) == [(0, 1, 1), (0, 2, 2), (0, 3, 2)]
    assert projection_search.nearest(frame(spark, rows).where("false")).count() == 0


def test_chi_square():
    rng = np.random.default_rng(1)
    drawn = (rng.standard_normal((200_000, projection_search.M)) ** 2).sum(1)
    for x in (2.0, 8.0, 15.0):
        assert projection_search.chi_square_cdf(x) == pytest.approx((drawn <= x).mean(), abs=0.005)


@pytest.mark.parametrize("block", [1, 2, 5, 41, 100])
def test_all_copies_are_read_despite_rounding(block, monkeypatch):
    rng = np.random.default_rng(block)
    copy = rng.standard_normal(64)
    vectors = np.vstack([np.tile(copy, (2731, 1)), rng.standard_normal((500, 64))])
    ids = rng.permutation(len(vectors))
    queries = np.vstack([rng.standard_normal((block - 1, 64)), copy])
    want = np.sort(ids[:2731])[:10]

    def found():
        q, i, d = projection_search.search(vectors, ids, queries, np.full(block, -1), 10)
        assert (d[q == block - 1] == 0).all()
        return ids[i[q == block - 1].astype(int)]

    assert (found() == want).all()
    # Products of other heights may round otherwise: boxes a few roundings off.
    tree = projection_search.KdTree
    monkeypatch.setattr(projection_search, "KdTree", lambda points: tree(points * (1 + 4e-16)))
    assert (found() == want).all()
