"""Whitening and clustering against numpy, over vectors with every awkward case."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

from tillflow.llm import vafile, vectors, whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, vector string, x string, cluster string"
CLASH = (1, "clash", "clash", "clash", "clash")


def made(count: int, size: int = 64, seed: int = 1) -> list[tuple]:
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.2, (6, size))
    rows = centres[rng.integers(0, 6, count)] + rng.normal(0, np.linspace(0.05, 0.3, size), (count, size))
    return [(k, [float(np.float32(x)) for x in row], *CLASH) for k, row in enumerate(rows)]


def awkward(count: int = 400, size: int = 64) -> list[tuple]:
    """NULL and short vectors, NULL, NaN and infinite entries, no ids, and a third of equal rows."""
    rows = made(count, size)
    good = rows[0][1]
    same = [(1000 + k, good, *CLASH) for k in range(count // 2)]
    bad = [
        (5000, None, *CLASH),
        (5001, [], *CLASH),
        (5002, [None, *good[1:]], *CLASH),
        (5003, [float("nan"), *good[1:]], *CLASH),
        (5004, [float("-inf"), *good[1:]], *CLASH),
        (5005, good[:-1], *CLASH),
        (5006, [*good, 1.0], *CLASH),
    ]
    return rows + same + bad + [(None, rows[3][1], *CLASH), (7, rows[7][1], *CLASH), (7, rows[8][1], *CLASH)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def usable(rows, size=64):
    fine = lambda v: v is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v)
    return [(r[0], r[1]) for r in rows if fine(r[1])]


def key(row):
    return (row[0] is None, row[0] or 0, *row[1:])


def reference(rows, components=32):
    x = np.floor(64 * np.array([r[1] for r in rows], np.float64)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(0)
    c = (n * x - sums) / n
    values, turn = np.linalg.eigh(c.T @ c / n)
    return n, ((n * x - sums) ** 2).sum(1), c, values[::-1][:components], turn[:, ::-1][:, :components], values.sum()


def check_whitened(got, rows, model, error, components):
    n, deviation, c, values, turn, trace = reference(rows, components)
    assert model.n == n
    assert np.allclose(model.values, values, rtol=1e-12)
    assert np.allclose(model.explained, values / trace, rtol=1e-10)
    signs = np.sign((turn * model.components).sum(0))
    assert np.abs(turn * signs - model.components).max() < 1e-9
    want = sorted(
        (key((r[0], int(d), *np.round(w, 6))) for r, d, w in zip(rows, deviation, (c @ turn) * signs / np.sqrt(values)))
    )
    have = sorted(key((r["id"], int(r["deviation"]), *np.round(r["whitened"], 6))) for r in got)
    assert len(have) == len(want)
    for one, other in zip(have, want):
        assert one[:3] == other[:3] and np.allclose(one[3:], other[3:], atol=5e-6)
    assert error < 1e-10


def test_whitening_like_numpy(spark):
    rows = awkward()
    white, model, error = whitening.whiten(frame(spark, rows))
    check_whitened(white.collect(), usable(rows), model, error, 32)
    assert model.passes > whitening.LANCZOS and model.residual <= whitening.STALLED


def test_whitening_of_more_dimensions_than_the_block(spark):
    rows = made(600, 200, seed=4)
    white, model, error = whitening.whiten(frame(spark, rows), components=8)
    check_whitened(white.collect(), usable(rows, 200), model, error, 8)


def test_whitening_without_variance(spark):
    few = made(3)
    for rows, n, kept in (([], 0, 0), (few[:1] * 5, 5, 0), (few, 3, 2), ([(1, None, *CLASH)], 0, 0)):
        white, model, error = whitening.whiten(frame(spark, rows))
        assert (model.n, len(model.values), white.count()) == (n, kept, n)
        assert error < 1e-4
    assert whitening.whitened_components(frame(spark, few[:1] * 5)).count() == 0


def test_whitened_rows_of_the_query(spark):
    rows = awkward(60)
    got = whitening.whitened_components(frame(spark, rows)).collect()
    assert len(got) == 32 * len(usable(rows))
    one = got[0].asDict()
    assert list(one) == "vec_id component n deviation whitened explained identity_error".split()
    assert {r.component for r in got} == set(range(1, 33)) and {r.n for r in got} == {len(usable(rows))}


def test_large_deviations_stay_exact():
    x = np.array([[1 << 41, 5], [-(1 << 41), 9]], np.int64)
    sums = x.sum(0)
    got = [int(v) for v in whitening.deviations(x, 2, sums)]
    assert got == [sum((2 * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]


def lloyd(rows, count=8, rounds=10, seed=3):
    x = np.floor(1024 * np.array([r[1] for r in rows], np.float64)).astype(np.int64)
    named = [k for k, r in enumerate(rows) if r[0] is not None]
    mark = lambda k: hashlib.sha256(f"{seed}:{rows[k][0]}".encode()).hexdigest()
    order = sorted(named, key=lambda k: (mark(k), x[k].tolist()))[:count]
    centroids = x[order]
    for _ in range(rounds):
        labels = vafile.distances(x, centroids).argmin(1)
        for k in range(len(centroids)):
            if (labels == k).any():
                centroids[k] = x[labels == k].sum(0) // (labels == k).sum()
    far = vafile.distances(x, centroids)
    return centroids, far.argmin(1), far.min(1)


@pytest.mark.parametrize("bits", [2, 6])
def test_clusters_like_plain_rounds(spark, bits):
    rows = awkward()
    got, found = vafile.cluster(frame(spark, rows), bits=bits)
    centroids, labels, far = lloyd(usable(rows))
    assert (found.centroids == centroids).all()
    want = sorted(key((r[0], int(k), int(d))) for r, k, d in zip(usable(rows), labels, far))
    assert sorted(key((r.id, r.cluster, r.distance)) for r in got.collect()) == want
    assert found.log[0]["moved"] == len(labels)


def test_cells_decide_most_of_separate_clusters(spark):
    rng = np.random.default_rng(8)
    middles = rng.normal(0, 1, (8, 64))
    rows = [(k, (middles[k % 8] + rng.normal(0, 0.02, 64)).tolist(), *CLASH) for k in range(800)]
    got, found = vafile.cluster(frame(spark, rows), rounds=3)
    centroids, labels, _ = lloyd([(r[0], np.float32(r[1])) for r in rows], rounds=3)
    assert (found.centroids == centroids).all()
    # Only clusters that two centroids share leave doubt.
    shared = np.bincount(np.arange(800) % 8, [len(set(labels[b::8])) > 1 for b in np.arange(800) % 8])
    assert found.log[-1]["fetched"] <= shared.sum() < 800


def test_cells_bound_every_distance():
    rng = np.random.default_rng(5)
    rows = rng.integers(-900, 900, (500, 7))
    spread = [
        {"dim": d, "n": 500, "total": float(c.sum()), "squares": float((c * c).sum()), "low": int(c.min()), "high": int(c.max())}
        for d, c in enumerate(rows.T)
    ]
    cells = vafile.cells_of(spread, 4)
    numbers = cells.number(rows)
    assert (vafile.unpack_cells(vafile.pack_cells(numbers, 4), 7, 4) == numbers).all()
    centroids = rng.integers(-900, 900, (5, 7))
    low, high = vafile.bounds(numbers, vafile.tables(cells, centroids))
    reference = np.rint(centroids.mean(0)).astype(np.int64)
    exact = vafile.distances(rows, centroids) - vafile.distances(rows, reference[None, :])
    assert (low <= exact).all() and (exact <= high).all()


def test_ties_go_to_the_smaller_centroid(spark):
    """Equal start vectors: the later ones stay empty and keep their place."""
    rows = [(k, [0.5] * 64, *CLASH) for k in range(20)]
    got, found = vafile.cluster(frame(spark, rows))
    assert {(r.cluster, r.distance) for r in got.collect()} == {(0, 0)}
    assert found.centroids.tolist() == [[512] * 64] * 8


def test_few_or_no_vectors(spark):
    few = made(3)
    got = vafile.clustered(frame(spark, few)).collect()
    assert sorted((r.vec_id, r.distance, r.cluster_inertia, r.inertia) for r in got) == [(k, 0, 0, 0) for k in range(3)]
    for rows in ([], [(1, None, *CLASH)], [(2, [1.0], *CLASH)]):
        empty = vafile.clustered(frame(spark, rows))
        assert empty.count() == 0
        assert empty.columns == "vec_id cluster distance cluster_inertia inertia centroid_sha256".split()


def test_numbers_beyond_the_exact_range_are_refused():
    import pyarrow as pa

    with pytest.raises(ValueError, match="exceeds"):
        vectors.whole_rows(pa.array([[1e30, 0.0]]), 2, 64)
