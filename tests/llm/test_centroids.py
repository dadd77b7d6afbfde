"""Centroid clustering against plain Python."""

import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest

from playlens.llm import centroids

SCHEMA = "vec_id long, v string, cluster string, distance long, embedding array<double>"


def brute(rows, k, rounds, dims, scale):
    sound = [(i, v) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    floors = lambda v: [math.floor(Fraction(x) * scale) for x in v]
    kept = [(i, floors(v)) for i, v in sound]
    digest = lambda i: hashlib.sha256(("1:" + ("" if i is None else str(i))).encode()).hexdigest()
    centers = [floors(v) for _, v in sorted((digest(i), v) for i, v in sound)[:k]]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for turn in range(rounds + 1):
        near = [min((square(v, c), n) for n, c in enumerate(centers)) for _, v in kept]
        if turn < rounds:
            for n in range(len(centers)):
                mine = [v for (_, v), (_, m) in zip(kept, near) if m == n]
                if mine:
                    centers[n] = [sum(c) // len(mine) for c in zip(*mine)]
    top = centroids.LARGEST
    inertia = {n: sum(min(d, top) for d, m in near if m == n) for n in range(len(centers))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted(((i, n, min(d, top), min(inertia[n], top), min(sum(inertia.values()), top), sha[n]) for (i, _), (d, n) in zip(kept, near)), key=repr)


def result(spark, rows, **how):
    df = spark.createDataFrame([(i, "x", "y", 3, v) for i, v in rows], SCHEMA)
    return sorted((tuple(r) for r in centroids.clusters(df, **how).collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=5).round(1).tolist()) for i in range(120)]
    rows += [(200 + i, rows[3][1]) for i in range(40)] + [rows[7], (None, rows[9][1]), (None, [0.0] * 5)]
    rows += [(300, None), (301, [1.0] * 4), (302, [1.0, None, 0.0, 0.0, 0.0]), (303, [float("nan")] * 5), (304, [float("inf")] * 5), (305, [])]
    how = dict(k=6, rounds=3, dims=5, scale=4)
    assert result(spark, rows, **how) == brute(rows, 6, 3, 5, 4)


def test_ties_few_vectors_and_huge_numbers(spark):
    how = dict(k=4, rounds=2, dims=2, scale=64)
    for rows in (
        [(i, [float(i % 2), 0.0]) for i in range(9)],
        [(1, [0.5, -0.5])],
        [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [1.0, 1.0]), (4, [3e9, -3e9]), (5, [1.7e308, 1.7e308]), (6, [0.1, 0.2])],
    ):
        assert result(spark, rows, **how) == brute(rows, 4, 2, 2, 64)
    assert result(spark, [], **how) == [] and result(spark, [(1, None)], **how) == []


def test_the_walk_may_stop_early():
    rng = np.random.default_rng(5)
    centers, vectors = rng.integers(-900, 900, (40, 3)), rng.integers(-900, 900, (500, 3))
    near, distance = centroids.SortedLists(centers).nearest(vectors)
    full = ((vectors[:, None, :] - centers[None]) ** 2).sum(axis=2)
    assert (near == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()


def test_limbs_add_up():
    for value in (0, 1, -1, (1 << 40) - 1, -(1 << 40), 12345678901234567890123, -(10 ** 300)):
        assert sum(part << (centroids.LIMB * place) for place, part in centroids.limbs(value)) == value
