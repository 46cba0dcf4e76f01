import numpy as np
import pytest
from pyspark.sql import functions as F

from hirebook.llm import hard_negatives as H

INT_MAX = 1 << 62


def brute(rows, anchors=lambda i: i % 10 == 0, positives=5, negatives=5, scale=256):
    """The rows asked for, straight from the definition; rows are (id, vector, label)."""
    good = [(i, [int(np.floor(scale * np.float64(c))) for c in v], y) for i, v, y in rows
            if i is not None and y is not None and v and all(c is not None and np.isfinite(c) and abs(c) * scale < 1 << 31 for c in v)]
    out = []
    for k, (i, x, y) in enumerate(good):
        if not anchors(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, w)), j, z == y) for m, (j, w, z) in enumerate(good) if m != k)
        for p, j, _ in [s for s in scored if s[2]][:positives]:
            fit = [s for s in scored if not s[2] and 80 * -p <= 100 * -s[0] <= 100 * -p][:negatives]
            out += [(i, j, r, n, -p, -s) for r, (s, n, _) in enumerate(fit, 1)]
    return sorted(out)


def frame(spark, rows, labels="int"):
    return spark.createDataFrame([(i, v, y, 1, 2) for i, v, y in rows], f"vec_id long, embedding array<double>, label {labels}, row int, cell int").repartition(5)


def mined(df, **settings):
    return sorted(tuple(r) for r in H.hard_negatives(df, F.col("vec_id") % 10 == 0, **settings).collect())


def clustered(n=600, dim=12, seed=0):
    rng = np.random.default_rng(seed)
    c = rng.standard_normal((9, dim))
    of = rng.integers(0, 9, n)
    x = (c[of] + rng.normal(0, 0.25, (n, dim))) * rng.choice([0.2, 1.0, 3.0], (n, 1))
    x[: n // 3] = c[0] + rng.normal(0, 0.02, (n // 3, dim))
    x[:40] = x[0]
    return [(i, v.tolist(), int(y)) for i, v, y in zip(rng.permutation(n), x, (of + (rng.random(n) < 0.4)) % 4)]


@pytest.mark.parametrize("settings", [{}, {"block": 16, "cell": 32, "refs": 4}, {"block": 64, "cell": 64}])
def test_against_brute_force(spark, settings):
    rows = [(int(i), v, y) for i, v, y in clustered()]
    extra = [(5000, None, 1), (5010, [1.0] * 11 + [None], 1), (5020, [float("nan")] * 12, 1), (5030, [float("inf")] * 12, 2), (5040, [1.0] * 12, None),
             (None, [1.0] * 12, 1), (5050, [0.0] * 12, 3), (5060, [], 1), (5070, [1e12] * 12, 1)]
    got = mined(frame(spark, rows + extra + [(5080, [1.0, 2.0], 1)]), **settings)
    assert got and got == brute(rows + extra)


def test_repeated_ids_are_rows_of_their_own(spark):
    rows = [(10, [1.0, 0.0], 1), (10, [1.0, 0.0], 1), (3, [0.9, 0.1], 2), (3, [0.9, 0.1], 2), (4, [0.9, 0.1], 2), (20, [0.0, 1.0], 3)]
    assert mined(frame(spark, rows)) == brute(rows)


def test_scores_beyond_doubles_are_exact(spark):
    big = [float((1 << 22) + 1), float((1 << 22) + 3), 0.0]
    rows = [(0, big, 1), (1, [big[0], big[1] + 1 / 256, 1.0], 1)] + [(2 + k, [big[0], big[1] - k / 256, 0.5], 2) for k in range(6)]
    got = mined(frame(spark, rows))
    assert got == brute(rows) and max(r[4] for r in got) > 1 << 53


def test_labels_of_text_few_rows_and_none(spark):
    rows = [(10, [1.0, 0.5], "a"), (2, [1.0, 0.4], "a"), (7, [0.9, 0.5], "b"), (8, [0.0, 0.0], "b")]
    assert mined(frame(spark, rows, "string")) == brute(rows)
    assert mined(frame(spark, rows[:2], "string")) == [] and mined(frame(spark, rows, "string").limit(0)) == []


def test_negative_and_zero_scores(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [-1.0, 0.0], 1), (2, [0.0, 1.0], 1), (3, [0.0, -1.0], 2), (4, [-0.5, 0.0], 2), (5, [0.0, 2.0], 3)]
    assert mined(frame(spark, rows)) == brute(rows) != []
    zero = [(i, [0.0, 0.0], i % 2) for i in (0, 1, 2, 3, 10)]
    assert mined(frame(spark, zero)) == brute(zero) != []


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(1)
    c = rng.standard_normal((6, 8))
    x = np.floor(256 * (np.repeat(c, 200, axis=0) + rng.normal(0, 0.15, (1200, 8))) * rng.uniform(0.3, 2, (1200, 1)))
    norm = np.linalg.norm(x, axis=1)
    refs = H.references(x, 6)
    theta = H.angles(x, norm, refs)
    for a in range(0, 1200, 40):
        score = x @ x[a]
        down, up = H.score_bounds(theta[a], norm[a], theta, theta, norm, norm)
        assert (down <= score).all() and (score <= up).all()
        low, high = int(np.sort(score)[-30]), int(np.sort(score)[-10])
        for r in range(len(refs)):
            order = np.argsort(theta[:, r])
            first, last = H.window(theta[a, r], norm[a], theta[order, r], norm.min(), norm.max(), low, high)
            inside = np.nonzero((score[order] >= low) & (score[order] <= high))[0]
            assert first <= inside.min() and inside.max() < last
    # rows of other clusters fall outside most windows
    assert np.mean((H.score_bounds(theta[0], norm[0], theta, theta, norm, norm)[1] >= np.sort(x @ x[0])[-30])) < 0.5
    assert H.window(0.1, 1.0, np.array([0.0, 0.5]), 1.0, 1.0, -INT_MAX, INT_MAX) == (0, 2)
