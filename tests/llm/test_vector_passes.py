import numpy as np
import pytest

from helpers import smallest_reachable
from hirebook.llm import vector_passes as V


def brute(rows, threshold=0.9):
    """(n_links, component) per row straight from the definition."""
    def good(i, v):
        return i is not None and v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)
    ok = [good(i, v) for i, v in rows]
    n = len(rows)
    linked = np.eye(n, dtype=bool)
    for a in range(n):
        for b in range(a):
            if ok[a] and ok[b] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
                linked[a, b] = linked[b, a] = (x @ y) / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold
    root = smallest_reachable(linked)
    ids = [min((rows[j][0] for j in range(n) if root[j] == root[i]), default=None) if rows[i][0] is not None else None for i in range(n)]
    return [(rows[i][0], int(linked[i].sum()) - 1, ids[i]) for i in range(n)]


def data():
    rng = np.random.default_rng(3)
    rows = []
    for c in rng.standard_normal((25, 16)):
        for _ in range(int(rng.integers(1, 14))):
            rows.append(c * rng.uniform(0.5, 3) + rng.normal(0, 0.12, 16))
    hot = rng.standard_normal(16)
    rows += [hot] * 30 + [hot + rng.normal(0, 0.02, 16) for _ in range(40)]
    out = [(int(i), [float(x) for x in v]) for i, v in zip(rng.permutation(len(rows)), rows)]
    return out + [(900, None), (901, []), (902, [0.0] * 16), (903, [1.0] * 15 + [None]), (904, [1.0] * 15 + [float("nan")]),
                  (905, [float("inf")] + [1.0] * 15), (None, [float(x) for x in hot]), (906, [1.0, 0.0]), (907, [2.0, -0.0]), (908, [1e-200, 0.0])]


@pytest.mark.parametrize("window,tile", [(256, 1024), (16, 8)])
def test_against_brute_force(spark, window, tile):
    rows = data()
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, component_id int").repartition(6)
    got = sorted(((r[0], r[1], r[2]) for r in V.near_vectors(df, window=window, tile=tile, miss=1e-4).collect()), key=str)
    assert got == sorted(brute(rows), key=str)


def test_kept_and_repeats(spark):
    rows = [(4, [1.0, 0.0]), (4, [1.0, 0.0]), (2, [0.0, 1.0]), (7, [0.1, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((tuple(r) for r in V.near_vectors(df).collect()), key=str)
    assert got == sorted([(4, 1, 4, True), (4, 1, 4, True), (2, 1, 2, True), (7, 1, 2, False)], key=str)
    assert V.near_vectors(df.limit(0)).collect() == []


def test_more_vectors_take_more_passes():
    few, many = V.n_passes(10_000, 0.9, 256, 0.005), V.n_passes(10_000_000, 0.9, 256, 0.005)
    assert 1 <= few < many and V.n_passes(100, 0.9, 256, 0.005) == 1


def test_recall_on_the_table(spark):
    from hirebook.llm.catalog import QUERIES

    d = "/root/testdata/sf0.1"
    vec = spark.read.parquet(f"{d}/embeddings.parquet").collect()
    x = V.unit([np.array(r.embedding, float) for r in vec])
    want = {r.vec_id: int(n) for r, n in zip(vec, (x @ x.T >= 0.9).sum(axis=1) - 1)}
    got = {r.vec_id: r.n_links for r in QUERIES["op4_vector_passes"](spark, d).collect()}
    assert set(got) == set(want) and all(got[i] <= want[i] for i in want)
    assert sum(got.values()) >= 0.9 * sum(want.values())


def hot_third(n=1500, cosine=0.8, pairs=200, dim=128):
    """Vectors of which a third are at ``cosine`` to each other, and one partner
    just over the threshold for each of the first ``pairs`` hot and cold ones."""
    rng = np.random.default_rng(5)
    c, e, cold = V.unit(rng.standard_normal((1, dim))), rng.standard_normal((n, dim)), V.unit(rng.standard_normal((2 * n, dim)))
    x = np.concatenate([cosine**0.5 * c + (1 - cosine) ** 0.5 * V.unit(e - (e @ c.T) * c), cold])
    of = np.concatenate([np.arange(pairs), n + np.arange(pairs)])
    r = rng.standard_normal((len(of), dim))
    r = V.unit(r - (r * x[of]).sum(axis=1, keepdims=True) * x[of])
    return np.concatenate([x, 0.9005 * x[of] + (1 - 0.9005**2) ** 0.5 * r]), of


@pytest.mark.parametrize("exact", [True, False])
def test_links_in_a_hot_cluster(spark, monkeypatch, exact):
    if not exact:
        monkeypatch.setattr(V, "exact_pays", lambda n, passes, window: False)
    x, of = hot_third()
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(8)
    component = {r.vec_id: r.component_id for r in V.near_vectors(df, threshold=0.9, window=16).collect()}
    found = np.array([component[len(x) - len(of) + i] == component[int(p)] for i, p in enumerate(of)]).reshape(2, -1)
    assert found[0].mean() >= 0.995 and found[1].mean() >= 0.995


def test_shared_bits():
    keys = np.sort(np.array([-2**63, -2**63 + 1, -1, 0, 1, 2**62, 2**63 - 1, 2**63 - 1], np.int64))
    assert V.shared_bits(keys, 1).tolist() == [63, 1, 0, 63, 1, 2, 64]


def test_dense_vectors_are_compared_as_often_as_their_density_asks():
    assert V.exact_pays(3000, 1, 256) and not V.exact_pays(4000, 1, 256) and V.exact_pays(10**9, float("inf"), 256)
