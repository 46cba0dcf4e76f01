import numpy as np
import pytest

from hirebook.llm import whitening as W


def brute(rows, k=32, scale=64, shift=1_000_000):
    """n, deviations, eigenvalues over the trace and whitened rows (to the sign) by a dense solver."""
    x = [[int(np.floor(scale * np.float64(c))) + shift for c in v] for _, v in rows]
    n, total = len(x), [sum(col) for col in zip(*x)]
    dev = [sum((n * a - s) ** 2 for a, s in zip(r, total)) for r in x]
    y = np.array([[(n * a - s) / n for a, s in zip(r, total)] for r in x])
    e, q = np.linalg.eigh(y.T @ y / n)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    e, q = e[e > 1e-12 * e[0]], q[:, e > 1e-12 * e[0]]
    return n, dev, e / (np.square(y).sum() / n), y @ (q / np.sqrt(e))


def check(spark, rows, extra_rows=(), near=1e-7, **settings):
    df = spark.createDataFrame([(i, [float(c) for c in v], 3) for i, v in rows] + list(extra_rows), "vec_id long, embedding array<double>, component int").repartition(5)
    got = W.whiten(df, **settings).toPandas()
    n, dev, explained, white = brute(rows, settings.get("k", 32))
    assert len(got) == len(rows) * len(explained) and (got["n"] == n).all()
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-9
    m = got.pivot_table(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.abs(np.abs(m) - np.abs(white)).max() < near
    sign = np.sign((m * white).sum(axis=0))
    assert np.abs(m - white * sign).max() < near
    assert np.allclose(got.groupby("component")["explained"].first(), explained, rtol=1e-9)
    assert got.groupby("vec_id")["deviation"].first().tolist() == dev


def rows_of(x):
    return list(enumerate(x))


def test_flat_spectrum_beyond_a_few_directions(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((700, 40)) * np.concatenate([[9, 7, 5, 4, 3, 2], np.linspace(1, 0.8, 34)]) + rng.uniform(-3, 3, 40)
    check(spark, rows_of(x), extra_rows=[(900, None, 1), (901, [], 1), (902, [1.0] * 39 + [None], 1), (903, [float("nan")] * 40, 1),
                                         (904, [1.0] * 39 + [float("inf")], 1), (905, [1.0, 2.0], 1), (906, [1e300] * 40, 1)], k=6, extra=4)


def test_every_component_of_few_dimensions(spark):
    rng = np.random.default_rng(2)
    check(spark, rows_of(rng.standard_normal((200, 5)) @ rng.standard_normal((5, 5)) * 3), k=32)


def test_a_hot_third_of_equal_rows(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((300, 24)) * np.geomspace(8, 1, 24)
    x[:100] = x[0]
    check(spark, rows_of(x), k=8, extra=2)


def test_block_widens_where_eigenvalues_tie(spark):
    # 30 equal eigenvalues: any basis of them is right, the whitened covariance must be the identity
    x = np.concatenate([np.eye(30) * 2, -np.eye(30) * 2])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = W.whiten(df, k=4, extra=2, degree=3, sweeps=2).toPandas()
    assert len(got) == 60 * 4 and got["identity_error"].max() < 1e-9 and np.allclose(got["explained"], 1 / 30)


def test_constant_dimensions_have_no_component(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.standard_normal((50, 3)) * 3, np.ones((50, 4))], axis=1)
    check(spark, rows_of(x), k=7)


def test_large_values_stay_exact(spark):
    x = [[1e9, 5.0], [-1e9, 6.0], [3e8, 7.0], [0.0, -1.0]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.deviation for r in W.whiten(df, k=2).collect()}
    want = brute(rows_of(x))[1]
    assert got == {i: d if d < 1 << 63 else None for i, d in enumerate(want)} and None in got.values()


def test_rows_that_give_nothing(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None), (2, [])]):
        assert W.whiten(spark.createDataFrame(rows, schema)).collect() == []


def test_repeats_and_null_ids_are_rows_of_their_own(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [0.0, 2.0]), (4, [3.0, 1.0])]
    got = W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 8 and {r.n for r in got} == {4} and sum(r.vec_id is None for r in got) == 2


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_query_on_the_whole_table(spark, sf):
    from hirebook.llm.catalog import QUERIES

    rows = [(r.vec_id, np.array(r.embedding, np.float64)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()]
    got = QUERIES["op13_whitening"](spark, sf).toPandas().sort_values(["vec_id", "component"])
    n, dev, explained, white = brute(rows)
    m = got["whitened"].to_numpy().reshape(len(rows), 32)
    assert np.abs(m - white * np.sign((m * white).sum(axis=0))).max() < 1e-7
    assert got["deviation"].to_numpy().reshape(len(rows), 32)[:, 0].tolist() == dev and (got["n"] == n).all()
    assert np.allclose(got["explained"].to_numpy()[:32], explained, rtol=1e-9) and got["identity_error"].iloc[0] < 1e-9
