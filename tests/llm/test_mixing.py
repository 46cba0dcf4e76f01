import math
import random
from collections import Counter, defaultdict

import pytest

from hirebook.llm import mixing as M


def test_exponent_meets_entropy():
    tokens = {"a": 900, "b": 90, "c": 9, "d": 1}
    for share in (0.3, 0.6, 0.9):
        mix = M.solve(tokens, target_entropy=share * math.log(4))
        assert M.entropy(mix.weights) == pytest.approx(share * math.log(4), abs=1e-9)
        norm = sum(t**mix.exponent for t in tokens.values())
        assert all(mix.weights[s] == pytest.approx(t**mix.exponent / norm) for s, t in tokens.items())


def test_exponent_meets_repetition_limit():
    tokens = {"a": 900, "b": 90, "c": 9, None: 3, "empty": 0}
    mix = M.solve(tokens, max_repeats=2)
    assert max(mix.epochs.values()) <= 2 and min(mix.epochs.values()) >= 0.99
    assert M.solve(tokens, max_repeats=4, budget=1500).exponent < M.solve(tokens, max_repeats=2, budget=1500).exponent
    with pytest.raises(ValueError):
        M.solve(tokens, max_repeats=2, budget=5000)
    assert M.solve(tokens).weights["a"] == pytest.approx(900 / 1002)
    assert M.solve({}).weights == {} and M.solve({"x": 0}, max_repeats=2).epochs == {"x": 1.0}


def docs(spark, n=3000):
    rnd = random.Random(4)
    rows = []
    for i in range(n):
        source = rnd.choices(["hot", "b", "c", None, "empty"], [60, 20, 10, 9, 1])[0]
        text = None if source == "empty" else " ".join("w" * rnd.randint(1, 40))
        rows.append((i, text, source, i))
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string, copies long").repartition(7)


@pytest.mark.parametrize("blocks,targets", [(8, {"max_repeats": 3}), (4096, {"max_repeats": 1.3}), (8, {"budget": 20000}),
                                            (2, {"target_entropy": 1.2, "budget": 50000})])
def test_realised_mixture_against_brute_force(spark, blocks, targets):
    rows, df = docs(spark)
    out = M.mixture(df, blocks=blocks, **targets)
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == len(rows)
    tokens, members = Counter(), defaultdict(list)
    for i, t, s, _ in rows:
        n = len((t or "").split())
        assert got[i].n_tokens == n
        tokens[s] += n
        members[s].append((i, n))
    mix = M.solve(dict(tokens), **targets)
    plan = M.Plan(mix, None, 0, 7, blocks)
    for s, own in members.items():
        if not tokens[s]:
            assert all(got[i].copies == 1 for i, _ in own)
            continue
        full, rest = divmod(mix.budgets[s], tokens[s])
        keys = {r[0]: r[1] for r in spark.createDataFrame(own, "id long, n long").select(
            "id", M.epoch_key(plan, M.F.lit(s).cast("string"), M.F.col("id"), M.F.lit(full).cast("long"))).collect()}
        want, left = {}, rest
        for i, n in sorted(own, key=lambda x: keys[x[0]]):
            if n > left:
                left = -1
            want[i] = full + (left >= 0 and rest > 0)
            left -= n if left >= 0 else 0
        assert {i: got[i].copies for i, _ in own} == want
        spent = sum(got[i].copies * n for i, n in own)
        assert mix.budgets[s] - 40 < spent <= mix.budgets[s]


def test_realise_repeats_rows(spark):
    rows, df = docs(spark, 400)
    want = Counter()
    for r in M.mixture(df, max_repeats=2.5).collect():
        want[r.doc_id] = r.copies
    out = M.realise(df, max_repeats=2.5)
    assert out.columns == df.columns
    assert Counter(r.doc_id for r in out.collect()) == want and min(want.values()) >= 1


def test_edges(spark):
    schema = "doc_id long, text string, source string"
    assert M.mixture(spark.createDataFrame([], schema), max_repeats=2).collect() == []
    df = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "x"), (None, "c", None), (None, None, None), (2, "", "y")], schema)
    assert [r.copies for r in M.mixture(df, max_repeats=1.0).collect()] == [1] * 5
