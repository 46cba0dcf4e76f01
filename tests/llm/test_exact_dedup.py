import hashlib
import random

import pytest

from hirebook.llm import exact_dedup as X


def low(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


@pytest.mark.parametrize("keep,best", [("largest", max), ("smallest", min)])
@pytest.mark.parametrize("runs,bits", [(1, 1), (8, 1), (64, 2), (64, 4)])
def test_against_brute_force(spark, keep, best, runs, bits):
    rnd = random.Random(runs)
    texts = ["", None, "A", "a", "É", "é", "hot", "HOT", "x" * 50000] + [f"t{i}" for i in range(40)]
    rows = [(i, rnd.choice(texts) if i % 3 else "hot", "other") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, run string").repartition(5)
    group = {}
    for i, t, _ in rows:
        group.setdefault(low(t), []).append(i)
    want = {i: (best(group[low(t)]), len(group[low(t)]), best(group[low(t)]) == i, hashlib.sha256(low(t).encode()).hexdigest())
            for i, t, _ in rows}
    got = {r[0]: tuple(r[1:]) for r in X.exact_groups(df, keep=keep, runs=runs, bits=bits).collect()}
    assert got == want
    left = X.drop_exact_copies(df, keep=keep)
    assert left.columns == df.columns and sorted(r[0] for r in left.collect()) == sorted(i for i in want if want[i][2])


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "a"), (1, "a"), (1, "b"), (None, "A"), (None, "z"), (None, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in X.exact_groups(df).collect()), key=str)
    assert got == sorted([(1, 1, 3, True), (1, 1, 3, True), (1, 1, 1, True), (None, 1, 3, False), (None, None, 2, True),
                          (None, None, 2, True)], key=str)
    assert sorted(((r[0], r[1]) for r in X.drop_exact_copies(df).collect()), key=str) == sorted([(1, "a"), (1, "b"), (None, "z")], key=str)


@pytest.mark.parametrize("most", [200_000, 0])
def test_whole_rows_are_shuffled_once_at_most(spark, monkeypatch, most, tmp_path):
    from hirebook.llm import common

    monkeypatch.setattr(X, "without", lambda rows, gone, keys: common.without(rows, gone, keys, most))
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    spark.createDataFrame([(i, f"text {i % 7}", "x" * 20) for i in range(50)], "doc_id long, text string, __id string").write.parquet(str(tmp_path / "docs"))
    left = X.drop_exact_copies(spark.read.parquet(str(tmp_path / "docs")))
    assert sorted(r.doc_id for r in left.collect()) == list(range(43, 50))
    plan = left._jdf.queryExecution().executedPlan().toString()
    spark.conf.set(threshold, before)
    assert plan.split("Initial Plan")[-1].count("Exchange hashpartitioning") == (2 if most == 0 else 0)  # the copies' digests and the rows


def test_short_digests_that_collide_do_not_merge(spark, monkeypatch):
    monkeypatch.setattr(X.F, "xxhash64", lambda *c: X.F.lit(7).cast("long"))
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "A")], "doc_id long, text string")
    assert {r[0]: r[1] for r in X.exact_groups(df, runs=4).collect()} == {1: 3, 2: 2, 3: 3}


def test_no_python_in_the_plan(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = X.exact_groups(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_empty_table(spark):
    assert X.exact_groups(spark.createDataFrame([], "doc_id long, text string")).collect() == []
