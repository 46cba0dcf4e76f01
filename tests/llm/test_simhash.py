import numpy as np
import pytest
import xxhash

from helpers import smallest_reachable
from hirebook.llm import simhash as S
from hirebook.llm.common import connected_components


def plain_fingerprint(text, k):
    """Straight from the definition."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    w = [x for x in low.split(" ") if x]
    s = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


TEXTS = ["", None, "a", "A b", "one two three four", "One two\tTHREE  four five six é É", "x " * 300,
         "\x1c a\x1cb c d", " ".join(f"w{i % 37}" for i in range(900))]


@pytest.mark.parametrize("k", [1, 4])
def test_fingerprint_is_the_definition(k):
    for t in TEXTS:
        assert S.fingerprint(None if t is None else t.encode(), k) == plain_fingerprint(t, k)


def test_every_point_has_one_anchor_within_the_radius():
    _, _, excess = S._tables(2)
    assert ((excess == 0).sum(axis=1) == 1).all()


def points():
    rng = np.random.default_rng(1)
    rows = []
    for x in rng.integers(0, 2**63, 150).tolist():
        for _ in range(int(rng.integers(1, 8))):
            rows.append(x ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 5)), replace=False)))
    near = rng.choice(64, 14, replace=False)
    for _ in range(1500):  # a dense group
        rows.append(rows[0] ^ sum(1 << int(b) for b in rng.choice(near, int(rng.integers(0, 8)), replace=False)))
    return np.unique(np.array(rows, np.uint64))


@pytest.mark.parametrize("t,tile", [(4, 16384), (4, 200), (3, 16384), (1, 16384)])
def test_links_connect_what_brute_force_connects(spark, t, tile):
    fp = points()
    linked = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= t
    want = smallest_reachable(linked)
    signed = [int(x) for x in fp.view(np.int64)]
    at = {x: i for i, x in enumerate(signed)}
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    replicas = S._tiled(S._replicas(df, -(-t // 2)), tile, 1 << 10)
    links = S._links(replicas.repartition("anchor", "tile").sortWithinPartitions("anchor", "tile"), t).distinct()
    assert all(linked[at[a], at[b]] for a, b in links.collect())
    got = np.arange(len(fp))
    found = {at[r[0]]: at[r[1]] for r in connected_components(links).collect()}
    for i, c in found.items():
        got[i] = c
    assert ((got[:, None] == got[None, :]) == (want[:, None] == want[None, :])).all()


def test_documents(spark):
    long = " ".join(f"w{i}" for i in range(400))
    rows = [(9, long, "x"), (3, long.upper(), "y"), (4, long + " tail", None), (5, None, "x"), (6, "", "x"), (7, " ", "x"),
            (8, "entirely different words here", "x"), (8, "entirely different words here", "x"), (None, "alone in this world", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = S.simhash_components(df).collect()
    assert len(got) == len(rows)
    by = {r[0]: r for r in got}
    assert by[9].fingerprint == by[3].fingerprint == f"{plain_fingerprint(long, 4):016x}"
    assert by[9].component_id == by[3].component_id == by[4].component_id == 3
    assert {by[i].component_id for i in (5, 6, 7)} == {5} and by[5].fingerprint == "0" * 16
    assert by[8].component_id == 8 and by[None].component_id is None
    kept = S.drop_near_copies(df)
    assert kept.columns == df.columns
    assert sorted((r[0] for r in kept.collect()), key=str) == [3, 5, 8, 8, None]


@pytest.mark.parametrize("most", [200_000, 0])
def test_rows_of_one_id_go_or_stay_by_their_text(spark, monkeypatch, most):
    from hirebook.llm import common

    monkeypatch.setattr(S, "without", lambda rows, gone, keys: common.without(rows, gone, keys, most))
    df = spark.createDataFrame([(1, "the same text of all", 1), (5, "the same text of all", 2), (5, "quite another one here", 3), (5, None, 4), (7, "", 5)],
                               "doc_id long, text string, h int")
    assert sorted(r.h for r in S.drop_near_copies(df).collect()) == [1, 3, 4]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.simhash_components(df).collect() == [] and S.drop_near_copies(df).collect() == []
