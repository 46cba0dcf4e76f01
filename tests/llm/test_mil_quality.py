import numpy as np
import pytest

from hirebook.llm import mil_quality as Q


def test_passages_cover_the_whole_text():
    words = [f"w{i}".encode() for i in range(Q.PASSAGE_WORDS * 3 + 5)]
    x = Q.encode(b" ".join(words))
    assert len(x) == 4 and np.isfinite(x).all()
    tail = Q.encode(b" ".join(words[:-1]) + b" !!!!!!!")
    assert (tail[:3] == x[:3]).all() and (tail[3] != x[3]).any()
    assert Q.encode(None).shape == Q.encode(b" \n").shape == (1, Q.WIDTH)


def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    bags = [rng.random((n, Q.WIDTH)).astype(np.float64) for n in (1, 3, 2)]
    y = np.array([1.0, 0, 1])
    size = np.array([len(b) for b in bags])
    x, start = np.concatenate(bags), np.cumsum(size) - size
    m = Q.Model(*(rng.standard_normal(s) * 0.2 for s in ((Q.WIDTH, 5), (5,), (5, 4), (5, 4), (4,), (5,), (1,))))

    def loss():
        z = Q.forward(m, x, start)[0]
        return float(np.mean(np.log1p(np.exp(z)) - y * z))

    for p, g in zip(m.parts(), Q._gradients(m, x, start, y)):
        at = tuple(rng.integers(0, s) for s in p.shape)
        old = p[at]
        p[at] = old + 1e-5
        up = loss()
        p[at] = old - 1e-5
        down = loss()
        p[at] = old
        assert g[at] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_attention_finds_one_bad_passage():
    rng = np.random.default_rng(1)
    bags, y = [], []
    for i in range(400):
        b = rng.normal(0, 0.1, (int(rng.integers(2, 6)), Q.WIDTH)).astype(np.float32)
        y.append(i % 2)
        if not y[-1]:
            b[rng.integers(0, len(b)), :20] += 1
        bags.append(b)
    m = Q.fit(bags[:300], np.array(y[:300]))
    size = np.array([len(b) for b in bags[300:]])
    z = Q.forward(m, np.concatenate(bags[300:]), np.cumsum(size) - size)[0]
    assert ((z >= 0) == np.array(y[300:], bool)).mean() > 0.95


def test_training_documents_are_whole_and_bounded(spark):
    words = {1: 3000, 2: 128 * 5, 3: 128 * 5 + 1, 4: 1, 5: 0, 6: 128 * 20}
    rows = [(i, i % 2, " ".join(["w"] * n).encode()) for i, n in words.items()] + [(8, 0, None)]
    src = spark.createDataFrame(rows, "_id long, _y int, _t binary")
    for most in (8, 40, 48, 200, 10**6):
        got = {r._id: r._t for r in Q.whole_documents(src, most).collect()}
        for y in (0, 1):
            n = [max(1, -(-words.get(i, 0) // Q.PASSAGE_WORDS)) for i in got if i % 2 == y]
            assert sum(n) <= most and all(k <= most // 8 for k in n)
        assert all(bytes(t or b"") == dict((r[0], r[2]) for r in rows)[i] or t is None for i, t in got.items())
    assert len(got) == len(rows)


def plain_train(docs, labels, per_label=1200):
    """``train`` and ``score`` in plain Python: {row: score}."""
    import xxhash

    one = {}
    for i, y in labels:
        if i is not None and y in (0, 1):
            one[i] = min(y, one.get(i, y))
    def order(i):  # Spark's xxhash64(long, 11)
        h = xxhash.xxh64_intdigest(int(i).to_bytes(8, "little", signed=True), 42)
        h = xxhash.xxh64_intdigest((11).to_bytes(4, "little"), h)
        return h - (1 << 64 if h >> 63 else 0), i
    picked = [i for y in (0, 1) for i in sorted((i for i in one if one[i] == y), key=order)[:per_label]]
    text = {}
    for i, t in docs:
        if i in one and t is not None:
            text[i] = min(text.get(i, t.encode()), t.encode())
    known = sorted((str(i), i) for i in picked if i in text)
    bags = [Q.encode(text[i]).astype(np.float16) for _, i in known]
    m = Q.fit(bags, np.array([one[i] for _, i in known]))
    out = {}
    for i, t in docs:
        x = Q.encode((t or "").encode())
        out[i] = 1 / (1 + np.exp(-float(Q.forward(m, x, np.array([0]))[0][0])))
    return out


def test_query_against_plain_python(spark):
    import zlib

    from hirebook.llm.catalog import QUERIES

    d = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{d}/labels.parquet").collect()]
    want = plain_train(docs, [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 3 != 1])
    got = QUERIES["op9_mil_quality"](spark, d).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.5)
        assert r.score == pytest.approx(want[r.doc_id], abs=1e-3)


def test_held_out_accuracy(spark):
    from hirebook.llm.catalog import QUERIES

    d = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op9_mil_quality"](spark, d).collect()}
    assert len(got) == spark.read.parquet(f"{d}/documents.parquet").count()
    labels = [r for r in spark.read.parquet(f"{d}/labels.parquet").collect() if r.doc_id in got and got[r.doc_id].held_out]
    right = [got[r.doc_id].predicted == r.quality for r in labels]
    assert len(right) > 50 and sum(right) / len(right) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 2), (None, "a b", None), (3, "x " * 50000, 3), (3, "x", 3)], "doc_id long, text string, score long")
    none = spark.createDataFrame([], "doc_id long, quality int")
    labels = spark.createDataFrame([(1, 1), (1, None), (2, 0), (3, 1), (None, 0), (7, 1)], "doc_id long, quality int")
    for given in (none, labels):
        m = Q.train(docs, given, epochs=2)
        rows = Q.score(docs, m).collect()
        assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
        kept = Q.drop_low_quality(docs, m)
        assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in rows)
    assert Q.score(docs.limit(0), m).collect() == [] and Q.drop_low_quality(docs.limit(0), m).collect() == []
    carried = Q.score(docs, m, carry=("doc_id", "score"))
    assert carried.columns == ["doc_id", "score", "score", "predicted"] and sorted(r[1] for r in carried.collect() if r[1]) == [1, 2, 3, 3]
