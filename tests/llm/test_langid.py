import numpy as np
from pyspark.sql import functions as F

from hirebook.llm import langid as G
from hirebook.llm.catalog import QUERIES


def test_grams_cover_the_whole_text_and_chunks_agree(monkeypatch):
    text = "Der schöne Tag, 123 und die Nacht!! " * 50 + "ñandú"
    at, n = G.grams(text)
    low = [c if c.isalpha() else " " for c in text.lower()]
    letters = sum(c != " " for c in low)
    spaces = sum(a == " " and (i == 0 or low[i - 1] != " ") for i, a in enumerate(low))
    total = letters + spaces
    assert n.sum() == 3 * total - 3
    assert len(G.grams(None)[0]) == 0
    assert (G.grams("abc")[0] == G.grams("ABC")[0]).all()


def test_vectors_have_length_one():
    idf = np.ones(G.DIM, np.float32)
    assert abs((G.vector(*G.grams("some text"), idf) ** 2).sum() - 1) < 1e-6


def test_several_centroids_and_rejection():
    rng = np.random.default_rng(1)
    samples = []
    for lang, sets in {"aa": [range(0, 40), range(100, 140)], "bb": [range(50, 90)]}.items():
        for s in sets:
            for _ in range(60):
                at = np.sort(rng.choice(np.array(s), 30, replace=False))
                samples.append((lang, at, rng.integers(1, 5, 30)))
    m = G.fit(samples, clusters=2)
    assert m.langs.count("aa") == 2 and set(m.langs) == {"aa", "bb"}
    assert np.allclose(np.linalg.norm(m.centroids, axis=1), 1, atol=1e-5)
    x = np.zeros(G.DIM, np.float32)
    x[4000:4030] = 30**-0.5
    assert (m.centroids @ x < m.reject).all()  # far from all of them


def test_frequencies_count_every_text_and_the_sample_ignores_order_and_repeats(spark):
    texts = [f"wort nummer {'abc'[i % 3]} {'x' * (i % 7)}" for i in range(200)] + [None, "", "12"]
    rows = [(None if i % 5 == 0 else i % 9, t, "de" if i % 4 else "nl") for i, t in enumerate(texts)]
    hot = [(None, "immer das gleiche", "de")] * 300  # more than all others together
    df = spark.createDataFrame(rows + hot, "doc_id long, text string, lang string")
    n, counts = G.document_frequencies(df.repartition(7).select("text"))
    want = np.zeros(G.DIM)
    for _, t, _ in rows + hot:
        want[G.grams(t)[0]] += 1
    assert n == 501 and (counts == want).all()  # "12" is one space, the empty ones are nothing
    named = df.select(F.col("lang").alias("_lang"), F.xxhash64("doc_id", "text").bitwiseAND(G.DRAWS - 1).alias("_draw"), F.col("text").alias("_text"))
    all_of = {(r[0], r[1]): r[2] for r in named.collect()}
    smallest = {k: sorted(d for g, d in all_of if g == k)[:20] for k in ("de", "nl")}
    want = sorted((k, d, all_of[k, d]) for k in smallest for d in smallest[k])
    for parts in (1, 6):
        got = G.sample_rows(named.repartition(parts), 20)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    models = [G.train(df.repartition(parts), per_lang=20) for parts in (1, 6)]
    assert models[0].langs == models[1].langs and set(models[0].langs) == {"de", "nl"}
    assert np.allclose(models[0].centroids, models[1].centroids, atol=1e-6) and (models[0].idf == models[1].idf).all()


def test_the_query_against_plain_python(spark):
    """Counts, vectors and cosines by dictionaries; the centroids are the model's."""
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    rows = docs.select("doc_id", "text", "lang", (F.crc32(F.col("doc_id").cast("string")) % 4 == 2).alias("held")).collect()
    m = G.train(docs.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2))

    def counted(text):
        out, low = {}, "".join(c if c.isalpha() else " " for c in (text or "").lower())
        while "  " in low:
            low = low.replace("  ", " ")
        for size in (1, 2, 3):
            for i in range(len(low) - size + 1):
                p = list(map(ord, low[i:i + size]))
                h = p[0] * 2654435761
                if size > 1:
                    h = h * 31 + p[1] * 40503 + 1
                if size > 2:
                    h = h * 31 + p[2] * 9973 + 2
                h = (h + 2**63) % 2**64 - 2**63
                out[((h ^ (h >> 17)) & 0x7FFFFFFF) % G.DIM] = out.get(((h ^ (h >> 17)) & 0x7FFFFFFF) % G.DIM, 0) + 1
        return out

    grams = {r.doc_id: counted(r.text) for r in rows}
    learned = [grams[r.doc_id] for r in rows if not r.held and r.lang is not None]
    df = {}
    for g in learned:
        for p in g:
            df[p] = df.get(p, 0) + 1
    idf = {p: np.log((1 + sum(map(bool, learned))) / (1 + n)) + 1 for p, n in df.items()}
    top = np.log(1 + sum(map(bool, learned))) + 1
    got = {r.doc_id: r for r in QUERIES["op3_langid"](spark, d).collect()}
    for r in rows:
        v = {p: np.log1p(n) * idf.get(p, top) for p, n in grams[r.doc_id].items()}
        size = sum(x * x for x in v.values()) ** 0.5
        cos = [sum(x * c[p] for p, x in v.items()) / size for c in m.centroids]
        assert abs(got[r.doc_id].score - max(cos)) < 1e-4 and cos[m.langs.index(got[r.doc_id].lang_pred)] <= max(cos)
        assert max(c for c, g in zip(cos, m.langs) if g == got[r.doc_id].lang_pred) > max(cos) - 1e-4


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op3_langid"](spark, d).collect()}
    docs = spark.read.parquet(f"{d}/documents.parquet").collect()
    assert len(got) == len(docs)
    held = [r for r in docs if got[r.doc_id].held_out]
    assert len(held) > 150
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_edges(spark):
    schema = "doc_id long, text string, lang string, score long"
    docs = spark.createDataFrame([(i, t, g, i) for i, (t, g) in enumerate([
        ("the cat and the dog", "en"), ("the dog and a bird", "en"), ("der hund und die katze", "de"), ("die katze und der vogel", "de"),
        (None, "en"), ("", "de"), ("12 !?", "en"), ("the x", None)])], schema)
    docs = docs.union(spark.createDataFrame([(0, "the cat and the dog", "en", 0), (None, "und die", None, None)], schema))
    m = G.train(docs)
    got = [(r.doc_id, r.lang_pred, r.score > 0) for r in G.predict(docs, m).collect()]
    assert sorted(got, key=str) == sorted([(0, "en", True), (0, "en", True), (1, "en", True), (2, "de", True), (3, "de", True), (4, "und", False),
                                           (5, "und", False), (6, "und", False), (7, "en", True), (None, "de", True)], key=str)
    nothing = G.train(docs.limit(0))
    assert {r.lang_pred for r in G.predict(docs, nothing).collect()} == {"und"} and G.predict(docs.limit(0), m).collect() == []
    assert G.predict(spark.createDataFrame([(1, "the dog " * 300000)], "doc_id long, text string"), m).collect()[0].lang_pred == "en"
