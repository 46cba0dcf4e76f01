"""Registered SQL, the pipeline's stages and the entry points."""

from collections import Counter

import corpus_pipeline
import pytest
from compare import compare, duck_connect

from hirebook.llm.catalog import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    r = compare(QUERIES[name](spark, SF), duck_connect(SF), ORACLE_SQL[name])
    assert r["ok"], r


def test_all_are_registered():
    import __spark_entry__ as E
    assert {*QUERIES, "pipeline"} <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_against_its_operators_in_plain_python(spark):
    """Each stage's decision, followed document by document."""
    import public_tokenizers
    from hirebook.llm import bpe, exact_dedup, mil_quality, simhash
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    at = docs
    model = mil_quality.train(docs, spark.read.parquet(f"{d}/labels.parquet"))
    good = {r.doc_id for r in mil_quality.score(docs, model).collect() if r.predicted}
    stages = []
    for name, stage in corpus_pipeline.STAGES:
        at = corpus_pipeline.materialise(stage(spark, at, d), "test-stage")
        stages.append(at)
        if name != "bpe":
            assert at.columns == docs.columns
    kept = [Counter(r.doc_id for r in x.select("doc_id").collect()) for x in stages]
    assert set(kept[0]) == good
    low = {}
    for i in good:
        low.setdefault(exact_dedup_text(rows[i].text), []).append(i)
    assert set(kept[1]) == {max(x) for x in low.values()}
    fp = {i: simhash.fingerprint((rows[i].text or "").encode(), 4) for i in kept[1]}
    group = {i: i for i in fp}
    for a in sorted(fp):
        for b in sorted(fp):
            if a < b and bin(fp[a] ^ fp[b]).count("1") <= 4 and group[a] != group[b]:
                low_, high = sorted((group[a], group[b]))
                group = {k: low_ if g == high else g for k, g in group.items()}
    assert set(kept[2]) == {i for i, g in group.items() if g == i}
    assert set(kept[3]) == set(kept[2]) and max(kept[3].values()) <= 2
    coder = bpe.encoder(open(public_tokenizers.path("word_bpe_49k.json"), "rb").read())
    for r in stages[4].collect():
        assert bytes(r.ids) == coder.encode(rows[r.doc_id].text)
    assert kept[4] == kept[3]
    run = Counter(r.doc_id for r in corpus_pipeline.run(spark, d).select("doc_id").collect())
    assert run == kept[4]


def exact_dedup_text(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def test_stages_take_empty_tables(spark):
    d = "/root/testdata/sf0.001"
    at = spark.read.parquet(f"{d}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        at = corpus_pipeline.materialise(stage(spark, at, d), "test-stage")
    assert at.count() == 0
