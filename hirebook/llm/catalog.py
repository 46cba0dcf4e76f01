"""The registered queries: thin calls of the operators over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from hirebook.llm.bpe import digests, encode_documents
from hirebook.llm.common import read_table
from hirebook.llm.exact_dedup import exact_groups
from hirebook.llm import langid, warc
from hirebook.llm.hard_negatives import hard_negatives
from hirebook.llm.html_text import extract_pages
from hirebook.llm.line_dedup import drop_repeated_lines
from hirebook.llm.mil_quality import score, train
from hirebook.llm.mixing import mixture
from hirebook.llm.oracle import ORACLE_SQL
from hirebook.llm.secret_ledger import RULES, findings, scan
from hirebook.llm.simhash import simhash_components
from hirebook.llm.vector_passes import near_vectors
from hirebook.llm.whitening import whiten
from hirebook.session import scratch_path

__all__ = ["ORACLE_SQL", "QUERIES"]


def _remainder(col: str, mod: int):
    return F.pmod(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(mod))


def op1_warc(spark, sf_dir):
    """Write every page as a WARC record, read the archives back."""
    path = scratch_path(spark, "warc")
    warc.write_pages(read_table(spark, sf_dir, "pages"), path, least=0)
    read = warc.records(warc.read_archives(spark, path, with_payload=False))

    def page(col):
        return F.expr(f"try_cast(regexp_extract({col}, 'urn:x-page:(.*)', 1) as bigint)")

    return read.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
                       page("refers_to").alias("refers_to"))


def op2_secret_ledger(spark, sf_dir):
    """Secrets of every document, found through a new ledger of its blobs."""
    docs, ledger = read_table(spark, sf_dir, "documents"), scratch_path(spark, "ledger")
    scan(docs, ledger)
    found = findings(docs, ledger)

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["rule"], s["start"], s["end"])), ",")

    def count(rule):
        return F.size(F.filter("spans", lambda s: s["rule"] == rule)).cast("long")

    base = F.filter("spans", lambda s: s["rank"] < 3)
    return found.select("doc_id", *(count(r.name).alias(f"n_{r.name}") for r in RULES[:3]),
                        F.sha2(F.encode(listed(base), "utf-8"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op3_langid(spark, sf_dir):
    """Language of every document, learned from the rows not held out."""
    docs = read_table(spark, sf_dir, "documents")
    held = F.coalesce(_remainder("doc_id", 4) == 2, F.lit(False))
    model = langid.train(docs.where(~held))
    return langid.predict(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score", "outlier")


def op4_vector_passes(spark, sf_dir):
    """Embeddings of cosine 0.9 or more: links, components, kept ones."""
    return near_vectors(read_table(spark, sf_dir, "embeddings"), threshold=0.9)


def op5_simhash_near_dedup(spark, sf_dir):
    """SimHash components: 4-word shingles, at most 4 differing bits."""
    return simhash_components(read_table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op6_exact_dedup(spark, sf_dir):
    """Groups of texts equal after lower-casing A-Z; the largest doc_id stays."""
    return exact_groups(read_table(spark, sf_dir, "documents"), keep="largest")


def op7_html_text(spark, sf_dir):
    """Main text of every page from its host's consensus path."""
    return extract_pages(read_table(spark, sf_dir, "pages"))


def op8_mixing(spark, sf_dir):
    """How often each document is taken: the flattest source weights that
    read no source more than 1.5 times, the least repeated one once."""
    return mixture(read_table(spark, sf_dir, "documents"), max_repeats=1.5)


def op9_mil_quality(spark, sf_dir):
    """Quality of every document, learned from labels of the rows not held out."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = train(docs, labels.where(_remainder("doc_id", 3) != 1))
    return score(docs, model).select("doc_id", F.coalesce(_remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
                                     "score", "predicted")


def op10_bpe(spark, sf_dir):
    """Token ids of every whole text and the text they decode to, as digests."""
    return digests(encode_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


def op11_line_dedup(spark, sf_dir):
    """Lines of 10 characters or more stay in the smallest doc_id that holds them."""
    kept = drop_repeated_lines(read_table(spark, sf_dir, "documents"), least=10, min_docs=2)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept", "utf-8"), 256).alias("kept_sha256"))


def op12_hard_negatives(spark, sf_dir):
    """Hard negatives of every hundredth embedding; a seventh has its label moved on by one."""
    rows = read_table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op13_whitening(spark, sf_dir):
    """Embeddings on a grid of 1/64, whitened on their 32 leading components."""
    return whiten(read_table(spark, sf_dir, "embeddings"), k=32, scale=64, shift=1_000_000)


QUERIES = {f.__name__: f for f in (op1_warc, op2_secret_ledger, op3_langid, op4_vector_passes, op5_simhash_near_dedup, op6_exact_dedup,
                                   op7_html_text, op8_mixing, op9_mil_quality, op10_bpe, op11_line_dedup, op12_hard_negatives,
                                   op13_whitening)}
