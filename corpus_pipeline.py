"""A corpus pipeline: quality, exact copies, near copies, mixture, token ids.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
it kept.  All but the last return the columns of ``documents``; the last one
returns a row per document of the mixture with its token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from hirebook.llm.bpe import encode_documents
from hirebook.llm.common import materialise, read_table
from hirebook.llm.exact_dedup import drop_exact_copies
from hirebook.llm.mil_quality import drop_low_quality, train
from hirebook.llm.mixing import realise
from hirebook.llm.simhash import drop_near_copies

#: A source is read at most so often; the least repeated one is read once.
MAX_REPEATS = 1.5

#: No SQL: three stages learn or hash in ways that it can't express.
ORACLE_SQL = None


def quality(spark, docs, sf_dir):
    """Drop documents that the quality model rejects (learned from labels)."""
    return drop_low_quality(docs, train(docs, read_table(spark, sf_dir, "labels")))


def exact(spark, docs, sf_dir):
    """One document of each text, the one with the largest doc_id."""
    return drop_exact_copies(docs, keep="largest")


def near(spark, docs, sf_dir):
    """One document of each SimHash component, the one with the smallest doc_id."""
    return drop_near_copies(docs, shingle=4, max_bits=4)


def mix(spark, docs, sf_dir):
    """Flatten the sources' weights as far as MAX_REPEATS allows; every
    document is taken once at least, rows repeat as often as they are taken."""
    return realise(docs, max_repeats=MAX_REPEATS)


def tokens(spark, docs, sf_dir):
    """Token ids of every document of the mixture, and the digest of the text
    that they decode to."""
    out = encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"), carry=("doc_id", "lang", "source"))
    return out.withColumn("decoded_sha256", F.sha2(F.encode("decoded", "utf-8"), 256)).drop("decoded")


STAGES = [("quality", quality), ("exact_dedup", exact), ("simhash_near_dedup", near), ("mixing", mix), ("bpe", tokens)]


def run(spark, sf_dir):
    """All stages over ``documents``, each but the last written and reread."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
