"""Exact dedup by a tree merge of sorted digest runs (DataFrame functions only).

Every row's normalised text becomes a digest.  Rows are dealt into ``runs``
runs by a hash of id and text; a run holds each of its digests once, with the
identifier that stays and the number of rows.  In round k the runs whose
numbers differ in the k-th group of bits send their entries to the run that
has those bits clear (a binomial tree of fan-in ``2**bits``), and the merge
again keeps one entry a digest.  After the last round one entry is left for
each digest of the corpus, spread over partitions by digest.  Runs are written
sorted, but a shuffle doesn't keep their order: entries of one digest meet in a
hash aggregate of the round, not in a streaming merge.  The verdict
then goes back down the same tree, run by run, so that a group with a third
of all rows is never one join key: its rows sit in all runs.

An entry is sorted and merged by a 64-bit digest and *verified* at every
level by SHA-256 and length of the whole text: entries that share the short
digest but not the other two never merge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirebook.llm.common import materialise, without

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["digest", "sha", "bytes"]


def normalised(text: Column) -> Column:
    """A-Z in lower case, nothing else changed; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def _root(run: Column, bits: int) -> Column:
    """The run that a run's entries are in once its low ``bits`` are clear."""
    return F.shiftleft(F.shiftright(run, bits), bits)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest",
                 runs: int | None = None, bits: int = 4) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    ``keep``: "largest" or "smallest" id of equal texts stays.  ``runs``: a
    power of two; by default the first that reaches the session's shuffle
    partitions.  Null texts equal empty ones.  A null id never stays while its
    group has another; a group of null ids only has keep_id null and all its
    rows kept.  Rows that repeat both id and text count in group_size and
    carry the same verdict.  Other columns of ``docs`` are not read.  An empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    best = {"largest": F.max, "smallest": F.min}[keep]
    if runs is None:
        runs = 1 << (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()
    if runs < 1 or runs & (runs - 1):
        raise ValueError("runs must be a power of two")
    text = normalised(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("t")).select(
        "id", F.xxhash64("t").alias("digest"), F.unhex(F.sha2(F.encode("t", "utf-8"), 256)).alias("sha"),
        F.octet_length("t").cast("long").alias("bytes"))
    rows = rows.withColumn("run", F.pmod(F.xxhash64("id", "digest"), F.lit(runs)))
    rows = materialise(rows.sortWithinPartitions("run", "digest"), "digest-runs")

    levels = [rows.groupBy("run", *KEY).agg(best("id").alias("keep"), F.count("*").alias("n"))]
    done = 0
    while 1 << done < runs:
        done += bits
        levels.append(levels[-1].withColumn("run", _root(F.col("run"), done)).groupBy("run", *KEY)
                      .agg(best("keep").alias("keep"), F.sum("n").alias("n")))
    # single rows keep themselves; only entries of larger groups go back down
    verdict = materialise(levels[-1].where("n > 1").select(
        F.col("run").alias("up"), *KEY, F.col("keep").alias("keep_id"), F.col("n").alias("group_size")), "digest-groups")
    for level in levels[-2::-1]:
        done -= bits
        below = level.select("run", *KEY).withColumn("up", _root(F.col("run"), done + bits))
        verdict = below.join(verdict, ["up", *KEY]).select(
            F.col("run").alias("up"), *KEY, "keep_id", "group_size")
    out = rows.join(verdict.withColumnRenamed("up", "run").withColumnRenamed("keep_id", "of_group"),
                    ["run", *KEY], "left")
    keep_id = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("of_group"))
    return out.select(F.col("id").alias(id_col), keep_id.alias("keep_id"),
                      F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                      F.col("id").eqNullSafe(keep_id).alias("kept"),
                      F.lower(F.hex("sha")).alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      keep: str = "largest") -> DataFrame:
    """``docs`` with one row for each normalised text, all columns kept.

    Of rows that repeat id and text, one (any) stays.  Nulls, empty texts and
    ties: as ``exact_groups``.  What goes is found on digests; whole rows are
    read once more and joined with the digests that go, which are few beside
    the rows, and only rows that repeat both id and text are shuffled whole
    where those digests are small enough to be broadcast.
    """
    groups = exact_groups(docs, id_col, text_col, keep).where("group_size > 1").select(
        *_pair(F.col(f"`{id_col}`"), F.unhex("text_sha256")), "kept")
    verdicts = materialise(groups.groupBy("id", "sha").agg(F.max("kept").alias("kept"), F.count("*").alias("n")), "copies")
    gone, twice = verdicts.where("not kept"), verdicts.where("kept and n > 1")
    sha = F.unhex(F.sha2(F.encode(normalised(F.col(f"`{text_col}`")), "utf-8"), 256))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *_pair(F.col(f"`{id_col}`"), sha))
    keys = ["id", "sha"]
    if twice.isEmpty():
        left = without(rows, gone.select(keys), keys)
    else:
        left = without(rows, verdicts.where("not kept or n > 1").select(keys), keys)
        left = left.unionByName(rows.join(twice.select(keys), keys, "left_semi").dropDuplicates(keys))
    return left.select("row.*")


def _pair(id_: Column, sha: Column) -> list[Column]:
    """Id (as text, told from a missing one) and digest, never null, so that plain equality joins them."""
    return [F.coalesce(F.concat(F.lit("="), id_.cast("string")), F.lit("")).alias("id"), sha.alias("sha")]
