"""Mixing sources to target weights by temperature.

A source's weight is its share of tokens raised to an exponent, normalised.
The exponent is found by bisection: the weights' entropy falls and the most
repeated source's repetitions fall as it grows, so a target entropy and a
repetition limit each have one exponent, and the larger satisfies both.

The weights are realised as budgeted block permutations.  A source's budget of
tokens buys whole epochs, each a permutation of the source's blocks, and then
the longest prefix of one more permutation that it can pay for.  Blocks are
hashes of ids, so a source that holds a third of all rows is spread over as
many tasks as any.  The prefix is found level by level (block, block in the
block, row), each time from sums over at most ``blocks`` blocks a source, and
ends as one cut per source; every row then decides from its own hashes and its
source's cut how often it is taken.  No text is shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirebook.llm.common import materialise

MAX_SOURCES = 1_000_000  # totals a source go to the driver
BROADCAST_SOURCES = 20_000


@dataclass(frozen=True)
class Mixture:
    """Exponent, weights, repetitions and budgets (tokens) by source."""

    exponent: float
    weights: dict
    epochs: dict
    budgets: dict


def weights_at(tokens: dict, exponent: float) -> dict:
    """Normalised weights of the sources that have tokens."""
    total = sum(tokens.values())
    logs = {s: exponent * math.log(t / total) for s, t in tokens.items() if t > 0}
    top = max(logs.values(), default=0.0)
    raw = {s: math.exp(x - top) for s, x in logs.items()}
    norm = math.fsum(raw.values())
    return {s: x / norm for s, x in raw.items()}


def entropy(weights: dict) -> float:
    return -math.fsum(w * math.log(w) for w in weights.values() if w > 0)


def _budget(tokens: dict, weights: dict, budget: int | None) -> float:
    """Tokens to deal; None: so many that the least repeated source is whole."""
    return budget if budget is not None else max((tokens[s] / w for s, w in weights.items()), default=0)


def _bisect(meets, low: float, high: float) -> float:
    """The smallest exponent that ``meets``, which holds from some point on."""
    if meets(low):
        return low
    if not meets(high):
        raise ValueError("no exponent meets the target")
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (low, mid) if meets(mid) else (mid, high)
    return high


def solve(tokens: dict, target_entropy: float | None = None, max_repeats: float | None = None,
          budget: int | None = None, highest: float = 64.0) -> Mixture:
    """The flattest mixture with at most the target entropy (nats) and the
    repetition limit; without either, the sources' own shares.

    ``budget``: tokens of the mixture; None: the least with which every row of
    every source is taken once.  ``ValueError`` if no exponent from 0 to
    ``highest`` meets the targets (a limit below budget / tokens).
    """
    tokens = {s: int(t) for s, t in tokens.items()}
    if not any(tokens.values()):
        return Mixture(1.0, {s: 0.0 for s in tokens}, {s: 1.0 for s in tokens}, {s: 0 for s in tokens})
    found = []
    if target_entropy is not None:
        found.append(_bisect(lambda a: entropy(weights_at(tokens, a)) <= target_entropy + 1e-12, 0.0, highest))
    if max_repeats is not None:
        def within(a):
            w = weights_at(tokens, a)
            b = _budget(tokens, w, budget)
            return max(x * b / tokens[s] for s, x in w.items()) <= max_repeats * (1 + 1e-12)
        # beyond 1 larger sources are repeated more, so the limit is met up to there or never
        found.append(_bisect(within, 0.0, 1.0))
    exponent = max(found, default=1.0)
    w = weights_at(tokens, exponent)
    b = _budget(tokens, w, budget)
    budgets = {s: math.floor(w.get(s, 0.0) * b + 1e-6) for s in tokens}
    epochs = {s: budgets[s] / t if t else 1.0 for s, t in tokens.items()}
    return Mixture(exponent, {s: w.get(s, 0.0) for s in tokens}, epochs, budgets)


def words(text: Column) -> Column:
    """Tokens of a text: runs without ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def _place(seed: int, blocks: int, source: Column, ident: Column, epoch: Column) -> Column:
    """Where a row stands in an epoch's permutation of its source: block,
    block in the block, row; ties of hashes go by block number and id."""
    h = F.xxhash64(F.lit(seed), ident.cast("string"))
    one, two = F.pmod(h, F.lit(blocks)), F.pmod(F.shiftrightunsigned(h, 24), F.lit(blocks))
    return F.struct(
        F.struct(F.xxhash64(F.lit(seed), source, epoch, one).alias("h"), one.alias("n")).alias("a"),
        F.struct(F.xxhash64(F.lit(seed), source, epoch, one, two).alias("h"), two.alias("n")).alias("b"),
        F.struct(F.xxhash64(F.lit(seed), epoch, h).alias("h"), h.alias("n")).alias("c"))


def _cut(rows: DataFrame, level: str) -> DataFrame:
    """Per source: the first group of ``level`` that the rest doesn't pay for
    (null if all are paid) and what is left before it."""
    sums = rows.groupBy("source", F.col(f"place.{level}").alias("at")).agg(
        F.sum("tokens").alias("tokens"), F.first("rest").alias("rest"))
    order = Window.partitionBy("source").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = sums.withColumn("upto", F.sum("tokens").over(order))
    return run.where(F.col("upto") > F.col("rest")).groupBy("source").agg(
        F.min("at").alias("at"), F.min_by(F.col("rest") - F.col("upto") + F.col("tokens"), "at").alias("rest"))


@dataclass(frozen=True)
class Plan:
    """A mixture and, per source, whole epochs and the cut of the next one."""

    mixture: Mixture
    cuts: DataFrame
    n_sources: int
    seed: int
    blocks: int


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 7,
         blocks: int = 4096, **targets) -> Plan:
    """Count every source's tokens over all rows, solve for the weights and
    find the cuts.  ``targets`` as in ``solve``."""
    spark = docs.sparkSession
    rows = materialise(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                                   words(F.col(text_col)).alias("tokens")), "mix-tokens")
    totals = rows.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    tokens = {r.source: r.tokens for r in totals.limit(MAX_SOURCES + 1).collect()}
    if len(tokens) > MAX_SOURCES:
        raise ValueError(f"over {MAX_SOURCES} sources; merge the small ones first")
    mix = solve(tokens, **targets)
    full = {s: mix.budgets[s] // t if t else 1 for s, t in tokens.items()}
    rest = {s: mix.budgets[s] - full[s] * t for s, t in tokens.items()}
    schema = T.StructType([T.StructField("source", T.StringType()), T.StructField("weight", T.DoubleType()),
                           T.StructField("full", T.LongType()), T.StructField("rest", T.LongType())])
    known = spark.createDataFrame([(s, mix.weights[s], full[s], rest[s]) for s in sorted(tokens, key=lambda s: (s is not None, s))], schema)
    known = materialise(known, "mix-sources")
    # only sources with a part epoch; rows far beyond a cut drop out level by level
    part = rows.join(_small(known.where("rest > 0").select(F.col("source").alias("s"), "full", "rest"), len(tokens)),
                     F.col("source").eqNullSafe(F.col("s"))).drop("s")
    part = part.withColumn("source", F.coalesce("source", F.lit("\0null")))
    part = part.withColumn("place", _place(seed, blocks, F.col("source"), F.col("id"), F.col("full")))
    cuts = known
    for level in "abc":
        found = materialise(_cut(part, level), f"mix-cut-{level}")
        cuts = cuts.join(found.select(F.col("source").alias("s"), F.col("at").alias(f"cut_{level}")),
                         F.coalesce("source", F.lit("\0null")) == F.col("s"), "left").drop("s")
        part = part.drop("rest").join(_small(found.withColumnRenamed("source", "s"), len(tokens)),
                                      (F.col("source") == F.col("s")) & (F.col(f"place.{level}") == F.col("at"))).drop("s", "at")
    return Plan(mix, materialise(cuts, "mix-cuts"), len(tokens), seed, blocks)


def _small(df: DataFrame, n: int) -> DataFrame:
    """Broadcast a table of one short row a source, if there are few sources."""
    return F.broadcast(df) if n <= BROADCAST_SOURCES else df


def copies(docs: DataFrame, p: Plan, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """``docs`` with _weight, _full and _copies: how often each row is taken."""
    src = F.col(source_col).cast("string")
    cuts = _small(p.cuts.select(F.col("source").alias("_source"), F.col("weight").alias("_weight"), F.col("full").alias("_full"),
                                F.col("rest").alias("_rest"), "cut_a", "cut_b", "cut_c"), p.n_sources)
    out = docs.join(cuts, src.eqNullSafe(F.col("_source")), "left")
    at = _place(p.seed, p.blocks, F.coalesce(src, F.lit("\0null")), F.col(id_col), F.col("_full"))
    a, b, c = at["a"], at["b"], at["c"]
    # before the cut; a level without a cut is paid whole
    inside = (F.col("cut_a").isNull() | (a < F.col("cut_a")) | ((a == F.col("cut_a")) & (
        F.col("cut_b").isNull() | (b < F.col("cut_b")) | ((b == F.col("cut_b")) & (
            F.col("cut_c").isNull() | (c < F.col("cut_c")))))))
    taken = F.col("_full") + F.when((F.col("_rest") > 0) & inside, 1).otherwise(0)
    return out.withColumn("_copies", taken.cast("long")).drop("_source", "_rest", "cut_a", "cut_b", "cut_c")


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 7,
            blocks: int = 4096, **targets) -> DataFrame:
    """One row per row of ``docs``: id, source, n_tokens, weight (its
    source's), epochs (whole ones), copies, block and first_key.

    copies is how often the mixture takes the row; rows of epoch e (0 up to
    copies - 1) are read in order of ``epoch_key``; first_key is epoch 0's.
    Null texts have no tokens; a null source is a source of its own, and a
    source without tokens is taken once.  Rows that repeat an id stand or fall
    together, so that a budget may be left by that much.  Null ids are hashed
    as one id.  Other columns are not read.  An empty table gives no rows.
    """
    p = plan(docs, id_col, text_col, source_col, seed, blocks, **targets)
    some = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                       words(F.col(text_col)).alias("n_tokens"))
    out = copies(some, p, "id", "source")
    key = epoch_key(p, F.col("source"), F.col("id"), F.lit(0).cast("long"))
    return out.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "n_tokens", F.col("_weight").alias("weight"),
                      F.col("_full").alias("epochs"), F.col("_copies").alias("copies"),
                      key["a"]["n"].alias("block"), key["a"]["h"].alias("first_key"))


def epoch_key(p: Plan, source: Column, ident: Column, epoch: Column) -> Column:
    """Sort by this to read one epoch of a source in its permuted order."""
    return _place(p.seed, p.blocks, F.coalesce(source, F.lit("\0null")), ident, epoch)


def realise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 7,
            blocks: int = 4096, **targets) -> DataFrame:
    """``docs`` with every row as often as the mixture takes it (its columns,
    nothing added; not sorted)."""
    p = plan(docs, id_col, text_col, source_col, seed, blocks, **targets)
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(id_col).alias("id"),
                      F.col(source_col).cast("string").alias("source"))
    out = copies(row, p, "id", "source").where("_copies > 0")
    return out.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select("row.*")
