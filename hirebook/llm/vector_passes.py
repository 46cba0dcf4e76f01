"""Embedding near-dedup by sorted projection passes.

In each pass every vector gets the concatenated signs of 64 random
projections, and the vectors are sorted by them; near vectors share a prefix
and stand near each other.  Ranks are cut into blocks that overlap by
``window`` ranks, so each vector is compared with at least its ``window``
neighbours on either side.  Verified pairs (cosine in double precision) of all
passes are united into components.

Equal vectors are one point, however many rows have them, and a block gives a
spanning forest of its links, never all pairs.  Which vectors link directly is
then counted exactly within each component, tile by tile, so a large
component is neither gathered in one task nor expanded into pairs.

The first passes are as many as evenly spread vectors need.  Then every
vector's density is measured: in each pass, the depth of the prefix that it
shares with fewer vectors than ``window``, and from it the probability that a
neighbour at the threshold was out of the window in all passes.  Vectors for
which this exceeds ``miss`` (those of a hot cluster, whose hashes agree) are
dense: they get passes of their own until none is left, or are compared with
each other exactly, tile by tile, once that costs no more than the passes that
they still need.  A component needs only one path of found pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirebook.llm.common import connected_components, materialise, spanning_forest

BITS = 64


def n_passes(n: int, threshold: float, window: int, miss: float) -> int:
    """Passes after which a pair at the threshold is missed with probability ``miss``."""
    shared = max(0.0, math.log2(max(1, n) / window))  # hashes that neighbours within the window agree on
    agree = (1 - math.acos(threshold) / math.pi) ** shared
    return 1 if agree >= 1 else math.ceil(math.log(miss) / math.log(1 - agree))


def agreement(threshold: float) -> float:
    """Probability that two vectors at the threshold agree on a hash."""
    return 1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi


def shared_bits(keys: np.ndarray, window: int) -> np.ndarray:
    """Of sorted keys, how many first bits each shares with the one ``window`` further on."""
    x = (keys[window:] ^ keys[:-window]).view(np.uint64)
    high, low = (x >> np.uint64(32)).astype(np.float64), (x & np.uint64(0xFFFFFFFF)).astype(np.float64)
    return np.where(high > 0, 32 - np.frexp(high)[1], 64 - np.frexp(low)[1]).astype(np.int32)


def unit(values: list[np.ndarray]) -> np.ndarray:
    """Rows of length one, in double precision."""
    x = np.array(values, np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def sort_keys(x: np.ndarray, number: int, seed: int) -> np.ndarray:
    """Signed longs that sort as the concatenated hashes of one pass do."""
    planes = np.random.default_rng([seed, number, x.shape[1]]).standard_normal((x.shape[1], BITS))
    bits = np.packbits(x @ planes > 0, axis=1).view(">u8").astype(np.uint64)[:, 0]
    return (bits ^ np.uint64(1 << 63)).view(np.int64)


def classes(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows (id, v) with v null if it can't link, and the distinct vectors
    (cid, v, dim, rep: smallest id, n: rows)."""
    single = isinstance(vectors.schema[vec_col].dataType.elementType, T.FloatType)  # half the bytes, the same numbers
    kind = "float" if single else "double"
    v = F.transform(F.col(vec_col), lambda x: x.cast(kind) + F.lit(0.0).cast(kind))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) | ~F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).alias("id"), F.when(~F.coalesce(bad, F.lit(True)) & F.col(id_col).isNotNull(), v).alias("v"))
    one = rows.where(F.col("v").isNotNull()).groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("n"))
    one = one.select(F.monotonically_increasing_id().alias("cid"), "v", F.size("v").alias("dim"), "rep", "n")
    return rows, materialise(one, "vector-classes")


def _arrays(column) -> list[np.ndarray]:
    return [np.asarray(x, np.float64) for x in column]


def _keyed(points: DataFrame, passes: range, seed: int) -> DataFrame:
    src = points.select("cid", "dim", "v")

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                cid, dim = part.column(0).to_numpy(), part.column(1).to_numpy()
                values = part.column(2).to_numpy(zero_copy_only=False)
                for d in np.unique(dim):
                    of = np.nonzero(dim == d)[0]
                    x = unit([values[i] for i in of])
                    for p in passes:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(of), p, np.int32)), pa.array(np.full(len(of), d, np.int32)),
                             pa.array(sort_keys(x, p, seed)), pa.array(cid[of])], ["pass", "dim", "key", "cid"])

    return src.mapInArrow(run, "pass int, dim int, key long, cid long")


def _ranked(keyed: DataFrame) -> DataFrame:
    """Add the rank of every row in the order of pass, dim, key, cid."""
    order = ["pass", "dim", "key", "cid"]
    sorted_rows = materialise(keyed.repartitionByRange(*order).sortWithinPartitions(*order)
                              .withColumn("at", F.monotonically_increasing_id()), "vector-passes")
    part = F.shiftright("at", 33)
    counts = sorted(sorted_rows.groupBy(part.alias("part")).count().collect())  # one row a partition
    before, total = [], 0
    for r in counts:
        before.append((r["part"], total))
        total += r["count"]
    table = keyed.sparkSession.createDataFrame(before, "part long, before long")
    return (sorted_rows.withColumn("part", part).join(F.broadcast(table), "part")
            .withColumn("rank", F.col("before") + F.col("at") - F.shiftleft("part", 33)).drop("part", "before", "at"))


def _links(ranked: DataFrame, points: DataFrame, threshold: float, window: int) -> DataFrame:
    """Verified pairs (a, b) of classes: a spanning forest of each block; and
    with b null, the depth of the prefix that class a has to share in a pass
    to be in the window (the most of up to two rows; 0: all are in it).

    Only keys are sorted; the vectors join their places once these are known,
    so a vector travels once a block and not for the sort too.
    """
    size = 4 * window
    block = F.floor(F.col("rank") / size).cast("long")
    also = F.when((F.col("rank") % size < window) & (block > 0), F.array(block, block - 1)).otherwise(F.array(block))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        a, b, deep = [], [], []
        rows = rows.sort_values("rank")
        for (number, _), seg in rows.groupby(["pass", "dim"]):
            depth, at = np.zeros(len(seg), np.int32), seg["rank"].to_numpy() - seg["block"].to_numpy() * size
            if len(seg) > window:
                bits = shared_bits(seg["key"].to_numpy(), window) + 1
                depth[:-window] = np.where(at[:-window] < size, bits, 0)  # the later rows are the next block's
                depth[window:] = np.maximum(depth[window:], bits)
            deep.append(pd.DataFrame({"a": seg["cid"], "b": None, "pass": number, "depth": depth}))
            x = unit(_arrays(seg["v"]))
            near = x @ x.T >= threshold
            some = np.nonzero(near.sum(axis=1) > 1)[0]
            if not len(some):
                continue
            cid = seg["cid"].to_numpy()[some]
            near = near[np.ix_(some, some)]
            i, j = spanning_forest(len(some), lambda k: np.nonzero(near[k])[0])  # noqa: B023
            a.append(cid[i])
            b.append(cid[j])
        none = [np.zeros(0, np.int64)]
        found = pd.DataFrame({"a": np.concatenate(a or none), "b": np.concatenate(b or none), "pass": -1, "depth": 0})
        return pd.concat([found, *deep]).astype({"a": "int64", "b": "Int64", "pass": "int32", "depth": "int32"})

    placed = ranked.withColumn("block", F.explode(also)).join(points.select("cid", "v"), "cid")
    return (placed.select("block", "pass", "dim", "rank", "key", "cid", "v").groupBy("block")
            .applyInPandas(compare, "a long, b long, pass int, depth int"))


def _missed(compared: DataFrame, threshold: float) -> DataFrame:
    """(cid, missed): logarithm of the probability that no pass had a
    neighbour at the threshold in the window."""
    apart = F.lit(1.0) - F.pow(F.lit(agreement(threshold)), F.col("depth").cast("double"))
    return (compared.where("b is null").groupBy(F.col("a").alias("cid"), "pass").agg(F.max("depth").alias("depth"))
            .groupBy("cid").agg(F.sum(F.when(apart > 0, F.log(apart)).otherwise(F.lit(-1e9))).alias("missed")))


def exact_pays(n: int, passes: float, window: int) -> bool:
    """Whether comparing ``n`` vectors with each other costs no more than ``passes`` passes of blocks."""
    return n <= 12 * window * passes


def _tile_links(points: DataFrame, n: int, threshold: float, tile: int) -> DataFrame:
    """(a, b) of classes: spanning forests of all links among ``n`` points, tile by tile."""
    k = -(-n // tile)
    mine = F.pmod(F.xxhash64("cid"), F.lit(k))
    pair = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(k - 1).cast("long")), lambda j: F.struct(F.least(mine, j).alias("i"), F.greatest(mine, j).alias("j")))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        x, cid = unit(_arrays(rows["v"])), rows["cid"].to_numpy()
        near = x @ x.T >= threshold
        i, j = spanning_forest(len(x), lambda q: np.nonzero(near[q])[0])
        return pd.DataFrame({"a": cid[i], "b": cid[j]}, dtype=np.int64)

    return (points.select("dim", "cid", "v", F.explode(pair).alias("t")).select("dim", "t.i", "t.j", "cid", "v").groupBy("dim", "i", "j")
            .applyInPandas(compare, "a long, b long"))


def _all_links(points: DataFrame, count: int, threshold: float, window: int, miss: float, seed: int, tile: int) -> DataFrame:
    """Pairs (a, b) of linked classes after as many passes as the measured density asks for."""
    done, links, missed, dense, n = 0, None, None, points, count
    passes = n_passes(count, threshold, window, miss)
    while True:
        compared = materialise(_links(_ranked(_keyed(dense, range(done, done + passes), seed)), dense, threshold, window), "vector-links")
        pairs = compared.where("b is not null").select("a", "b")
        links = pairs if links is None else links.unionByName(pairs)
        now = _missed(compared, threshold)
        if missed is not None:
            now = now.join(missed.withColumnRenamed("missed", "before"), "cid").select("cid", (F.col("missed") + F.col("before")).alias("missed"))
        missed = materialise(now.where(F.col("missed") > math.log(miss)), "vector-dense")
        done += passes
        n, mean = missed.agg(F.count("*"), F.avg("missed")).first()
        if not n:
            return links
        dense = materialise(points.join(missed.select("cid"), "cid").select("cid", "dim", "v"), "vector-dense-points")
        # as many as the mean dense vector needs; those that need more stay for the next round
        more = done * (math.log(miss) / mean - 1) if mean < 0 else math.inf
        if exact_pays(n, max(1.0, more), window):
            return links.unionByName(_tile_links(dense, n, threshold, tile))
        passes = max(1, math.ceil(more))


def _direct(members: DataFrame, threshold: float, tile: int) -> DataFrame:
    """(cid, links): rows of other classes of the component that link."""
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / tile).cast("long").alias("k"))
    mine = F.pmod(F.xxhash64("cid"), F.col("k"))
    pair = F.transform(F.sequence(F.lit(0).cast("long"), F.col("k") - 1), lambda j: F.struct(F.least(mine, j).alias("a"), F.greatest(mine, j).alias("b")))
    tiled = members.join(sizes, "component").withColumn("chunk", mine).select("component", "chunk", "cid", "n", "v", F.explode(pair).alias("t"))

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        x, n, chunk = unit(_arrays(rows["v"])), rows["n"].to_numpy(), rows["chunk"].to_numpy()
        a, b = int(rows["a"].iloc[0]), int(rows["b"].iloc[0])
        links = np.zeros(len(rows), np.int64)
        if a == b:
            near = x @ x.T >= threshold
            np.fill_diagonal(near, False)
            links = near @ n
        else:
            left, right = np.nonzero(chunk == a)[0], np.nonzero(chunk == b)[0]
            near = x[left] @ x[right].T >= threshold
            links[left], links[right] = near @ n[right], near.T @ n[left]
        return pd.DataFrame({"cid": rows["cid"], "links": links})

    return (tiled.select("component", "t.a", "t.b", "chunk", "cid", "n", "v").groupBy("component", "a", "b")
            .applyInPandas(count, "cid long, links long").groupBy("cid").agg(F.sum("links").alias("links")))


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.9, window: int = 256,
                 miss: float = 0.005, seed: int = 1, tile: int = 1024) -> DataFrame:
    """One row per row of ``vectors``: id, n_links, component_id, kept.

    Two vectors link if their cosine reaches ``threshold``; component_id is
    the smallest id reachable over links found (itself included), n_links the
    number of other rows of the component that link directly, kept whether the
    id is the component's.  Vectors that are null, empty, zero or hold a null
    or non-finite number, and rows without an id, link with nothing; a null id
    has component null and is kept.  Vectors of different lengths don't link.
    Rows that repeat an id count as rows of their own.  Other columns are not
    read; an empty table gives no rows.
    """
    rows, points = classes(vectors, id_col, vec_col)
    count = points.count()
    if count:
        links = _all_links(points, count, threshold, window, miss, seed, tile)
        found = materialise(connected_components(links.distinct()), "vector-components")
        members = points.join(found, F.col("cid") == F.col("node")).select("component", "cid", "v", "n", "rep")
        named = members.groupBy("component").agg(F.min("rep").alias("component_id"))
        linked = (members.join(named, "component").select("cid", "component_id").join(_direct(members, threshold, tile), "cid"))
        known = points.join(linked, "cid", "left")
    else:
        known = points.withColumns({"component_id": F.col("rep"), "links": F.lit(0).cast("long")})
    known = known.select(F.col("v").alias("w"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"),
                         F.coalesce("component_id", "rep").alias("component_id"))
    out = rows.join(known, F.col("v") == F.col("w"), "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
