"""SimHash near-dedup by anchor-point covering.

Anchors are the words of a covering code: the product of two perfect binary
Golay codes [23, 12], each of covering radius 3, over the low 46 bits of a
fingerprint.  Every point lies within the radius of an anchor.  Take two
fingerprints that differ in at most ``t`` bits: the point half way between
them is at most ceil(t/2) from either and has an anchor within the radius.
So each fingerprint is replicated to every anchor within covering radius
plus ceil(t/2) (counted block by block, which is the tighter condition), and
any two that link meet at one anchor at least.  At each anchor the full
64-bit fingerprints are compared.

What is compared are distinct fingerprints, so exact copies of a fingerprint
are one point however many rows have it.  An anchor gives a spanning forest of
its links, never all pairs.  Anchors with more than ``tile`` points are cut
into tiles (pairs of chunks), so no task holds an unbounded anchor.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirebook.llm.common import connected_components, lean, materialise, spanning_forest, without

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SEED = 42
# The Golay code's generator polynomial, its length and covering radius.
GENERATOR, LENGTH, RADIUS = 0xC75, 23, 3
MASK = (1 << LENGTH) - 1


def fingerprint(text: bytes | None, shingle: int) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text (majority of shingle hashes)."""
    words = (text or b"").translate(_LOWER).split()  # bytes.split: space and 0x09-0x0D
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    k = max(1, n - shingle + 1)
    lengths = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts, stops = (ends - lengths)[:k], ends[n - k:]
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, k, 1 << 16):
        h = [digest(joined[s:e], SEED) for s, e in zip(starts[i:i + (1 << 16)].tolist(), stops[i:i + (1 << 16)].tolist())]
        bits = np.unpackbits(np.array(h, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > k).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, h, fp): h a hash of the text, fp the fingerprint as a signed long."""
    src = docs.select(F.col(f"`{id_col}`").alias("id"), text_hash(text_col).alias("h"), F.col(f"`{text_col}`").cast("binary").alias("t"))
    schema = src.select("id", "h", F.lit(0).cast("long").alias("fp")).schema

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                fp = np.fromiter((fingerprint(t, shingle) for t in part.column(2).to_pylist()), np.uint64, part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(fp.view(np.int64))], ["id", "h", "fp"])

    return src.mapInArrow(lean(run), schema)


def text_hash(text_col: str) -> Column:
    """Tells the texts of rows that share an id apart."""
    return F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))


@lru_cache(maxsize=4)
def _tables(slack: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the high bits; per remainder the error vectors of weight
    up to radius + slack and how far each is beyond the radius (99: none)."""
    high = np.zeros(1 << 12, np.int64)
    for i in range(12):
        r = 1 << (11 + i)
        for bit in range(22, 10, -1):
            if r >> bit & 1:
                r ^= GENERATOR << (bit - 11)
        high[1 << i] = r
    for x in range(1, 1 << 12):
        low = x & -x
        if x != low:
            high[x] = high[x ^ low] ^ high[low]
    errors, beyond = [], []
    for w in range(RADIUS + slack + 1):
        errors.append(np.array([sum(1 << bit for bit in bits) for bits in combinations(range(LENGTH), w)], np.int64))
        beyond.append(np.full(len(errors[-1]), max(0, w - RADIUS)))
    e, x = np.concatenate(errors), np.concatenate(beyond)
    s = high[e >> 11] ^ (e & 0x7FF)
    order = np.argsort(s, kind="stable")
    count = np.bincount(s, minlength=1 << 11)
    column = np.arange(len(e)) - np.repeat(np.cumsum(count) - count, count)
    vectors = np.zeros((1 << 11, count.max()), np.int64)
    excess = np.full((1 << 11, count.max()), 99, np.int64)
    vectors[s[order], column], excess[s[order], column] = e[order], x[order]
    return high, vectors, excess


def anchors_of(fp: np.ndarray, slack: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``fp`` and the anchors within radius + slack of them."""
    high, vectors, excess = _tables(slack)
    p = fp.view(np.uint64).astype(np.uint64)
    y1, y2 = (p & np.uint64(MASK)).astype(np.int64), ((p >> np.uint64(LENGTH)) & np.uint64(MASK)).astype(np.int64)
    s1, s2 = high[y1 >> 11] ^ (y1 & 0x7FF), high[y2 >> 11] ^ (y2 & 0x7FF)
    row, i, j = np.nonzero(excess[s1][:, :, None] + excess[s2][:, None, :] <= slack)
    return row, ((y1[row] ^ vectors[s1[row], i]) << LENGTH) | (y2[row] ^ vectors[s2[row], j])


def _replicas(points: DataFrame, slack: int) -> DataFrame:
    def run(batches):
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(fp), 2048):
                part = fp[at:at + 2048]
                row, anchor = anchors_of(part, slack)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(part[row])], ["anchor", "fp"])

    return points.mapInArrow(lean(run), "anchor long, fp long")


def _links(groups: DataFrame, t: int, width: int = 16) -> DataFrame:
    """Links between the points of each (anchor, tile), as (a, b) with a < b;
    ``groups`` is sorted by anchor and tile within its partitions."""

    def solve(anchor, tile, fp):
        edge = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (tile[1:] != tile[:-1])])
        start = np.nonzero(edge)[0]
        size = np.diff(np.append(start, len(fp)))
        run, of = np.repeat(np.arange(len(start)), size), np.repeat(size, size)
        a, b = [], []
        for d in range(1, min(width, int(size.max()))):
            i = np.nonzero((run[d:] == run[:-d]) & (of[d:] <= width))[0]
            i = i[np.bitwise_count(fp[i] ^ fp[i + d]) <= t]
            a.append(fp[i])
            b.append(fp[i + d])
        for s, k in zip(start[size > width].tolist(), size[size > width].tolist()):
            part = fp[s:s + k]
            i, j = spanning_forest(k, lambda x: np.nonzero(np.bitwise_count(part ^ part[x]) <= t)[0])  # noqa: B023
            a.append(part[i])
            b.append(part[j])
        if not a:
            return np.zeros((0, 2), np.uint64)
        a, b = np.concatenate(a), np.concatenate(b)
        return np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)

    def send(e):
        return pa.RecordBatch.from_arrays([pa.array(e[:, 0].view(np.int64)), pa.array(e[:, 1].view(np.int64))], ["a", "b"])

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)])
            rows += batch.num_rows
            if rows < 1 << 18:
                continue
            x = [np.concatenate(c) for c in zip(*held)]
            # the last group may go on in the next batch
            same = (x[0] == x[0][-1]) & (x[1] == x[1][-1])
            cut = len(same) - int(same.sum())
            if cut:
                yield send(solve(x[0][:cut], x[1][:cut], x[2][:cut].view(np.uint64)))
            held, rows = [[c[cut:] for c in x]], len(same) - cut
        if rows:
            x = [np.concatenate(c) for c in zip(*held)]
            yield send(solve(x[0], x[1], x[2].view(np.uint64)))

    return groups.select("anchor", "tile", "fp").mapInArrow(lean(run), "a long, b long")


def _tiled(replicas: DataFrame, tile: int, buckets: int = 1 << 18) -> DataFrame:
    """Add ``tile``: 0, or for anchors of over ``tile`` points one row for each
    pair of chunks that the point's chunk is in.

    Anchors are first counted by bucket (a table of ``buckets`` rows at most):
    only those of an overfull bucket can be overfull and are counted singly.
    """
    bucket = F.pmod(F.xxhash64("anchor"), F.lit(buckets))
    full = replicas.groupBy(bucket.alias("bucket")).count().where(F.col("count") > tile).select("bucket")
    full = materialise(full, "full-buckets")
    if full.isEmpty():
        return replicas.withColumn("tile", F.lit(0).cast("long"))
    hot = materialise(replicas.withColumn("bucket", bucket).join(F.broadcast(full), "bucket")  # at most `buckets` rows
                      .groupBy("anchor").count().where(F.col("count") > tile)
                      .select("anchor", F.ceil(F.col("count") / tile).cast("long").alias("k")), "hot-anchors")
    if hot.isEmpty():
        return replicas.withColumn("tile", F.lit(0).cast("long"))
    if hot.count() <= 100_000:
        hot = F.broadcast(hot)  # two longs a row
    mine = F.pmod(F.xxhash64("fp"), F.col("k"))
    pair = F.transform(F.sequence(F.lit(0).cast("long"), F.col("k") - 1),
                       lambda j: F.least(mine, j) * F.col("k") + F.greatest(mine, j))
    return replicas.join(hot, "anchor", "left").select(
        "anchor", "fp", F.explode(F.when(F.col("k").isNull(), F.array(F.lit(-1).cast("long"))).otherwise(pair)).alias("tile"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                       max_bits: int = 4, tile: int = 16384) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (hex), component_id.

    Fingerprints of ``max_bits`` or fewer differing bits link; component_id is
    the smallest id reachable over links, itself included.  Null and empty
    texts have fingerprint zero and link as any other.  Null ids are ignored
    when the smallest is taken (null only if all ids of the component are).
    Repeated rows each get a row.  Other columns are not read.
    """
    return _components(docs, id_col, text_col, shingle, max_bits, tile).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _components(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int, tile: int) -> DataFrame:
    """(fp, id, h, component_id) of every row."""
    rows = materialise(fingerprints(docs, id_col, text_col, shingle), "simhash")
    points = materialise(rows.groupBy("fp").agg(F.min("id").alias("rep")), "simhash-points")
    # few bytes a row become many replicas: deal them over all tasks
    spread = points.select("fp").repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    replicas = _tiled(_replicas(spread, -(-max_bits // 2)), tile)
    links = _links(replicas.repartition("anchor", "tile").sortWithinPartitions("anchor", "tile"), max_bits)
    found = connected_components(links.distinct())  # of fingerprints
    named = points.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "rep", F.coalesce("component", "fp").alias("component"))
    named = materialise(named, "simhash-named")
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"), F.count("*").alias("points"))
    # points alone keep their own id; only larger components are joined
    ids = named.join(least.where("points > 1"), "component", "left").select(
        "fp", F.when(F.col("points").isNull(), F.col("rep")).otherwise(F.col("component_id")).alias("component_id"))
    return rows.join(ids, "fp")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                     max_bits: int = 4, tile: int = 16384) -> DataFrame:
    """``docs`` without the rows whose id is not their component's smallest,
    all columns kept.

    Rows that repeat that id and are in the component stay, and rows of an id
    with several texts go or stay by each text.  Null ids stay (they name no
    document).  Null and empty texts are copies of each other.  An empty table
    gives no rows.
    """
    gone = _components(docs, id_col, text_col, shingle, max_bits, tile).where("id != component_id").select(
        "id", "h").distinct()
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(f"`{id_col}`").alias("id"), text_hash(text_col).alias("h"))
    return without(rows, materialise(gone, "near-copies"), ["id", "h"]).select("row.*")
