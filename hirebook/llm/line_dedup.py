"""Line dedup over a sharded minimal perfect hash.

Every line that counts becomes a 128-bit hash of its key (the line without
white space at its ends, A-Z in lower case).  The distinct hashes are dealt to
shards by their leading bits.  A shard is one row of the index: a minimal
perfect hash of its keys (levels of bit arrays: a key sits at the first level
where no other key of that level shares its bit; the number of set bits before
it is its slot) and arrays by slot: a 32-bit fingerprint, the number of
documents in one byte, and for the keys that repeat the smallest document id.

Documents don't join lines.  Their hashes, narrow rows, go to their shard and
look up the arrays; what comes back are the hashes that a document loses, and
with them the text is read once more.  A line in a third of all documents is
combined before the index sees it; its look-ups make their shard hot, and a
hot shard's arrays are sent to several tasks that share its look-ups.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirebook.llm.common import materialise

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SHARD_KEYS = 1 << 16
PROBES = 1 << 18
LEVELS = 40
HASHES = ["h1", "h2"]


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _bit(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    return (_mix(h1 ^ _mix(h2 + np.uint64(level))) % np.uint64(size)).astype(np.int64)


def build_hash(h1: np.ndarray, h2: np.ndarray, gamma: float = 1.6) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Minimal perfect hash of distinct keys: sizes of the levels, their bits
    as one array, and the slot (0 to n - 1) of every key."""
    left = np.arange(len(h1))
    sizes, bits, at, before = [], [], np.full(len(h1), -1), 0
    while len(left) and len(sizes) < LEVELS:
        size = 64 * -(-int(len(left) * gamma + 1) // 64)
        pos = _bit(h1[left], h2[left], len(sizes), size)
        alone = np.bincount(pos, minlength=size) == 1
        placed = alone[pos]
        at[left[placed]] = before + pos[placed]
        sizes.append(size)
        bits.append(alone)
        left, before = left[~placed], before + size
    bits = np.concatenate(bits) if bits else np.zeros(0, bool)
    if len(left):
        raise RuntimeError(f"{len(left)} keys share both hashes")
    rank = np.cumsum(bits) - 1
    return sizes, bits, rank[at] if len(h1) else at


def slots(h1: np.ndarray, h2: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """Slots of any keys; -1 for some that weren't among the keys of the hash
    (others of those get a slot, which the fingerprint tells)."""
    rank, out = np.cumsum(bits) - 1, np.full(len(h1), -1)
    left, before = np.arange(len(h1)), 0
    for level, size in enumerate(sizes):
        pos = before + _bit(h1[left], h2[left], level, size)
        hit = bits[pos]
        out[left[hit]] = rank[pos[hit]]
        left, before = left[~hit], before + size
    return out


def line_hashes(text: bytes, least: int) -> list[bytes | None]:
    """A 16-byte hash for each line; None for lines that don't count."""
    out = []
    for line in text.translate(_LOWER).split(b"\n"):
        key = line.strip()  # bytes: space and 0x09-0x0D
        long = len(key) >= least and (len(key) >= 4 * least or key.isascii() or len(key.decode("utf-8", "replace")) >= least)
        out.append(xxhash.xxh3_128_digest(key) if long else None)
    return out


def _text(text_col: str):
    return F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))


def lines_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 10) -> DataFrame:
    """(id, row, h1, h2): the distinct keys of every row of ``docs``; ``row``
    is a hash of the whole text, so (id, row) names a document's text."""
    src = docs.select(F.col(f"`{id_col}`").alias("id"), _text(text_col).alias("t")).select(
        "id", F.xxhash64("t").alias("row"), F.col("t").cast("binary").alias("t"))
    schema = src.drop("t").withColumns({h: F.lit(0).cast("long") for h in HASHES}).schema

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                found = [set(line_hashes(t, least)) - {None} for t in part.column(2).to_pylist()]
                of = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
                h = np.frombuffer(b"".join(x for f in found for x in f), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([part.column(0).take(of), part.column(1).take(of), pa.array(h[:, 0]), pa.array(h[:, 1])],
                                                 ["id", "row", "h1", "h2"])

    return src.mapInArrow(run, schema)


def _shard(shards: int):
    return F.pmod(F.shiftrightunsigned("h1", 20), F.lit(shards)).cast("long")


def build_index(lines: DataFrame, shards: int, min_docs: int = 2) -> DataFrame:
    """One row a shard: its number, its keys (n), the rows that will look them
    up (probes), the hash (sizes, bits), and by slot fingerprint, documents
    (up to 255), and the smallest id of the keys with ``min_docs`` or more."""
    if not 2 <= min_docs <= 255:
        raise ValueError("min_docs is 2 to 255")
    id_type = lines.schema["id"].dataType
    # a key's documents are told apart before they are counted, so a hot key is dealt by document first
    held = lines.groupBy(*HASHES, "id").agg(F.count("*").alias("m"))
    keys = held.groupBy(*HASHES).agg(F.count("*").alias("docs"), F.min("id").alias("least"), F.sum("m").alias("m"))
    keys = keys.select(_shard(shards).alias("shard"), *HASHES, F.least("docs", F.lit(255)).cast("int").alias("docs"), "m",
                       F.when(F.col("docs") >= min_docs, F.col("least")).alias("owner"))
    schema = T.StructType([T.StructField("shard", T.LongType()), T.StructField("n", T.LongType()), T.StructField("probes", T.LongType()),
                           T.StructField("sizes", T.ArrayType(T.IntegerType())), T.StructField("bits", T.BinaryType()),
                           T.StructField("fp", T.BinaryType()), T.StructField("docs", T.BinaryType()),
                           T.StructField("owners", T.ArrayType(id_type))])

    def build(table: pa.Table) -> pa.Table:
        h1, h2 = (table[h].to_numpy().view(np.uint64) for h in HASHES)
        sizes, bits, slot = build_hash(h1, h2)
        order = np.argsort(slot)
        docs = table["docs"].to_numpy()[order].astype(np.uint8)
        owners = table["owner"].take(pa.array(order)).filter(pa.array(docs >= min_docs)).combine_chunks()
        if isinstance(owners, pa.ChunkedArray):
            owners = pa.concat_arrays(owners.chunks) if owners.num_chunks else pa.array([], owners.type)
        return pa.table({"shard": table["shard"].slice(0, 1), "n": [len(h1)], "probes": [int(table["m"].to_numpy().sum())],
                         "sizes": pa.array([sizes], pa.list_(pa.int32())), "bits": [np.packbits(bits).tobytes()],
                         "fp": [(h2[order] & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes()], "docs": [docs.tobytes()],
                         "owners": pa.ListArray.from_arrays(pa.array([0, len(owners)], pa.int32()), owners)})

    return keys.groupBy("shard").applyInArrow(build, schema)


def look_up(h1: np.ndarray, h2: np.ndarray, shard: dict, min_docs: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Number of documents (0: not in the index) of each key, and where the
    shard's list of owners holds it (-1: it has none)."""
    docs = np.frombuffer(shard["docs"], np.uint8)
    fp = np.frombuffer(shard["fp"], "<u4")
    sizes = [int(s) for s in shard["sizes"]]
    bits = np.unpackbits(np.frombuffer(shard["bits"], np.uint8), count=sum(sizes)).astype(bool)
    at = slots(h1, h2, sizes, bits)
    known = at >= 0
    known[known] = fp[at[known]] == (h2[known] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    n = np.where(known, docs[at], 0) if len(docs) else np.zeros(len(at), np.uint8)
    owner = np.cumsum(docs >= min_docs) - 1
    return n, np.where(n >= min_docs, owner[at], -1) if len(docs) else np.full(len(at), -1)


def lost(lines: DataFrame, index: DataFrame, shards: int, probes: int, min_docs: int = 2) -> DataFrame:
    """(id, row, h1, h2) of the lines that their document loses: found in
    ``min_docs`` documents or more, of which another has the smallest id.

    A shard with more than ``probes`` look-ups is read by several tasks.
    """
    hot = index.where(F.col("probes") > probes).select("shard", F.ceil(F.col("probes") / probes).cast("long").alias("k"))
    lines = lines.withColumn("shard", _shard(shards))
    # at most one row for each `probes` lines; the caller bounds that at 65,536 rows of two longs
    dealt = lines.join(F.broadcast(hot), "shard", "left").withColumn(
        "salt", F.pmod(F.xxhash64("row", "id"), F.coalesce("k", F.lit(1).cast("long")))).drop("k")
    arrays = (index.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.greatest(F.col("probes") / probes, F.lit(1.0))).cast("long") - 1))))
    schema = lines.select("id", "row", *HASHES).schema

    def probe(rows: pa.Table, shard: pa.Table) -> pa.Table:
        rows = rows.select(["id", "row", *HASHES])
        if not shard.num_rows:
            return rows.slice(0, 0)
        s = shard.drop_columns(["owners"]).to_pylist()[0]
        owners = shard["owners"].combine_chunks()
        owners = (owners.chunk(0) if isinstance(owners, pa.ChunkedArray) else owners).flatten()
        n, at = look_up(*(rows[h].to_numpy().view(np.uint64) for h in HASHES), s, min_docs)
        rows, at = rows.filter(pa.array(at >= 0)), at[at >= 0]
        own = np.asarray(pc.equal(rows["id"], owners.take(pa.array(at))).fill_null(False))
        return rows.filter(pa.array(~own))

    return (dealt.groupBy("shard", "salt").cogroup(arrays.drop("n", "probes").groupBy("shard", "salt"))
            .applyInArrow(probe, schema))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple = ("doc_id",),
                        least: int = 10, min_docs: int = 2, shard_keys: int = SHARD_KEYS, probes: int = PROBES) -> DataFrame:
    """The ``carry`` columns of every row with n_lines, n_dropped and kept.

    Keys of at least ``least`` code points in ``min_docs`` documents or more
    lose all their lines but in the document with the smallest id.  Null and
    empty texts have one empty line.  Rows that share an id are one document
    when documents are counted, and each keeps the lines it owns.  Rows
    without an id are one document that comes after all others.  Texts of any
    length are read whole.  Other columns are not read, whatever their names;
    an empty table gives no rows.
    """
    lines = materialise(lines_of(docs, id_col, text_col, least), "line-keys")
    total = lines.count()
    shards = 1 << max(0, -(-total // shard_keys) - 1).bit_length()
    index = materialise(build_index(lines, shards, min_docs), "line-index")
    gone = lost(lines, index, shards, max(probes, total // 65_536), min_docs)
    gone = gone.groupBy("id", "row").agg(F.collect_set(F.struct(*HASHES)).alias("gone"))  # no more than a text has lines
    src = docs.select(F.struct(*(F.col(f"`{c}`") for c in carry)).alias("carried"), F.col(f"`{id_col}`").alias("id"), _text(text_col).alias("text"))
    src = src.withColumn("row", F.xxhash64("text")).alias("d").join(
        gone.alias("g"), (F.col("d.row") == F.col("g.row")) & F.col("d.id").eqNullSafe(F.col("g.id")), "left")
    src = src.select("carried", F.col("text").cast("binary").alias("text"), "gone")
    schema = T.StructType([T.StructField("carried", src.schema["carried"].dataType), T.StructField("n_lines", T.LongType()),
                           T.StructField("n_dropped", T.LongType()), T.StructField("kept", T.StringType())])

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                texts, n, dropped = part.column(1).to_pylist(), [], []
                has = np.nonzero(np.asarray(part.column(2).is_valid()))[0].tolist()
                n = [t.count(b"\n") + 1 for t in texts]
                dropped = [0] * len(texts)
                for i in has:
                    h = part.column(2)[i].values
                    raw = np.stack([h.field(0).to_numpy(), h.field(1).to_numpy()], axis=1).astype("<i8").tobytes()
                    out = {raw[k:k + 16] for k in range(0, len(raw), 16)}
                    keep = [x not in out for x in line_hashes(texts[i], least)]
                    dropped[i] = len(keep) - sum(keep)
                    texts[i] = b"\n".join(line for line, k in zip(texts[i].split(b"\n"), keep) if k)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(dropped, pa.int64()),
                                                  pa.array(texts, pa.binary()).cast(pa.string())], ["carried", "n_lines", "n_dropped", "kept"])

    return src.mapInArrow(run, schema).select("carried.*", "n_lines", "n_dropped", "kept")
