"""Hard-negative mining with angular triangle filtering.

Components are put on an integer grid; a score is an integer inner product.
Every row stores its norm and its angles to a few reference directions.  By
the triangle inequality of angles, an anchor at angle s and a row at angle t
to one reference are between |s - t| and s + t apart, so their cosine lies in
an interval, and times the norms it bounds their score (widened for rounding).

Rows are dealt to the reference next to them, sorted by their angle to it and
cut into blocks; neighbouring blocks make a cell.  An anchor is sent to the
cells whose intervals can meet the scores it looks for, skips blocks that
can't, and within a block the angles give one window of rows: only that gets
integer scoring.  What an anchor looks for is known in steps: its own cell
gives a first bound of its k-th best positive, the other cells that can beat it
the positives themselves, and those the score intervals of the negatives.

Blocks hold a bounded number of rows and anchors travel in bounded chunks; a
cell's rows and chunks meet by a join on the cell, one pair at a time.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirebook.llm.common import materialise

BINS = 512  # of the angle to a reference
SLACK = 1e-6  # radians; an angle's rounding error is below 1e-7
CELLS = 4096  # at most about so many, whatever the number of rows
SAMPLE = 2048  # rows that the reference directions are fitted on
INT = np.dtype("<i4")


def references(x: np.ndarray, count: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    """Unit directions fitted to sample rows (spherical k-means from rows far
    from each other); rows of length zero don't count, if there are no others
    the first axis is the only direction."""
    size = np.linalg.norm(x, axis=1)
    u = x[size > 0] / size[size > 0, None]
    if not len(u):
        return np.eye(1, x.shape[1])
    pick, best = [int(np.random.default_rng(seed).integers(len(u)))], np.full(len(u), -1.0)
    while len(pick) < min(count, len(u)):
        best = np.maximum(best, u @ u[pick[-1]])
        pick.append(int(best.argmin()))
    c = u[pick]
    for _ in range(rounds):
        of = (u @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, of, u)
        length = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(length > 1e-9, total / np.maximum(length, 1e-9), c)
    return c


def angles(x: np.ndarray, norm: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Angles of rows to references; a row of length zero is at a right angle
    to all (its scores are zero, which any angle bounds)."""
    return np.arccos(np.clip((x @ refs.T) / np.where(norm > 0, norm, 1.0)[:, None], -1, 1))


def score_bounds(s: np.ndarray, na: float, lo: np.ndarray, hi: np.ndarray, nlo: np.ndarray, nhi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that an anchor (angles ``s``, norm ``na``) can
    have with rows whose angles lie in [lo, hi] and norms in [nlo, nhi], over
    boxes: rows of ``lo`` and ``hi`` are boxes, columns references."""
    near = np.maximum(np.maximum(lo - s, s - hi), 0).max(axis=1) - SLACK
    far = np.minimum(np.minimum(s + hi, 2 * np.pi - s - lo), np.pi).min(axis=1) + SLACK
    top, bottom = np.cos(np.clip(near, 0, np.pi)), np.cos(np.clip(far, 0, np.pi))
    up = np.where(top > 0, top * nhi, top * nlo) * na
    down = np.where(bottom > 0, bottom * nlo, bottom * nhi) * na
    wide = 1 + 1e-9 * na * nhi
    return np.floor(down - wide), np.ceil(up + wide)


def window(s: float, na: float, theta: np.ndarray, nlo: float, nhi: float, lo: int, hi: int) -> tuple[int, int]:
    """The range of rows, sorted by their angle ``theta`` to one reference,
    outside which no score lies in [lo, hi]."""
    first, last, most, least = 0, len(theta), na * nhi, na * nlo
    wide = 1 + 1e-9 * most
    if lo > wide:
        if lo - wide > most:
            return 0, 0
        reach = math.acos((lo - wide) / most) + SLACK
        first, last = np.searchsorted(theta, s - reach), np.searchsorted(theta, s + reach, "right")
    if 0 <= hi + wide < least:  # nearer rows have a score above hi for sure
        first = max(first, np.searchsorted(theta, math.acos((hi + wide) / least) - SLACK - s))
    return int(first), int(max(first, last))


def packed(x: np.ndarray) -> pa.Array:
    """Rows of a matrix as binary values."""
    return pa.array([r.tobytes() for r in x], pa.binary())


def one_list(column) -> pa.Array:
    """A column as a single list value."""
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = pa.concat_arrays(values.chunks) if isinstance(values, pa.ChunkedArray) else values
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


class Pool:
    """The rows that take part, in blocks (one row each) and cells.

    ``anchors``: the condition that makes a row an anchor."""

    def __init__(self, vectors: DataFrame, anchors: Column, id_col: str, vec_col: str, label_col: str, scale: int, refs: int,
                 block: int, cell: int, seed: int):
        v = F.col(f"`{vec_col}`")
        good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) * scale < float(1 << 31)))
        rows = vectors.where(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isNotNull() & v.isNotNull() & good).select(
            F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"),
            F.coalesce(anchors, F.lit(False)).alias("anchor"), F.transform(v, lambda x: F.floor(x.cast("double") * scale)).alias("v"))
        rows = rows.where(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x) < 2.0**62)  # a score must fit a long
        size = F.size("v")
        common = rows.where(size > 0).groupBy(size.alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
        self.count, self.dim = (common["count"], common["dim"]) if common else (0, 0)
        self.id_type, self.label_type = rows.schema["id"].dataType, rows.schema["label"].dataType
        if not self.count:
            return
        rows = materialise(rows.where(size == self.dim), "negatives-rows")
        sample = rows.orderBy(F.xxhash64("row", F.lit(seed)), "row").select("v").limit(SAMPLE).collect()
        self.refs = references(np.array([r[0] for r in sample], np.float64), refs, seed=seed)
        placed = materialise(self._placed(rows), "negatives-placed")
        bins = sorted(placed.groupBy("ref", "bin").count().collect())  # refs x BINS rows at most
        before = np.concatenate([[0], np.cumsum([r["count"] for r in bins])[:-1]])
        blocks = vectors.sparkSession.createDataFrame(
            [(r["ref"], r["bin"], int(b) // block, -(-r["count"] // block)) for r, b in zip(bins, before)], "ref int, bin int, first long, parts long")
        per_cell = max(1, cell // block, -(-self.count // (block * CELLS)))
        self.rows = (placed.join(F.broadcast(blocks), ["ref", "bin"])
                     .withColumn("block", F.col("first") + F.pmod(F.xxhash64("row"), F.col("parts")))
                     .withColumn("cell", F.floor(F.col("block") / per_cell).cast("long")).drop("ref", "bin", "first", "parts"))
        self.blocks = materialise(self._blocks(), "negatives-blocks")
        self.anchors = materialise(self.rows.where("anchor").drop("anchor", "block"), "negatives-anchors")
        k = range(len(self.refs))
        boxes = self.blocks.groupBy("cell").agg(*(F.min(F.col("lo")[i]).alias(f"lo{i}") for i in k), *(F.max(F.col("hi")[i]).alias(f"hi{i}") for i in k),
                                                F.min("nlo").alias("nlo"), F.max("nhi").alias("nhi"))
        boxes = boxes.orderBy("cell").toPandas()  # at most about CELLS rows
        self.boxes = (boxes["cell"].to_numpy(), boxes[[f"lo{i}" for i in k]].to_numpy(), boxes[[f"hi{i}" for i in k]].to_numpy(),
                      boxes["nlo"].to_numpy(), boxes["nhi"].to_numpy())

    def _placed(self, rows: DataFrame) -> DataFrame:
        """Rows with packed vector, norm, angles, next reference and the bin of the angle to it."""
        refs, kept = self.refs, rows.drop("v").columns
        schema = rows.drop("v").withColumns({"x": F.lit(b""), "norm": F.lit(0.0), "theta": F.lit(b""), "ref": F.lit(0), "bin": F.lit(0)}).schema

        def run(batches):
            for b in batches:
                for at in range(0, b.num_rows, 4096):
                    part = b.slice(at, 4096)
                    x = part.column(len(kept)).flatten().to_numpy().reshape(part.num_rows, -1).astype(np.float64)
                    norm = np.sqrt(np.square(x).sum(axis=1))
                    theta = angles(x, norm, refs)
                    home = theta.argmin(axis=1)
                    bins = np.minimum(theta[np.arange(len(home)), home] * (BINS / np.pi), BINS - 1).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(kept))), packed(x.astype(INT)), pa.array(norm), packed(theta),
                                                      pa.array(home.astype(np.int32)), pa.array(bins)], schema.fieldNames())

        return rows.select(*kept, "v").mapInArrow(run, schema)

    def _blocks(self) -> DataFrame:
        """A row a block: numbers, ids, labels and packed vectors of its rows,
        sorted by angle to one reference, and the intervals of all angles and norms."""
        k = len(self.refs)
        numbers = T.ArrayType(T.DoubleType())
        schema = (T.StructType().add("cell", T.LongType()).add("rows", T.ArrayType(T.LongType())).add("ids", T.ArrayType(self.id_type))
                  .add("labels", T.ArrayType(self.label_type)).add("x", T.BinaryType()).add("ref", T.IntegerType()).add("angle", numbers)
                  .add("lo", numbers).add("hi", numbers).add("nlo", T.DoubleType()).add("nhi", T.DoubleType()))

        def pack(table: pa.Table) -> pa.Table:
            theta = np.frombuffer(b"".join(table["theta"].to_pylist()), "<f8").reshape(-1, k)
            ref = int(np.bincount(theta.argmin(axis=1)).argmax())
            order = np.argsort(theta[:, ref], kind="stable")
            norm, theta, table = table["norm"].to_numpy(), theta[order], table.take(pa.array(order))

            def listed(values):
                return pa.array([values.tolist()], pa.list_(pa.float64()))

            return pa.table([table["cell"].slice(0, 1), one_list(table["row"]), one_list(table["id"]), one_list(table["label"]),
                             pa.array([b"".join(table["x"].to_pylist())], pa.binary()), pa.array([ref], pa.int32()), listed(theta[:, ref]),
                             listed(theta.min(axis=0)), listed(theta.max(axis=0)), pa.array([norm.min()]), pa.array([norm.max()])], names=schema.fieldNames())

        return self.rows.drop("anchor").groupBy("block").applyInArrow(pack, schema)

    def look(self, asked: DataFrame, same: bool, best: int, cells: str, chunk: int = 1024) -> DataFrame:
        """(row, slot, other_id, score): for each anchor of ``asked`` (columns
        of ``anchors`` with ``lows`` and ``highs``, a score interval a slot) the
        ``best`` rows by score and id in each interval among those of the same,
        or of another, label.  ``cells``: "home", "away" or "all" of them."""
        refs, boxes = self.refs, asked.sparkSession.sparkContext.broadcast(self.boxes)  # at most about CELLS rows
        number = T.ArrayType(T.LongType())
        sent = (T.StructType().add("to", T.LongType()).add("a_rows", number).add("a_labels", T.ArrayType(self.label_type)).add("a_x", T.BinaryType())
                .add("a_norm", T.BinaryType()).add("a_theta", T.BinaryType()).add("a_lows", T.ArrayType(number)).add("a_highs", T.ArrayType(number)))

        def send(batches):
            cell, lo, hi, nlo, nhi = boxes.value
            for b in batches:
                for at in range(0, b.num_rows, chunk):
                    part = b.slice(at, chunk)
                    theta = np.frombuffer(b"".join(part.column(4).to_pylist()), "<f8").reshape(-1, len(refs))
                    norm, home = part.column(3).to_numpy(), part.column(7).to_numpy()
                    go = np.zeros((part.num_rows, len(cell)), bool)
                    for i, (least, most) in enumerate(zip(part.column(5).to_pylist(), part.column(6).to_pylist())):
                        if least and cells == "home":
                            go[i] = cell == home[i]
                        elif least:
                            down, up = score_bounds(theta[i], norm[i], lo, hi, nlo, nhi)
                            go[i] = (up >= min(least)) & (down <= max(most)) & ((cell != home[i]) | (cells == "all"))
                    for j in np.nonzero(go.any(axis=0))[0]:
                        some = np.nonzero(go[:, j])[0]
                        to = part.take(pa.array(some))
                        yield pa.RecordBatch.from_arrays([
                            pa.array([cell[j]]), one_list(to.column(0)), one_list(to.column(1)), pa.array([b"".join(to.column(2).to_pylist())], pa.binary()),
                            pa.array([norm[some].tobytes()]), pa.array([theta[some].tobytes()]), one_list(to.column(5)), one_list(to.column(6))], sent.fieldNames())

        chunks = asked.select("row", "label", "x", "norm", "theta", "lows", "highs", "cell").mapInArrow(send, sent)
        tasks = int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        pairs = self.blocks.repartition(tasks, "cell").join(chunks.repartition(tasks, "to"), F.col("cell") == F.col("to")).drop("cell", "to")
        out = (T.StructType().add("row", T.LongType()).add("slot", T.IntegerType()).add("other_id", self.id_type).add("score", T.LongType()))

        def score(batches):
            for b in batches:
                for r in range(b.num_rows):
                    found = score_pair({f: b.column(f)[r] for f in b.schema.names}, len(refs), same, best)
                    ids = b.column("ids")[r].values
                    yield pa.RecordBatch.from_arrays([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int32()),
                                                      ids.take(pa.array(found[2], pa.int64())), pa.array(found[3], pa.int64())], out.fieldNames())

        return top(pairs.mapInArrow(score, out), best)


def score_pair(pair: dict, refs: int, same: bool, best: int) -> tuple[list, list, list, list]:
    """Anchor rows, slots, positions in the block and scores of the ``best``
    rows of one block for each anchor of one chunk."""
    def plain(name):
        return pair[name].values.to_numpy(zero_copy_only=False)

    rows, labels, angle, ref = plain("rows"), plain("labels"), plain("angle"), pair["ref"].as_py()
    lo, hi, nlo, nhi = plain("lo")[None], plain("hi")[None], pair["nlo"].as_py(), pair["nhi"].as_py()
    x = np.frombuffer(pair["x"].as_buffer(), INT).reshape(len(rows), -1)
    anchors = np.frombuffer(pair["a_x"].as_buffer(), INT).reshape(-1, x.shape[1])
    norm, theta = np.frombuffer(pair["a_norm"].as_buffer()), np.frombuffer(pair["a_theta"].as_buffer()).reshape(-1, refs)
    rank = np.empty(len(rows), np.int64)
    rank[np.argsort(plain("ids"), kind="stable")] = np.arange(len(rows))
    whole = norm.max(initial=0) * nhi < 2.0**53  # integers in doubles are exact then
    x = x.astype(np.float64 if whole else np.int64)
    out = [], [], [], []
    for i, (number, label, least, most) in enumerate(zip(plain("a_rows").tolist(), plain("a_labels").tolist(), pair["a_lows"].as_py(), pair["a_highs"].as_py())):
        down, up = score_bounds(theta[i], norm[i], lo, hi, np.array([nlo]), np.array([nhi]))
        if up[0] < min(least) or down[0] > max(most):
            continue
        first, last = window(theta[i, ref], norm[i], angle, nlo, nhi, min(least), max(most))
        some = first + np.nonzero(((labels[first:last] == label) == same) & (rows[first:last] != number))[0]
        if not len(some):
            continue
        score = (x[first:last] @ anchors[i].astype(x.dtype)).astype(np.int64)[some - first]
        for slot, (a, b) in enumerate(zip(least, most)):
            fit = np.nonzero((score >= a) & (score <= b))[0]
            if len(fit) > 4 * best:  # all that tie with the last of the best stay until they are sorted
                fit = fit[score[fit] >= np.partition(score[fit], -best)[-best]]
            fit = fit[np.lexsort((rank[some[fit]], -score[fit]))][:best]
            out[0].extend([number] * len(fit))
            out[1].extend([slot] * len(fit))
            out[2].extend(some[fit].tolist())
            out[3].extend(score[fit].tolist())
    return out


def top(found: DataFrame, best: int) -> DataFrame:
    """The ``best`` of each (row, slot), with their rank."""
    order = Window.partitionBy("row", "slot").orderBy(F.desc("score"), "other_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)


def hard_negatives(vectors: DataFrame, anchors: Column, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                   positives: int = 5, negatives: int = 5, share: tuple[int, int] = (80, 100), scale: int = 256, refs: int = 16,
                   block: int = 4096, cell: int = 16384, seed: int = 3) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A row's entries become floor(scale * x).  For each anchor (rows where the
    condition ``anchors`` holds) and each of its ``positives`` best other rows
    of its label: the ``negatives`` best rows of other labels whose score n
    and the positive's p satisfy ``share[0] * p <= share[1] * n <= share[1] * p``.
    Best is by score, ties by the smaller id; fewer where there are fewer.

    Rows with a null id, label or vector, a null or non-finite entry, an entry
    of 2**31 or more on the grid, a squared norm of 2**62 or more (its scores
    need not fit a long), or another length than the commonest (of several,
    the longest) take no part.  Rows that repeat an id are rows of their own,
    as anchors too.  Zero vectors score 0.  Other columns are not read; an
    empty table, or one label alone, gives no rows.
    """
    pool = Pool(vectors, anchors, id_col, vec_col, label_col, scale, refs, block, cell, seed)
    schema = (T.StructType().add("anchor_id", vectors.schema[id_col].dataType).add("positive_id", vectors.schema[id_col].dataType).add("rank", T.IntegerType())
              .add("negative_id", vectors.schema[id_col].dataType).add("positive_score", T.LongType()).add("negative_score", T.LongType()))
    if not pool.count:
        return vectors.sparkSession.createDataFrame([], schema)

    def one(value):
        return F.array(F.lit(value).cast("long"))

    asked = pool.anchors.withColumns({"lows": one(-(1 << 62)), "highs": one(1 << 62)})
    near = materialise(pool.look(asked, True, positives, "home").drop("rank"), "negatives-home")
    bound = near.groupBy("row").agg(F.when(F.count("*") >= positives, F.min("score")).alias("bound"))
    asked = pool.anchors.join(bound, "row", "left").withColumns(
        {"lows": F.array(F.coalesce("bound", F.lit(-(1 << 62)).cast("long"))), "highs": one(1 << 62)})
    best = materialise(top(near.unionByName(pool.look(asked, True, positives, "away").drop("rank")), positives), "negatives-positives")

    less, whole = share
    # share[0] * p <= share[1] * n in integers, without products that could pass a long's range
    least = F.ceil(F.col("score").cast("decimal(25,0)") * less / whole).cast("long")
    sought = best.withColumn("least", least).where(F.col("least") <= F.col("score"))
    asked = pool.anchors.join(sought.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("rank", "least", "score"))).alias("p")), "row")
    asked = asked.withColumns({"lows": F.transform("p", lambda s: s["least"]), "highs": F.transform("p", lambda s: s["score"])})
    found = pool.look(asked, False, negatives, "all")
    ids = pool.anchors.select("row", F.col("id").alias("anchor_id"))
    slots = asked.select("row", F.posexplode("p").alias("slot", "s")).select("row", "slot", "s.rank")
    positive = slots.join(best.select("row", "rank", F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")), ["row", "rank"]).drop("rank")
    return found.join(positive, ["row", "slot"]).join(ids, "row").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
