"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages (``PASSAGE_WORDS`` words each, the whole text).
Every passage is encoded: histograms of its bytes and of hashed byte pairs and
a few counts of words go through one learned tanh layer.  Gated attention
(``softmax(w . (tanh(V h) * sigmoid(U h)))``) weighs the passages, and the
weighted sum is scored by a logistic output.  Only documents have labels; all
weights are learned from them together, by Adam with gradients written out.

The fit uses at most ``per_label`` labelled documents of each label, those
with the smallest hashes of their id, as long as all their passages together
stay within ``passages``; a document is learned from whole or not at all, so
what the driver holds is bounded.  Scoring covers every passage of every
document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirebook.llm.common import lean

PASSAGE_WORDS = 128
PAIRS = 256
COUNTS = 6
WIDTH = 256 + PAIRS + COUNTS


def encode(text: bytes | None) -> np.ndarray:
    """Feature rows of all passages (one zero row for a text without words)."""
    words = (text or b"").split()
    if not words:
        return np.zeros((1, WIDTH), np.float32)
    out = np.zeros((-(-len(words) // PASSAGE_WORDS), WIDTH), np.float32)
    for i, row in enumerate(out):
        part = words[i * PASSAGE_WORDS:(i + 1) * PASSAGE_WORDS]
        raw = np.frombuffer(b" ".join(part), np.uint8)
        row[:256] = np.sqrt(np.bincount(raw, minlength=256) / len(raw))
        pair = (raw[1:].astype(np.int64) * 131 + raw[:-1] * 31) % PAIRS
        row[256:256 + PAIRS] = np.sqrt(np.bincount(pair, minlength=PAIRS) / len(raw))
        n = len(part)
        row[256 + PAIRS:] = (1.0, len(set(part)) / n, sum(map(bytes.__eq__, part[1:], part)) / n, n / PASSAGE_WORDS,
                             min(len(raw) / n, 40.0) / 20, sum(map(bytes.isalnum, part)) / n)
    return out


@dataclass
class Model:
    """Layer sizes: WIDTH -> hidden, attention of size ``gate``."""

    w: np.ndarray
    b: np.ndarray
    v: np.ndarray
    u: np.ndarray
    a: np.ndarray
    c: np.ndarray
    d: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.w, self.b, self.v, self.u, self.a, self.c, self.d]


def forward(m: Model, x: np.ndarray, start: np.ndarray) -> tuple:
    """Scores (logits) of bags of rows; bag k begins at row ``start[k]``."""
    h = np.tanh(x @ m.w + m.b)
    t, s = np.tanh(h @ m.v), 1 / (1 + np.exp(-(h @ m.u)))
    e = (t * s) @ m.a
    size = np.diff(np.append(start, len(x)))
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, start), size))
    alpha = e / np.repeat(np.add.reduceat(e, start), size)
    z = np.add.reduceat(h * alpha[:, None], start, axis=0)
    return z @ m.c + m.d[0], h, t, s, alpha, z, size


def _gradients(m: Model, x: np.ndarray, start: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    logit, h, t, s, alpha, z, size = forward(m, x, start)
    g = (1 / (1 + np.exp(-logit)) - y) / len(y)
    dz = g[:, None] * m.c
    rows = np.repeat(dz, size, axis=0)
    gain = (h * rows).sum(axis=1)
    de = alpha * (gain - np.repeat(np.add.reduceat(gain * alpha, start), size))
    dt, ds = de[:, None] * m.a * s * (1 - t * t), de[:, None] * m.a * t * s * (1 - s)
    dh = (rows * alpha[:, None] + dt @ m.v.T + ds @ m.u.T) * (1 - h * h)
    return [x.T @ dh, dh.sum(axis=0), h.T @ dt, h.T @ ds, (t * s).T @ de, z.T @ g, np.array([g.sum()], np.float32)]


def fit(bags: list[np.ndarray], labels: np.ndarray, hidden: int = 24, gate: int = 12, epochs: int = 30, batch: int = 64,
        rate: float = 0.01, decay: float = 1e-4, seed: int = 5) -> Model:
    """Learn a model; a label that is missing or alone gives a constant one."""
    rng = np.random.default_rng(seed)

    def draw(*shape):
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    m = Model(draw(WIDTH, hidden), np.zeros(hidden, np.float32), draw(hidden, gate), draw(hidden, gate), draw(gate),
              draw(hidden), np.zeros(1, np.float32))
    y = np.asarray(labels, np.float32)
    if not len(y) or y.min() == y.max():
        m.c[:] = 0
        m.d[0] = 0 if not len(y) else (4 if y[0] else -4)
        return m
    first, second = [np.zeros_like(p) for p in m.parts()], [np.zeros_like(p) for p in m.parts()]
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), batch):
            pick = order[at:at + batch]
            size = np.array([len(bags[i]) for i in pick])
            grads = _gradients(m, np.concatenate([bags[i] for i in pick]).astype(np.float32), np.cumsum(size) - size, y[pick])
            step += 1
            lr = rate * (1 - epoch / epochs) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for p, g, f, q in zip(m.parts(), grads, first, second):
                f += 0.1 * (g - f)
                q += 0.001 * (g * g - q)
                p -= lr * (f / (np.sqrt(q) + 1e-8)) + rate * decay * p
    return m


def sample_labels(labels: DataFrame, per_label: int, id_col: str, label_col: str) -> DataFrame:
    """At most ``per_label`` ids of each label 0 and 1 (smallest hashes); an
    id with several labels counts by the smallest."""
    one = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("_id")).agg(
        F.min(label_col).cast("int").alias("_y"))
    order = F.xxhash64("_id", F.lit(11)), F.col("_id")
    return one.where("_y = 0").orderBy(*order).limit(per_label).union(one.where("_y = 1").orderBy(*order).limit(per_label))


def whole_documents(src: DataFrame, passages: int) -> DataFrame:
    """The rows (_id, _y, _t) to learn from: for each label, in the order of
    their hashes, as many as have ``passages`` passages together.  A document
    with over an eighth of them would crowd out the others and is passed over."""
    n = F.ceil(F.size(F.split(F.col("_t").cast("string"), r"[\x20\x09-\x0D]+")) / PASSAGE_WORDS).cast("long")
    order = Window.partitionBy("_y").orderBy(F.xxhash64("_id", F.lit(11)), "_id")  # per_label rows at most
    counted = src.withColumn("_n", F.coalesce(n, F.lit(1).cast("long"))).where(F.col("_n") <= passages // 8)
    return counted.withColumn("_sum", F.sum("_n").over(order)).where(F.col("_sum") <= passages).select("_id", "_y", "_t")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          per_label: int = 1200, passages: int = 40_000, **settings) -> Model:
    """Fit on the sampled documents.  ``labels`` holds the rows to learn from
    (leave held-out ones out).  Documents without a label aren't read further;
    of rows that repeat an id, the one with the least text counts."""
    picked = sample_labels(labels, per_label, id_col, label_col)
    src = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("binary").alias("_t"))
    src = src.join(F.broadcast(picked), "_id")  # at most 2 * per_label rows
    src = whole_documents(src.groupBy("_id", "_y").agg(F.min("_t").alias("_t")), passages)

    def run(batches):
        for b in batches:
            for i, y, t in zip(*(b.column(k).to_pylist() for k in range(3))):
                yield pa.RecordBatch.from_arrays([pa.array([str(i)]), pa.array([y], pa.int32()),
                                                  pa.array([encode(t).astype(np.float16).tobytes()], pa.binary())], ["id", "y", "x"])

    got = sorted(src.mapInArrow(lean(run), "id string, y int, x binary").collect())  # 1 kB a passage
    bags = [np.frombuffer(r[2], np.float16).reshape(-1, WIDTH) for r in got]
    return fit(bags, np.array([r[1] for r in got]), **settings)


def _chances(model: Model, texts: list) -> np.ndarray:
    bags = [encode(t) for t in texts]
    size = np.array([len(x) for x in bags])
    return 1 / (1 + np.exp(-forward(model, np.concatenate(bags), np.cumsum(size) - size)[0].astype(np.float64)))


def score(docs: DataFrame, model: Model, text_col: str = "text", carry: tuple = ("doc_id",), rows: int = 128) -> DataFrame:
    """The ``carry`` columns of every row with score (0 to 1) and predicted.

    Null, empty and blank texts are one empty passage.  Very long texts are
    encoded whole (2 kB a passage).  Repeated rows each get a row; other
    columns are not read, and a carried one may be named as those added are
    (the result then has two of that name); an empty table gives no rows.
    """
    src = docs.select(F.struct(*(F.col(f"`{c}`") for c in carry)).alias("carried"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    schema = src.select("carried", F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, rows):
                part = b.slice(at, rows)
                p = _chances(model, part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], schema.fieldNames())

    return src.mapInArrow(lean(run), schema).select("carried.*", "score", "predicted")


def drop_low_quality(docs: DataFrame, model: Model, text_col: str = "text", rows: int = 128) -> DataFrame:
    """``docs`` without the rows that the model rejects, all columns kept.

    Rows go to Python once and only those that stay come back.  Nulls, empty
    and very long texts as in ``score``; repeated rows share their verdict.
    """
    at_text = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, rows):
                part = b.slice(at, rows)
                stay = _chances(model, part.column(at_text).cast(pa.binary()).to_pylist()) >= 0.5
                if stay.any():
                    yield part.filter(pa.array(stay))

    return docs.mapInArrow(lean(run), docs.schema)
