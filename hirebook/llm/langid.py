"""Language identification by nearest centroid.

A text becomes a vector of its hashed character 1- to 3-grams, term
frequencies damped by log1p and weighed by inverse document frequency, scaled
to length one.  Each language has several centroids, found by spherical
k-means over its training vectors.  A text gets the language of the centroid
of highest cosine.  It is *rejected* (outlier) if that cosine is below what
nearly all training vectors of that centroid reach.

Document frequencies are counted over every text that may be learned from, in
one pass of one partial count a task.  The centroids come from a documented
sample: of each language the ``per_lang`` different rows of smallest hash of
id and text, so neither the order of rows nor the layout matters and a row that
repeats counts once.  Each language is clustered in a task of its own; only the
model comes to the driver.  Prediction reads every whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirebook.llm.common import lean

DIM = 1 << 13
MAX_LANGS = 1000
STEP = 1 << 20
DRAWS = 1 << 62


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of the lower-cased text and how often each occurs.

    Runs of other characters than letters count as one space, so digits,
    symbols and line breaks say nothing about the language.
    """
    counts = np.zeros(DIM, np.int64)
    low = (text or "").lower()
    for at in range(0, len(low), STEP):
        c = np.frombuffer(low[max(0, at - 2):at + STEP].encode("utf-32-le", "replace"), "<u4").astype(np.int64)
        letter = _letters()[np.minimum(c, len(_letters()) - 1)]
        c = np.where(letter, c, 32)
        c = c[letter | np.append(True, letter[:-1])]
        one = c * 2654435761
        two = one[:-1] * 31 + c[1:] * 40503 + 1
        three = two[:-1] * 31 + c[2:] * 9973 + 2
        for h in (one, two, three):
            counts += np.bincount(((h ^ (h >> 17)) & 0x7FFFFFFF) % DIM, minlength=DIM)
    at = np.nonzero(counts)[0]
    return at, counts[at]


_LETTERS: list = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.array([chr(i).isalpha() for i in range(0x30000)] + [False]))
    return _LETTERS[0]


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


@dataclass(frozen=True)
class Model:
    """langs: label of each centroid; centroids: rows of length one; idf;
    reject: the least cosine that is accepted, per centroid."""

    langs: tuple
    centroids: np.ndarray
    idf: np.ndarray
    reject: np.ndarray


def vector(at: np.ndarray, n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Values of the normalised TF-IDF vector at positions ``at``."""
    x = np.log1p(n) * idf[at]
    norm = np.sqrt((x * x).sum())
    return x / norm if norm else x


def _kmeans(x: np.ndarray, k: int, rng) -> np.ndarray:
    """Spherical k-means; the first seed is the mean, others the worst served."""
    c = [x.mean(axis=0)]
    for _ in range(1, min(k, len(x))):
        c.append(x[np.argmin(np.max(x @ _unit(np.array(c)).T, axis=1))])
    c = _unit(np.array(c))
    for _ in range(10):
        of = np.argmax(x @ c.T, axis=1)
        c = _unit(np.array([x[of == i].sum(axis=0) if (of == i).any() else c[i] for i in range(len(c))]))
    return c[np.unique(np.argmax(x @ c.T, axis=1))]


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-30)


def idf_of(texts: int, df: np.ndarray) -> np.ndarray:
    """Inverse document frequency from the texts that hold a gram at all and
    those that hold each."""
    return (np.log((1 + texts) / (1 + df)) + 1).astype(np.float32)


def fit_language(samples: list[tuple[np.ndarray, np.ndarray]], idf: np.ndarray, clusters: int = 4, outliers: float = 0.005,
                 seed: int = 3) -> tuple[np.ndarray, list[float]]:
    """Centroids of one language's (positions, counts), and the least cosine
    that each accepts."""
    x = np.zeros((len(samples), DIM), np.float32)
    for row, (at, n) in zip(x, samples):
        row[at] = vector(at, n, idf)
    c = _kmeans(x, clusters, np.random.default_rng(seed))
    cos = x @ c.T
    of = cos.argmax(axis=1)
    return c, [float(np.quantile(cos[of == i, i], outliers)) if (of == i).any() else 0.0 for i in range(len(c))]


def fit(samples: list[tuple[str, np.ndarray, np.ndarray]], **settings) -> Model:
    """Learn from (language, positions, counts) of each text, the idf included."""
    samples = [s for s in samples if len(s[1])]
    df = np.zeros(DIM)
    for _, at, _ in samples:
        df[at] += 1
    idf = idf_of(len(samples), df)
    return _model(idf, [(lang, *fit_language([s[1:] for s in samples if s[0] == lang], idf, **settings)) for lang in sorted({s[0] for s in samples})])


def _model(idf: np.ndarray, fitted: list[tuple[str, np.ndarray, list[float]]]) -> Model:
    return Model(tuple(lang for lang, c, _ in fitted for _ in c), np.array([row for _, c, _ in fitted for row in c], np.float32).reshape(-1, DIM),
                 idf, np.array([r for _, _, rejects in fitted for r in rejects], np.float32))


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """How many texts of a one-column table hold a gram at all, and how many
    hold each: one partial count a task, summed by position."""
    def run(batches):
        df = np.zeros(DIM + 1, np.int64)
        for b in batches:
            for text in b.column(0):
                at, _ = grams(text.as_py())
                df[at] += 1
                df[DIM] += len(at) > 0
        at = np.nonzero(df)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(df[at])], ["at", "n"])

    counts = np.zeros(DIM + 1)
    for at, n in texts.mapInArrow(lean(run), "at int, n long").groupBy("at").agg(F.sum("n")).collect():  # DIM + 1 rows at most
        counts[at] = n
    return int(counts[DIM]), counts[:DIM]


def sample_rows(named: DataFrame, per_lang: int) -> DataFrame:
    """Of (_lang, _draw, _text) the ``per_lang`` different rows of smallest
    _draw of each language (MAX_LANGS at most, else ValueError).

    A first look gives each language's number of different draws; the share
    of them that holds twice what is wanted is ranked, and the last wanted draw
    bounds the second look.  Repeated rows fall together in each task.
    """
    seen = named.groupBy("_lang").agg(F.approx_count_distinct("_draw").alias("n")).limit(MAX_LANGS + 1).collect()
    if len(seen) > MAX_LANGS:
        raise ValueError(f"over {MAX_LANGS} languages")

    def below(bounds):
        table = F.create_map(*(F.lit(v) for kv in sorted(bounds.items()) for v in kv))
        return F.col("_draw") <= table[F.col("_lang")]

    if not seen:
        return named.where(F.lit(False))
    share = {r[0]: int(min(1.0, (2 * per_lang + 100) / max(r[1], 1)) * DRAWS) for r in seen}
    by_draw = Window.partitionBy("_lang").orderBy("_draw")
    ranked = named.where(below(share)).select("_lang", "_draw").distinct().withColumn("_rank", F.row_number().over(by_draw))
    last = {r[0]: r[1] for r in ranked.where(F.col("_rank") <= per_lang).groupBy("_lang").agg(F.max("_draw")).collect()}
    return named.where(below(last)).groupBy("_lang", "_draw").agg(F.min("_text").alias("_text"))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = 400,
          **settings) -> Model:
    """Fit on ``per_lang`` different rows of each language (all, if fewer), the
    idf on all rows; rows without a language or without a letter teach nothing."""
    lang = F.col(lang_col).cast("string")
    draw = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.col(text_col), F.lit(17)), F.lit(DRAWS))
    named = docs.where(lang.isNotNull()).select(lang.alias("_lang"), draw.alias("_draw"), F.col(text_col).alias("_text"))
    idf = idf_of(*document_frequencies(named.select("_text")))

    def learn(key, rows):
        got = [grams(t) for t in rows.sort_values("_draw")["_text"]]
        got = [g for g in got if len(g[0])]
        c, reject = fit_language(got, idf, **settings) if got else (np.zeros((0, DIM), np.float32), [])
        return pd.DataFrame({"lang": [key[0]] * len(c), "part": range(len(c)), "centroid": [row.astype("<f4").tobytes() for row in c], "reject": reject})

    held = named.where(F.regexp_like("_text", F.lit(r"\p{L}")))
    fitted: dict = {}
    rows = sample_rows(held, per_lang).groupBy("_lang").applyInPandas(learn, "lang string, part int, centroid binary, reject double")
    for r in sorted(rows.collect(), key=lambda r: (r.lang, r.part)):  # the model
        c, reject = fitted.setdefault(r.lang, ([], []))
        c.append(np.frombuffer(r.centroid, "<f4"))
        reject.append(r.reject)
    return _model(idf, [(lang, np.array(c), reject) for lang, (c, reject) in fitted.items()])


def predict(docs: DataFrame, model: Model, text_col: str = "text", carry: tuple = ("doc_id",), rows: int = 64) -> DataFrame:
    """The ``carry`` columns of every row with lang_pred, score and outlier.

    lang_pred is a learned language, or "und" if the text is null or has no
    letter (score 0) or nothing was learned.  score: the cosine, 0 to 1.
    outlier: rejected by distance.  Repeated rows each get a row; other
    columns are not read; an empty table gives no rows.
    """
    src = docs.select(*(F.col(f"`{c}`") for c in carry), F.col(text_col).alias("_text"))
    schema = src.drop("_text").withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0), "outlier": F.lit(True)}).schema
    names = schema.fieldNames()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x clusters x DIM floats

    def run(batches):
        m = shared.value
        for b in batches:
            for at in range(0, b.num_rows, rows):
                part = b.slice(at, rows)
                texts = part.column(len(carry)).to_pylist()
                known = [bool(m.langs) and has_letter(t) for t in texts]
                x = np.zeros((len(texts), DIM), np.float32)
                for row, t, k in zip(x, texts, known):
                    if k:
                        i, n = grams(t)
                        row[i] = vector(i, n, m.idf)
                cos = x @ m.centroids.T if m.langs else np.zeros((len(texts), 1), np.float32)
                best = cos.argmax(axis=1)
                top = cos[np.arange(len(best)), best]
                yield pa.RecordBatch.from_arrays([
                    *(part.column(i) for i in range(len(carry))),
                    pa.array([m.langs[i] if k else "und" for i, k in zip(best, known)], pa.string()),
                    pa.array(np.clip(np.where(known, top, 0), 0, 1).astype(np.float64)),
                    pa.array([not k or bool(t < m.reject[i]) for i, t, k in zip(best, top, known)])], names)

    return src.mapInArrow(run, schema)
