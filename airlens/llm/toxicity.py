"""Toxicity by a classifier chain.

Categories are predicted one after another: each is a logistic model over the
document's words and the probabilities of the categories before it. In the
fit those probabilities are out of fold: ``folds`` models, each tried on the
texts it has not seen (equal texts share a fold). They also give each category
the threshold of best F1, which the fit returns with it. Features are lower-cased runs
of letters and their beginnings of 4 to 7 letters, as log(1 + occurrences); per
category the ``max_words`` that tell it best (log-likelihood ratio, in at least
``min_docs`` distinct texts) count, chosen by a Spark aggregate, so no rare word of a long
text stands in for another as in a hashed table.

Fit: a sample of at most ``max_docs`` labelled rows, those of smallest id hash
(a documented bound). Scoring covers whole texts of every row.

Null or empty text: no words, the score of the intercepts. Rows with a null
label in a category are not learned from. Without labelled rows all
probabilities are 0. Repeated rows score alike; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlens.llm.common import stage, texts_of

_WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6, 7)


def features_of(word: str) -> list[str]:
    return [word, *("^" + word[:n] for n in PREFIXES if len(word) > n)]


class _Columns(dict):
    """Word -> the columns of its features; at most ``size`` words are kept."""

    def __init__(self, vocabulary: dict[str, int], size: int = 300_000):
        self.vocabulary, self.size = vocabulary, size

    def __missing__(self, word: str) -> tuple[int, ...]:
        v = self.vocabulary
        out = tuple(v[f] for f in features_of(word) if f in v)
        if len(self) < self.size:
            self[word] = out
        return out


def counts(text: str, columns: _Columns, width: int) -> np.ndarray:
    """log(1 + occurrences) of each feature, and last the log of the length."""
    words = _WORD.findall(text.lower())
    flat = [c for cs in map(columns.__getitem__, words) if cs for c in cs]
    out = np.zeros(width + 1, np.float32)
    if flat:
        out[:width] = np.bincount(flat, minlength=width)
    out[width] = len(words)
    return np.log1p(out)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 12) -> np.ndarray:
    """Weights and, last, the intercept of a ridge logistic model (Newton)."""
    x = np.hstack((x, np.ones((len(x), 1))))
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        r = np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((x * r[:, None]).T @ x + np.diag(penalty), x.T @ (p - y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _apply(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))


def _threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The probability from which a row counts as positive: of 0.05 to 0.95 the
    one of best F1 on out-of-fold ``p`` (ties: the nearest to 0.5, then the lower)."""
    grid = np.arange(5, 100, 5) / 100
    hit = p[:, None] >= grid
    f1 = 2 * (hit & (y[:, None] == 1)).sum(0) / np.maximum(hit.sum(0) + (y == 1).sum(), 1)
    best = grid[f1 == f1.max()]
    return float(best[np.argmin(np.round(np.abs(best - 0.5), 6))])


class Chain:
    """categories, vocabulary (feature -> column), per category its columns
    and weights over [its columns, the probabilities before it] and the
    threshold of its probability."""

    def __init__(self, categories: list[str], vocabulary: dict[str, int]):
        self.categories, self.vocabulary = categories, vocabulary
        self.columns: list[np.ndarray] = []
        self.weights: list[np.ndarray] = []
        self.thresholds: list[float] = []

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), len(self.categories)))
        for k, (cols, w) in enumerate(zip(self.columns, self.weights)):
            out[:, k] = _apply(np.hstack((x[:, cols], out[:, :k])), w)
        return out


def _telling(rows: DataFrame, categories: list[str], max_words: int, min_docs: int) -> list[list[str]]:
    """Per category the features with the largest log-likelihood ratio."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, text in enumerate(texts_of(b)):
                own = sorted({f for w in set(_WORD.findall(text.lower())) for f in features_of(w)})
                yield pa.record_batch({"feature": pa.array(own, pa.string())} | {
                    c: pa.array([b.column(c)[i].as_py()] * len(own), pa.int32()) for c in categories})

    kinds = "feature string, " + ", ".join(f"`{c}` int" for c in categories)
    texts = rows.groupBy("text").agg(*[F.max(c).alias(c) for c in categories])
    size = texts.agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in categories]).first()
    per = (texts.mapInArrow(spell, kinds).groupBy("feature")
           .agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(c) for c in categories])
           .where(F.col("_n") >= min_docs).persist())
    out = []

    def part(k: Column, n: float) -> Column:
        p = F.greatest(F.lit(1e-9), F.least(F.lit(1 - 1e-9), k / n))
        return k * F.log(p) + (F.lit(n) - k) * F.log(1 - p)

    for c in categories:
        n1, n = float(size[c] or 0), float(size["n"])
        if not 0 < n1 < n:
            out.append([])
            continue
        gain = part(F.col(c), n1) + part(F.col("_n") - F.col(c), n - n1) - part(F.col("_n"), n)
        best = per.select("feature", gain.alias("gain")).orderBy(F.desc("gain"), "feature").limit(max_words)
        out.append(sorted(r["feature"] for r in best.collect()))
    per.unpersist()
    return out


def fit(docs: DataFrame, labels: DataFrame, categories: list[str], max_docs: int = 6000,
        max_words: int = 300, min_docs: int = 8, folds: int = 5) -> Chain | None:
    """``labels``: doc_id and one 0/1 column a category, without held-out rows."""
    lab = labels.where(" and ".join(f"`{c}` is not null" for c in ("doc_id", *categories)))
    lab = lab.groupBy("doc_id").agg(*[F.max(c).cast("int").alias(c) for c in categories])
    lab = lab.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    # max_docs ids at most: a bounded broadcast. Equal ids: the first text counts.
    rows = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(lab), "doc_id")
            .groupBy("doc_id", *categories).agg(F.min("text").alias("text")))
    rows = stage(rows, "toxicity-sample")
    chosen = _telling(rows, categories, max_words, min_docs)
    vocabulary = {w: i for i, w in enumerate(sorted({w for c in chosen for w in c}))}
    width = len(vocabulary)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = _Columns(vocabulary)
        for b in batches:
            texts = texts_of(b)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([zlib.crc32(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64()),
                 pa.array([counts(t, columns, width).tobytes() for t in texts], pa.binary())]
                + [b.column(c) for c in categories], names=["doc_id", "crc", "x", *categories])

    kinds = "doc_id long, crc long, x binary, " + ", ".join(f"`{c}` int" for c in categories)
    got = sorted(rows.select("doc_id", "text", *categories).mapInArrow(encode, kinds).collect(),
                 key=lambda r: r["doc_id"])
    if not got:
        return None
    fold = np.array([r["crc"] % folds for r in got])
    y = np.array([[r[c] for c in categories] for r in got], float)
    x = np.stack([np.frombuffer(r["x"], np.float32) for r in got])
    chain = Chain(categories, vocabulary)
    oof = np.zeros_like(y)
    for k, words in enumerate(chosen):
        cols = np.array([vocabulary[w] for w in words] + [width], int)
        z = np.hstack((x[:, cols], oof[:, :k]))
        for f in range(folds):
            inside = fold != f
            oof[~inside, k] = _apply(z[~inside], _logistic(z[inside], y[inside, k])) if inside.any() else y[:, k].mean()
        chain.columns.append(cols)
        chain.weights.append(_logistic(z, y[:, k]))
        chain.thresholds.append(_threshold(oof[:, k], y[:, k]))
    return chain


def score(docs: DataFrame, chain: Chain | None, categories: list[str], id_col: str = "doc_id",
          text_col: str = "text", keep: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, the columns of ``keep``, and p_<category> in chain order."""
    keep = keep or {}
    kept = tuple(keep)
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    out = [f"p_{c}" for c in categories]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = shared.value
        columns, width = (_Columns(chain.vocabulary), len(chain.vocabulary)) if chain else (None, 0)
        for b in batches:
            if chain:
                p = chain.predict(np.stack([counts(t, columns, width) for t in texts_of(b)])
                                  if b.num_rows else np.zeros((0, width + 1)))
            else:
                p = np.zeros((b.num_rows, len(categories)))
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in ("doc_id", *kept)] + [pa.array(p[:, k]) for k in range(len(out))],
                names=["doc_id", *kept, *out])

    cols = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       *[c.alias(n) for n, c in keep.items()])
    kinds = ", ".join(f"{n} {t}" for n, t in cols.drop("text").dtypes)
    return cols.mapInArrow(run, kinds + "".join(f", {n} double" for n in out))
