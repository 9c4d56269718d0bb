"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_CHARS`` characters (all of its
text). Each passage is encoded from its bytes: shares of byte-class bigrams
and a few word statistics, through a tanh layer. Gated attention,
softmax(w . (tanh(V h) * sigmoid(U h))), weighs the passages; the weighted
representation gives the document's probability of label 1. The weights of all
layers are learned from document labels only, by Adam on the log loss.

Fit: a sample of at most ``max_docs`` labelled rows, those of smallest id hash
(a documented bound), each with all of its passages; a row whose passages would
exceed ``max_passages`` in all is passed over, so long texts make the sample one
of fewer rows. Scoring covers every row.

Null or empty text: one empty passage. Rows without a label, or whose id has
no label row, are not learned from; without any usable label the score is the
constant 0.5. Repeated rows score alike. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlens.llm.common import CHUNK_BYTES, by_bytes, stage, texts_of, tidied

PASSAGE_CHARS = 1000
_CLASSES = 14
_CLASS = np.full(256, 11, np.uint8)          # other punctuation
_CLASS[ord("a"):ord("z") + 1] = 0
_CLASS[ord("A"):ord("Z") + 1] = 1
_CLASS[ord("0"):ord("9") + 1] = 2
_CLASS[32] = 3
_CLASS[10] = 4
for _k, _chars in enumerate((b"!?", b"|", b"$%&*#@+=~^", b".", b",;:", b"(){}[]<>/\\\"'`_-")):
    _CLASS[list(_chars)] = 5 + _k
_CLASS[128:192] = 12                         # inside of a multi-byte character
_CLASS[192:] = 13
N_STATS = 6
N_FEATURES = _CLASSES * _CLASSES + N_STATS


def passages(text: str) -> list[str]:
    return [text[i:i + PASSAGE_CHARS] for i in range(0, len(text), PASSAGE_CHARS)] or [""]


def features(parts: list[str]) -> np.ndarray:
    """One row a passage."""
    raw = [p.encode("utf-8", "surrogatepass") for p in parts]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    cls = _CLASS[np.frombuffer(b"".join(raw), np.uint8)].astype(np.int64)
    owner = np.repeat(np.arange(len(raw)), sizes)
    width = _CLASSES * _CLASSES
    out = np.zeros((len(raw), N_FEATURES), np.float32)
    if len(cls) > 1:
        same = owner[:-1] == owner[1:]
        key = owner[:-1] * width + cls[:-1] * _CLASSES + cls[1:]
        share = np.bincount(key[same], minlength=len(raw) * width).reshape(len(raw), width)
        out[:, :width] = np.sqrt(share / np.maximum(sizes - 1, 1)[:, None])
    for i, p in enumerate(raw):
        words, lines = p.split(), p.split(b"\n")
        n = len(words) or 1
        out[i, width:] = (len(words) > 0, len(set(words)) / n, len(set(lines)) / len(lines),
                          min(len(p) / n, 40) / 10, np.log1p(len(p)) / 7, min(len(lines), 40) / 40)
    return out


class Model:
    """Weights, the forward pass over bags, and one Adam step on a batch."""

    def __init__(self, hidden: int = 24, gate: int = 12, seed: int = 7):
        r = np.random.default_rng(seed)
        self.mean, self.scale = np.zeros(N_FEATURES), np.ones(N_FEATURES)
        self.p = {"W": r.normal(0, N_FEATURES ** -0.5, (N_FEATURES, hidden)), "b": np.zeros(hidden),
                  "V": r.normal(0, hidden ** -0.5, (hidden, gate)), "U": r.normal(0, hidden ** -0.5, (hidden, gate)),
                  "w": np.zeros(gate), "c": r.normal(0, hidden ** -0.5, hidden), "d": np.zeros(1)}
        self.m = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.v = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.steps = 0

    def forward(self, x: np.ndarray, first: np.ndarray) -> tuple:
        """x: passages of all bags, bag i from first[i] on; bags are not empty."""
        p = self.p
        n = np.diff(np.append(first, len(x)))
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ p["W"] + p["b"])
        t = np.tanh(h @ p["V"])
        g = 1 / (1 + np.exp(-np.clip(h @ p["U"], -30, 30)))
        e = (t * g) @ p["w"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, first), n))
        a = e / np.repeat(np.add.reduceat(e, first), n)
        z = np.add.reduceat(a[:, None] * h, first, axis=0)
        y = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))
        return x, n, h, t, g, a, z, y

    def step(self, x: np.ndarray, first: np.ndarray, label: np.ndarray, rate: float, decay: float) -> None:
        p = self.p
        x, n, h, t, g, a, z, y = self.forward(x, first)
        do = (y - label) / len(label)
        dz = np.repeat(do[:, None] * p["c"], n, axis=0)
        da = (dz * h).sum(1)
        de = a * (da - np.repeat(np.add.reduceat(a * da, first), n))
        dt, dg = de[:, None] * p["w"] * g * (1 - t * t), de[:, None] * p["w"] * t * g * (1 - g)
        dh = (a[:, None] * dz + dt @ p["V"].T + dg @ p["U"].T) * (1 - h * h)
        grad = {"W": x.T @ dh, "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ de,
                "c": z.T @ do, "d": do.sum(keepdims=True)}
        self.steps += 1
        for k, d in grad.items():
            d = d + decay * p[k]
            self.m[k] = 0.9 * self.m[k] + 0.1 * d
            self.v[k] = 0.999 * self.v[k] + 0.001 * d * d
            p[k] -= rate * (self.m[k] / (1 - 0.9 ** self.steps)) / (
                np.sqrt(self.v[k] / (1 - 0.999 ** self.steps)) + 1e-8)

    def score(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self.forward(x, first)[-1]


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = 4000, max_passages: int = 256_000,
        epochs: int = 25, batch: int = 64, seed: int = 7) -> Model | None:
    """``labels``: doc_id, label (0 or 1), already without held-out rows."""
    lab = labels.where("label is not null and doc_id is not null")
    # Equal ids: the one with the larger label counts, so the fit is defined.
    lab = lab.groupBy("doc_id").agg(F.max("label").cast("double").alias("label"))
    lab = lab.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    # max_docs ids at most: a bounded broadcast. Of equal ids the smallest text counts.
    rows = (docs.select("doc_id", "text").join(F.broadcast(lab), "doc_id")
            .groupBy("doc_id").agg(F.max("label").alias("label"), F.min("text").alias("text")))
    rows = stage(rows, "quality-texts")
    n = F.greatest(F.lit(1), F.ceil(F.length(F.coalesce("text", F.lit(""))) / PASSAGE_CHARS))
    left, chosen = max_passages, []
    for r in rows.select("doc_id", n.alias("n")).orderBy(F.xxhash64("doc_id"), "doc_id").collect():
        if r["n"] <= left:
            left -= r["n"]
            chosen.append((r["doc_id"],))
    chosen = docs.sparkSession.createDataFrame(chosen, f"doc_id {dict(rows.dtypes)['doc_id']}")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch({"doc_id": b.column("doc_id"), "label": b.column("label"), "bag": pa.array(
                [features(passages(t)).astype("<f4").tobytes() for t in texts_of(b)], pa.binary())})

    got = sorted(rows.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")
                 .mapInArrow(tidied(encode), "doc_id long, label double, bag binary").collect(), key=lambda r: r["doc_id"])
    if not got:
        return None
    label = np.array([r["label"] for r in got])
    bags = [np.frombuffer(r["bag"], "<f4").reshape(-1, N_FEATURES).astype(float) for r in got]
    model = Model(seed=seed)
    every = np.concatenate(bags)
    model.mean, model.scale = every.mean(0), every.std(0) + 0.02
    rng = np.random.default_rng(seed)
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for k in range(0, len(order), batch):
            part = order[k:k + batch]
            x = [bags[i] for i in part]
            first = np.cumsum([0] + [len(b) for b in x[:-1]])
            model.step(np.concatenate(x), first, label[part], 0.01 if epoch < epochs * 2 // 3 else 0.002, 1e-4)
    return model


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text",
          keep: dict[str, Column] | None = None, with_text: bool = False, run_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, the columns of ``keep``, with ``with_text`` text, and score (0 to 1)."""
    keep = keep or {}
    kept = ("doc_id", *keep, *(["text"] if with_text else []))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for rows, texts in by_bytes(batches, limit=run_bytes):
            parts, first = [], []
            for t in texts:
                first.append(len(parts))
                parts += passages(t.decode())
            s = m.score(features(parts).astype(float), np.array(first)) if m else np.full(len(texts), 0.5)
            yield pa.RecordBatch.from_arrays([rows.column(c) for c in kept] + [pa.array(s)], names=[*kept, "score"])

    cols = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       *[c.alias(n) for n, c in keep.items()])
    types = dict(cols.dtypes)
    return cols.mapInArrow(tidied(run), ", ".join(f"`{c}` {types[c]}" for c in kept) + ", score double")
