"""Language identification: multinomial naive Bayes over hashed character n-grams.

Letters are lower-cased, every run of other characters is one space; the 1- to
``max_n``-grams are hashed into ``buckets`` columns. Training counts all
labelled rows (partial count blocks are summed by language and block), and
only the languages x buckets log-probability matrix is broadcast. A batch of
texts is a sparse document x bucket matrix that numpy multiplies with it.

Null text, or text without a letter: ``und`` with score 0. Rows without a
label are not learned from; without any label all predictions are ``und``.
Ties go to the language first in alphabetical order. Repeated rows count again,
very long texts are read whole, an empty table gives an empty result, and other
columns are ignored. More than ``max_langs`` labels end the fit with an error: the
matrix that is broadcast has a row for each.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlens.llm.common import texts_of

BLOCK = 4096                # buckets of one partial-count row
RUN_CHARS = 1 << 19
_SPACE = 32


@functools.cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(sys.maxunicode + 1)])


def grams(texts: list[str], buckets: int, max_n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, bucket) of every n-gram of a run of texts, and which
    texts have a letter."""
    pad = " " * max_n
    joined = pad.join(t.lower() for t in texts) + pad
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter((len(t.lower()) + max_n for t in texts), np.int64, len(texts))
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    letter = _letters()[codes]
    has = np.zeros(len(texts), bool)
    has[doc[letter]] = True
    # Keep letters and the one space behind each run of them.
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    codes = np.where(letter, codes, _SPACE)[keep].astype(np.uint64)
    doc = doc[keep]
    docs, hashes = [], []
    h = np.zeros(len(codes), np.uint64)
    for n in range(1, max_n + 1):
        m = len(codes) - n + 1
        if m <= 0:
            break
        h = h[:m] * np.uint64(0x100000001B3) + codes[n - 1:n - 1 + m] + np.uint64(n)
        mixed = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
        own = doc[:m] == doc[n - 1:n - 1 + m]
        docs.append(doc[:m][own])
        hashes.append((mixed % np.uint64(buckets)).astype(np.int64)[own])
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), has
    return np.concatenate(docs), np.concatenate(hashes), has


def runs(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    start, size, run = 0, 0, []
    for i, t in enumerate(texts):
        if run and size + len(t) > RUN_CHARS:
            yield start, run
            start, size, run = i, 0, []
        run.append(t)
        size += len(t)
    if run:
        yield start, run


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", buckets: int = 1 << 15,
        max_n: int = 3, alpha: float = 0.5, max_langs: int = 512) -> tuple[list[str], np.ndarray]:
    """(languages, their log-probabilities: one row a language, the last
    column the prior) from all rows with a label."""
    blocks = -(-buckets // BLOCK)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        n_docs: dict[str, int] = {}
        for batch in batches:
            langs, texts = batch.column("lang").to_pylist(), texts_of(batch)
            for start, run in runs(texts):
                names = langs[start:start + len(run)]
                own = sorted(set(names))
                index = np.array([own.index(x) for x in names])
                doc, bucket, _ = grams(run, buckets, max_n)
                got = np.bincount(index[doc] * buckets + bucket, minlength=len(own) * buckets)
                for k, name in enumerate(own):
                    total[name] = total.get(name, 0) + got[k * buckets:(k + 1) * buckets]
                    n_docs[name] = n_docs.get(name, 0) + int((index == k).sum())
        for name, c in sorted(total.items()):
            c = np.concatenate((c, np.zeros(blocks * BLOCK - buckets, np.int64)))
            yield pa.record_batch({
                "lang": [name] * blocks, "block": pa.array(range(blocks), pa.int32()),
                "docs": pa.array([n_docs[name]] + [0] * (blocks - 1), pa.int64()),
                "counts": [c[b * BLOCK:(b + 1) * BLOCK].astype("<i8").tobytes() for b in range(blocks)]})

    def add(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        c = sum(np.frombuffer(x, "<i8") for x in frame["counts"])
        return pd.DataFrame({"lang": [key[0]], "block": [key[1]], "docs": [int(frame["docs"].sum())],
                             "counts": [c.tobytes()]})

    schema = "lang string, block int, docs long, counts binary"
    cols = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    partial = cols.where("lang is not null").mapInArrow(count, schema)
    rows = partial.groupBy("lang", "block").applyInPandas(add, schema).collect()
    langs = sorted({r["lang"] for r in rows})
    if len(langs) > max_langs:
        raise ValueError(f"{len(langs)} languages; the broadcast matrix is for {max_langs} at most")
    counts = np.zeros((len(langs), blocks * BLOCK))
    prior = np.zeros(len(langs))
    for r in rows:
        k = langs.index(r["lang"])
        counts[k, r["block"] * BLOCK:(r["block"] + 1) * BLOCK] = np.frombuffer(r["counts"], "<i8")
        prior[k] += r["docs"]
    counts = counts[:, :buckets] + alpha
    model = np.log(counts / counts.sum(1, keepdims=True)) if langs else counts
    return langs, np.hstack((model, np.log(prior / prior.sum())[:, None])) if langs else counts


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "doc_id",
            text_col: str = "text", keep: dict[str, Column] | None = None, max_n: int = 3) -> DataFrame:
    """doc_id, the columns of ``keep``, lang_pred, score (posterior of the
    predicted language)."""
    langs, matrix = model
    buckets = matrix.shape[1] - 1
    keep = keep or {}
    kept = tuple(keep)
    shared = docs.sparkSession.sparkContext.broadcast(matrix.astype(np.float64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.ascontiguousarray(shared.value[:, :-1]) if langs else None
        prior = shared.value[:, -1] if langs else None
        for batch in batches:
            texts = texts_of(batch)
            pred, score = ["und"] * len(texts), np.zeros(len(texts))
            for start, part in runs(texts):
                doc, bucket, has = grams(part, buckets, max_n)
                if not langs:
                    continue
                ll = np.stack([np.bincount(doc, row[bucket], len(part)) for row in table], 1) + prior
                best = ll.argmax(1)
                p = 1.0 / np.exp(ll - ll.max(1, keepdims=True)).sum(1)
                for i in np.flatnonzero(has).tolist():
                    pred[start + i], score[start + i] = langs[best[i]], p[i]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", *kept)] + [pa.array(pred, pa.string()), pa.array(score)],
                names=["doc_id", *kept, "lang_pred", "score"])

    cols = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       *[c.alias(n) for n, c in keep.items()])
    kinds = ", ".join(f"{n} {t}" for n, t in cols.drop("text").dtypes)
    return cols.mapInArrow(run, f"{kinds}, lang_pred string, score double")
