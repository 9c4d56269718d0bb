"""Ranked lexical search over a length-stratified index.

A term is a maximal run of bytes other than ASCII non-alphanumerics, A-Z
lower-cased. With N documents that have terms, L terms in them and n in one of
them, a document's normaliser is m = 100 - 75 + (75 n N) div L, a term's weight
w = floor(1000 ln((2 N + 2) / (2 df + 1))), its impact at tf occurrences
(10**9 tf) div (1000 tf + 8 m), and a score the sum of w * impact over the
terms of an item, repeats included.

``build_index`` never shuffles: each task packs the documents it reads into
shards of a bounded number of postings. A shard orders its documents by (m,
doc_id); documents of equal m are a stratum. Postings lie by term, stratum and
falling tf, so that in a stratum all documents of one term and tf form one
run. An impact depends on (m, tf) alone and is computed once a run, for all
items. ``search`` first sums the document frequencies of the items' terms over
the shards (only the columns of terms are read), then visits every shard: the
first run of each term in a stratum bounds what the stratum can score; strata
are visited by falling bound, in doubling steps, until the bound is below the
item's k-th score so far in the task. A task returns k documents per item at
most, and the k highest of them all are the result, so the whole of it is exact.

Items come to the driver and are broadcast in blocks of at most ``block_terms``
terms (an item of more is a block of its own); each block is a pass over the
index. Terms are told apart by 64-bit hashes.

A null text has no term; documents and items without terms have no results, nor
has a document with score 0. Rows of equal doc_id are documents of their own, rows
of equal item_id items of their own. Equal scores rank by ascending doc_id, null
first. Very long texts are tokenised whole; one of more postings than a shard's
is a shard of its own. Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from airlens.llm.common import BLOB_ROWS, by_bytes
from airlens.llm.wordhash import ALNUM_SEP, LOWER, Words
from airlens.session import scratch_dir

SHARD_POSTINGS = 1 << 20
SHARD_DOCS = 1 << 16
UNIT = 10 ** 9
INDEX_SCHEMA = ("ids array<bigint>, m binary, stratum_docs binary, terms binary, df binary, runs binary, "
                "run_stratum binary, run_tf binary, run_docs binary, postings binary")


@dataclass
class Index:
    """``table`` holds a row per shard (``INDEX_SCHEMA``, arrays as bytes)."""

    table: DataFrame
    n_docs: int
    n_terms: int


def _counts(texts: list[bytes]) -> np.ndarray:
    """Terms of each text, with repeats."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    inside = ~ALNUM_SEP[LOWER[data]]
    first = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    return np.diff(np.searchsorted(first, ends), prepend=0)


def corpus_size(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """(documents that have terms, their terms)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in by_bytes(batches):
            n = _counts(texts)
            yield pa.record_batch({"d": [int((n > 0).sum())], "t": [int(n.sum())]})

    got = docs.select(F.col(text_col).cast("binary").alias("text")).mapInArrow(run, "d long, t long")
    r = got.agg(F.sum("d").alias("d"), F.sum("t").alias("t")).first()
    return r["d"] or 0, r["t"] or 0


def term_counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, tf) of each distinct pair, by text and term; terms of each text."""
    w = Words(texts, ALNUM_SEP)
    order = np.lexsort((w.hash, w.doc))
    doc, term = w.doc[order], w.hash[order]
    first = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (term[1:] != term[:-1])))[:len(doc)])
    return doc[first], term[first], np.diff(np.append(first, len(doc))), w.count


def pack_shard(ids: pa.Array, m: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray) -> pa.RecordBatch:
    """One shard of documents (``ids``, ``m``) and their postings."""
    key = np.asarray(ids.fill_null(0), np.int64)
    order = np.lexsort((key, np.asarray(ids.is_valid()), m))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    strata, of = np.unique(m[order], return_inverse=True)
    doc = place[doc]
    at = np.lexsort((doc, -tf, of[doc], term))
    doc, term, tf = doc[at], term[at], tf[at]
    stratum = of[doc]
    new_term = np.concatenate(([True], term[1:] != term[:-1]))
    new_run = new_term | np.concatenate(([True], (stratum[1:] != stratum[:-1]) | (tf[1:] != tf[:-1])))
    terms, runs = np.flatnonzero(new_term), np.flatnonzero(new_run)
    cells = {"m": strata.astype("<i8"), "stratum_docs": np.bincount(of, minlength=len(strata)).astype("<u4"),
             "terms": term[terms].astype("<u8"), "df": np.diff(np.append(terms, len(doc))).astype("<u4"),
             "runs": np.diff(np.append(np.searchsorted(runs, terms), len(runs))).astype("<u4"),
             "run_stratum": stratum[runs].astype("<u2"), "run_tf": tf[runs].astype("<u4"),
             "run_docs": np.diff(np.append(runs, len(doc))).astype("<u4"), "postings": doc.astype("<u2")}
    return pa.record_batch({"ids": pa.array([ids.take(pa.array(order)).to_pylist()], pa.list_(pa.int64())),
                            **{k: pa.array([v.tobytes()], pa.binary()) for k, v in cells.items()}})


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shard_postings: int = SHARD_POSTINGS) -> Index:
    n_docs, n_terms = corpus_size(docs, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        docs_held = postings = 0

        def flush() -> pa.RecordBatch:
            nonlocal docs_held, postings
            ids, m, doc, term, tf = zip(*held)
            base = np.cumsum([0, *map(len, ids)])
            out = pack_shard(pa.concat_arrays(ids), np.concatenate(m), np.concatenate([d + b for d, b in zip(doc, base)]),
                             np.concatenate(term), np.concatenate(tf))
            held.clear()
            docs_held = postings = 0
            return out

        for rows, texts in by_bytes(batches):
            ids = rows.column("doc_id")
            doc, term, tf, n = term_counts(texts)
            cuts = [0, len(texts)] if len(texts) <= SHARD_DOCS else [*range(0, len(texts), SHARD_DOCS), len(texts)]
            for a, b in zip(cuts, cuts[1:]):
                has = np.flatnonzero(n[a:b] > 0) + a
                if not len(has):
                    continue
                i, j = np.searchsorted(doc, [a, b])
                if held and (docs_held + len(has) > SHARD_DOCS or postings + j - i > shard_postings):
                    yield flush()
                place = np.zeros(b - a, np.int64)
                place[has - a] = np.arange(len(has))
                held.append((ids.take(pa.array(has)), 25 + 75 * n[has] * n_docs // n_terms, place[doc[i:j] - a], term[i:j], tf[i:j]))
                docs_held, postings = docs_held + len(has), postings + j - i
        if held:
            yield flush()

    cols = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    spark = docs.sparkSession
    path = scratch_dir(spark, "search-index")
    shards = cols.mapInArrow(run, INDEX_SCHEMA)
    shards.write.options(**{**BLOB_ROWS, "compression": "zstd"}).parquet(path)
    return Index(spark.read.schema(shards.schema).parquet(path), n_docs, n_terms)


@dataclass
class Block:
    """Items of one pass: distinct ``terms``, sorted; item i has the terms at
    ``places[i]``, each ``times[i]`` times; ``rows`` and ``ids`` name the items."""

    rows: list[int]
    ids: list
    terms: np.ndarray
    places: list[np.ndarray]
    times: list[np.ndarray]


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_terms: int) -> Iterator[Block]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in by_bytes(batches):
            doc, term, tf, n = term_counts(texts)
            first = np.searchsorted(doc, np.arange(len(texts) + 1))
            yield pa.record_batch({
                "row": rows.column("row"), "id": rows.column("id"),
                "terms": [term[a:b].astype("<u8").tobytes() for a, b in zip(first, first[1:])],
                "times": [tf[a:b].astype("<u4").tobytes() for a, b in zip(first, first[1:])]})

    cols = items.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                        F.col(text_col).cast("binary").alias("text"))
    kind = cols.schema["id"].dataType.simpleString()
    held: list = []
    size = 0

    def block() -> Block:
        terms = [np.frombuffer(r["terms"], "<u8") for r in held]
        every = np.unique(np.concatenate(terms))
        return Block([r["row"] for r in held], [r["id"] for r in held], every, [np.searchsorted(every, t) for t in terms],
                     [np.frombuffer(r["times"], "<u4").astype(np.int64) for r in held])

    for r in cols.mapInArrow(run, f"row long, id {kind}, terms binary, times binary").where("length(terms) > 0").toLocalIterator():
        if held and size + len(r["terms"]) // 8 > block_terms:
            yield block()
            held, size = [], 0
        held.append(r)
        size += len(r["terms"]) // 8
    if held:
        yield block()


def document_frequencies(index: Index, terms: np.ndarray) -> np.ndarray:
    """df of each of the (sorted) terms, summed over the shards."""
    shared = index.table.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        total = np.zeros(len(asked), np.int64)
        for b in batches:
            for t, df in zip(b.column("terms").to_pylist(), b.column("df").to_pylist()):
                t, df = np.frombuffer(t, "<u8"), np.frombuffer(df, "<u4")
                at = np.minimum(np.searchsorted(t, asked), len(t) - 1)
                total += np.where(t[at] == asked, df[at], 0)
        there = np.flatnonzero(total)
        yield pa.record_batch({"place": there, "df": total[there]})

    out = np.zeros(len(terms), np.int64)
    for r in index.table.select("terms", "df").mapInArrow(run, "place long, df long").groupBy("place").agg(F.sum("df").alias("df")).collect():
        out[r["place"]] = r["df"]
    return out


class Shard:
    """A shard's arrays, and the impact of each of its runs."""

    def __init__(self, r: dict):
        m, tf = np.frombuffer(r["m"], "<i8"), np.frombuffer(r["run_tf"], "<u4").astype(np.int64)
        self.ids = r["ids"]
        self.stratum_docs = np.frombuffer(r["stratum_docs"], "<u4")
        self.terms = np.frombuffer(r["terms"], "<u8")
        self.first_run = np.concatenate(([0], np.cumsum(np.frombuffer(r["runs"], "<u4"), dtype=np.int64)))
        self.stratum = np.frombuffer(r["run_stratum"], "<u2")
        docs = np.frombuffer(r["run_docs"], "<u4")
        self.first_doc = np.concatenate(([0], np.cumsum(docs, dtype=np.int64)))
        self.postings = np.frombuffer(r["postings"], "<u2")
        self.impact = UNIT * tf // (1000 * tf + 8 * m[self.stratum])
        # The first run of a term in a stratum has its largest tf.
        self.leads = np.concatenate(([True], self.stratum[1:] != self.stratum[:-1]))
        self.leads[self.first_run[:-1]] = True

    def places(self, terms: np.ndarray) -> np.ndarray:
        """Where each term is in the shard, or -1."""
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)


def spans(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All of range(first[i], last[i]), one after the other."""
    n = last - first
    return np.repeat(first - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())


def visit(shard: Shard, at: np.ndarray, weight: np.ndarray, k: int, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(documents, scores) of strata by falling bound, in doubling steps; ``least``
    is the score that the next ones need, and is sent anew after every step."""
    first, last = shard.first_run[at], shard.first_run[at + 1]
    runs = spans(first, last)
    value = shard.impact[runs] * np.repeat(weight, last - first)
    stratum = shard.stratum[runs]
    leads = shard.leads[runs]
    bound = np.zeros(len(shard.stratum_docs), np.int64)
    np.add.at(bound, stratum[leads], value[leads])
    order = np.argsort(-bound, kind="stable")
    bound = bound[order]
    step = max(1, int(np.searchsorted(np.cumsum(shard.stratum_docs[order]), k)))
    a = 0
    while a < len(order) and bound[a] >= max(least, 1):
        b = a + int(np.searchsorted(-bound[a:a + step], -max(least, 1), side="right"))
        chosen = np.zeros(len(order), bool)
        chosen[order[a:b]] = True
        mine = chosen[stratum]
        r, v = runs[mine], value[mine]
        doc = shard.postings[spans(shard.first_doc[r], shard.first_doc[r + 1])]
        score = np.zeros(len(shard.ids), np.int64)
        np.add.at(score, doc, np.repeat(v, shard.first_doc[r + 1] - shard.first_doc[r]))
        found = np.flatnonzero(score >= max(least, 1))
        least = yield found, score[found]
        a, step = b, step * 2


def search(index: Index, items: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text",
           block_terms: int = 1 << 17) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents of highest score of each item."""
    spark = index.table.sparkSession
    kind = items.schema[id_col].dataType.simpleString()
    schema = f"row long, item_id {kind}, doc_id long, score long"
    arrow = to_arrow_type(items.schema[id_col].dataType)
    found = None
    for block in item_blocks(items, id_col, text_col, block_terms):
        df = document_frequencies(index, block.terms)
        w = np.array([int(math.floor(1000 * math.log((2 * index.n_docs + 2) / (2 * d + 1)))) for d in df.tolist()], np.int64)
        shared = spark.sparkContext.broadcast((block, w))
        part = index.table.mapInArrow(lambda batches, shared=shared: _best(batches, shared, k, arrow), schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], schema)
    by = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    rank: Column = F.row_number().over(by)
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _best(batches: Iterator[pa.RecordBatch], shared, k: int, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    block, w = shared.value
    best: list[list[tuple]] = [[] for _ in block.rows]        # (-score, id is known, id), ascending
    for b in batches:
        for r in b.to_pylist():
            shard = Shard(r)
            at = shard.places(block.terms)
            for i, (places, times) in enumerate(zip(block.places, block.times)):
                here = at[places]
                use = (here >= 0) & (w[places] > 0)
                if not use.any():
                    continue
                mine = best[i]
                steps = visit(shard, here[use], (w[places] * times)[use], k, -mine[-1][0] if len(mine) == k else 1)
                got = next(steps, None)
                while got is not None:
                    doc, score = got
                    if len(doc) > k:                       # ties of the k-th stay
                        enough = score >= np.partition(score, len(score) - k)[len(score) - k]
                        doc, score = doc[enough], score[enough]
                    for d, s in zip(doc.tolist(), score.tolist()):
                        mine.append((-s, shard.ids[d] is not None, shard.ids[d] or 0))
                    mine.sort()
                    del mine[k:]
                    try:
                        got = steps.send(-mine[-1][0] if len(mine) == k else 1)
                    except StopIteration:
                        got = None
    rows = [(block.rows[i], block.ids[i], d if known else None, -s) for i, mine in enumerate(best) for s, known, d in mine]
    if rows:
        row, item, doc, score = zip(*rows)
        yield pa.record_batch({"row": pa.array(row, pa.int64()), "item_id": pa.array(item, id_type), "doc_id": pa.array(doc, pa.int64()),
                               "score": pa.array(score, pa.int64())})
