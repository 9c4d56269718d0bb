"""Brown class-based n-gram language model.

Tokens: ASCII-lower-cased words between ASCII white space, then one end token
per text. Exchange clustering puts every token into one of ``classes`` classes;
a token's probability is the class transition P(c | class before) times the
emission P(w | c) = (c(w) + 0.5) / (N_c + 0.5 (V_c + 1)), where the "+ 1" is
the class's share for unseen words. Transitions are smoothed towards the class
frequencies. The base model is the unigram (c(w) + 0.5) / (N + 0.5 (V + 1)).

What is counted: all words of all training texts. Texts are packed once into
chunks (their distinct words and the token sequence as positions in them). Counts
are pre-aggregated per chunk, dealt out by word hash, and stay in a table; nothing
of the vocabulary's size is broadcast or collected.

Clustering: units give the start. Each word with a share of at least
``unit_share`` of the training tokens and 256 groups of the other words (by
length and last byte) are exchanged on their bigram table, counted over the
whole corpus on Spark. Then every word of the training texts, however rare, is
exchanged by its own contexts in Spark rounds: chunks send each word's counts of
classes before and after it to the word's bucket, the bucket adds them up, moves
the word to the class that raises the likelihood most, and answers each chunk
with the classes of its words. Words moved at once do not see each other's moves,
so a sweep over all words takes a round for each of its parts (by hash, two at
first). A round after which the recounted likelihood is not higher is undone, and
the next sweep has twice the parts. Sweeps end when one gains less than ``tolerance``
(nats) a token and every word has had its round in a sweep without a fall (or even
eighths of the words, moved at once, lower the likelihood).

Scoring: a chunk gets the counts and classes of its words from their buckets and
scores its texts whole. A word without a count has the class of its group.

Null text: only the end token. Rows are told apart by a number of their own, so
repeated or null ids are documents of their own. With a null training flag a row
is not learned from. Without training rows every token has probability 1.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlens.llm.common import by_bytes, partitions, stage
from airlens.llm.wordhash import SPACE_SEP, Words, mix

GROUPS = 256
END = np.uint64(0xE4D0_0000_0000_0000)       # the end token; its low byte is its group
FLUSH_TOKENS = 1 << 21
FLUSH_DOCS = 1 << 15
FEW = 16


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key per token, its text's number, tokens per text). A key is a 56-bit
    word hash and, as low byte, the word's group."""
    w = Words(texts, SPACE_SEP)
    group = (np.minimum(w.end - w.start, 15) // 2 << 5 | w.data[w.end - 1] & 31).astype(np.uint64)
    keys = w.hash & ~np.uint64(255) | group
    keys = np.insert(keys, w.first[1:], END)
    n = w.count + 1
    return keys, np.repeat(np.arange(len(texts)), n), n


def _buckets(spark) -> int:
    """Grows with the square root of the shuffle's partitions: a bucket's part of
    the vocabulary stays small, and so does the number of partial sums."""
    return max(8, int(8 * partitions(spark) ** 0.5))


def _dealt(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of sorted keys by bucket, the buckets there are, and their cuts."""
    b = (keys >> np.uint64(8)) % np.uint64(buckets)
    order = np.argsort(b, kind="stable")
    used, first = np.unique(b[order], return_index=True)
    return order, used.astype(np.int32), np.append(first, len(keys))


_CHUNK = "chunk long, n long, keys binary, seq binary, sizes binary, ids array<{0}>, held array<boolean>"


def chunks(docs: DataFrame, label: str) -> DataFrame:
    """Packed runs of about ``FLUSH_TOKENS`` tokens of whole texts (doc_id, text, held_out): ``keys``
    are their distinct words, frequent ones first, ``seq`` the tokens as positions in them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 33
        held: list[tuple] = []
        n_held = n_docs = 0

        def flush() -> pa.RecordBatch:
            keys, at, n = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True, return_counts=True)
            order = np.argsort(-n, kind="stable")
            rank = np.empty(len(keys), "<u4")
            rank[order] = np.arange(len(keys))
            planes = np.ascontiguousarray(rank[at].view(np.uint8).reshape(-1, 4).T)
            row = {"chunk": [chunk], "n": [len(at)], "keys": [keys[order].tobytes()],
                   "seq": [pa.compress(planes.tobytes(), codec="zstd", asbytes=True)],
                   "sizes": [np.concatenate([h[1] for h in held]).astype("<i8").tobytes()]}
            lists = {name: pa.concat_arrays([h[k] for h in held]) for k, name in ((2, "ids"), (3, "held"))}
            return pa.record_batch(row | {name: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
                                          for name, x in lists.items()})

        for batch, texts in by_bytes(batches):
            if held and (n_held >= FLUSH_TOKENS or n_docs + len(texts) > FLUSH_DOCS):
                yield flush()
                held, n_held, n_docs, chunk = [], 0, 0, chunk + 1
            keys, _, sizes = tokens(texts)
            held.append((keys, sizes, batch.column("doc_id"), batch.column("held_out")))
            n_held += len(keys)
            n_docs += len(texts)
        if held:
            yield flush()

    return stage(docs.select("doc_id", "text", "held_out").mapInArrow(run, _CHUNK.format(dict(docs.dtypes)["doc_id"])),
                 label, blobs=True)


def sequence(row: dict) -> np.ndarray:
    planes = pa.decompress(row["seq"], 4 * row["n"], codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Order of a chunk's words by bucket and hash, and (bucket, from, to) in that order."""
    order = np.argsort(keys)
    by, used, cut = _dealt(keys[order], buckets)
    cut = cut.tolist()
    return order[by], list(zip(used.tolist(), cut[:-1], cut[1:]))


def each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]


@dataclass
class Vocabulary:
    """``table`` holds (bucket, keys, counts, after ``fit`` classes) of every training token."""

    table: DataFrame
    buckets: int
    n_tokens: int
    n_types: int
    frequent: np.ndarray                     # sorted keys of the units that are words
    frequent_counts: np.ndarray


def count_words(train: DataFrame, unit_share: float) -> Vocabulary:
    """``train`` are chunks."""
    spark = train.sparkSession
    buckets = _buckets(spark)
    schema = "bucket int, keys binary, counts binary"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in each(batches):
            keys = np.frombuffer(row["keys"], np.uint64)
            n = np.bincount(sequence(row), minlength=len(keys))
            order, spans = by_bucket(keys, buckets)
            keys, n = keys[order], n[order]
            yield pa.record_batch({"bucket": pa.array([k for k, _, _ in spans], pa.int32()),
                                   "keys": pa.array([keys[a:b].tobytes() for _, a, b in spans], pa.binary()),
                                   "counts": pa.array([n[a:b].tobytes() for _, a, b in spans], pa.binary())})

    def merge(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        keys = np.frombuffer(b"".join(frame["keys"]), np.uint64)
        n = np.frombuffer(b"".join(frame["counts"]), np.int64)
        own, at = np.unique(keys, return_inverse=True)
        total = np.bincount(at, n).astype(np.int64)
        return pd.DataFrame({"bucket": [key[0]], "keys": [own.tobytes()], "counts": [total.tobytes()]})

    table = stage(train.select("n", "keys", "seq").mapInArrow(count, schema).groupBy("bucket")
                  .applyInPandas(merge, schema), "vocabulary", blobs=True)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = [np.frombuffer(x, np.int64) for x in b.column("counts").to_pylist()]
            yield pa.record_batch({"n": pa.array([int(x.sum()) for x in n], pa.int64()),
                                   "v": pa.array([len(x) for x in n], pa.int64())})

    r = table.mapInArrow(sums, "n long, v long").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    n_tokens, n_types = int(r["n"] or 0), int(r["v"] or 0)
    least = max(1, unit_share * n_tokens)

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for keys, n in zip(b.column("keys").to_pylist(), b.column("counts").to_pylist()):
                n = np.frombuffer(n, np.int64)
                keep = n >= least
                yield pa.record_batch({"key": np.frombuffer(keys, np.uint64)[keep].view(np.int64), "n": n[keep]})

    # Shares sum to 1, so there are 1 / unit_share such words at most. They only start the
    # clustering; ``exchange_words`` then moves every word.
    got = sorted((np.uint64(x["key"] & (1 << 64) - 1), x["n"])
                 for x in table.mapInArrow(often, "key long, n long").collect())
    return Vocabulary(table, buckets, n_tokens, n_types, np.array([k for k, _ in got], np.uint64),
                      np.array([n for _, n in got], np.int64))


def unit_of(keys: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit of each key (the frequent words, the groups, the end token), and
    whether it is a unit of its own."""
    at = np.searchsorted(frequent, keys)
    own = np.zeros(len(keys), bool)
    inside = at < len(frequent)
    own[inside] = frequent[at[inside]] == keys[inside]
    unit = np.where(own, at, len(frequent) + (keys & np.uint64(255)).astype(np.int64))
    unit[keys == END] = len(frequent) + GROUPS
    return unit, own


def count_bigrams(train: DataFrame, frequent: np.ndarray) -> np.ndarray:
    """Unit bigram counts of the whole training corpus, given as chunks (rows: the unit before)."""
    size = len(frequent) + GROUPS + 1
    span = 64 * size                          # cells of one partial block
    shared = train.sparkSession.sparkContext.broadcast(frequent)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        some = False
        for row in each(batches):
            unit = unit_of(np.frombuffer(row["keys"], np.uint64), shared.value)[0][sequence(row)]
            before = np.concatenate(([size - 1], unit[:-1]))     # a text follows an end
            cell, n = np.unique(before * size + unit, return_counts=True)
            total[cell] += n
            some = True
        if some:
            cells = np.flatnonzero(total)
            block = cells // span
            used, first = np.unique(block, return_index=True)
            cut = np.append(first, len(cells)).tolist()
            yield pa.record_batch({
                "block": pa.array(used, pa.int32()),
                "cells": pa.array([cells[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
                "counts": pa.array([total[cells[a:b]].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())})

    def merge(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        cells = np.frombuffer(b"".join(frame["cells"]), np.int64)
        n = np.frombuffer(b"".join(frame["counts"]), np.int64)
        total = np.bincount(cells - key[0] * span, n, span).astype(np.int64)
        kept = np.flatnonzero(total)
        return pd.DataFrame({"block": [key[0]], "cells": [(kept + key[0] * span).tobytes()],
                             "counts": [total[kept].tobytes()]})

    schema = "block int, cells binary, counts binary"
    out = np.zeros(size * size, np.int64)
    for r in train.select("n", "keys", "seq").mapInArrow(count, schema).groupBy("block").applyInPandas(merge, schema).collect():
        out[np.frombuffer(r["cells"], np.int64)] = np.frombuffer(r["counts"], np.int64)
    return out.reshape(size, size)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(bigrams: np.ndarray, classes: int, rounds: int = 8) -> np.ndarray:
    """Class of each unit by exchange: a unit leaves its class and joins the one
    that raises the class bigram likelihood most, until nothing moves. The
    last unit (the end token) keeps a class of its own, the last one."""
    size = len(bigrams)
    out = bigrams.sum(1) + bigrams.sum(0)
    order = np.argsort(-out[:-1], kind="stable")
    cls = np.zeros(size, np.int64)
    cls[order] = np.arange(size - 1) % (classes - 1)
    cls[-1] = classes - 1
    member = np.zeros((size, classes))
    member[np.arange(size), cls] = 1
    b = bigrams.astype(float)
    right, left = b @ member, (member.T @ b).T       # unit x class: after it, before it
    c = member.T @ right
    for _ in range(rounds):
        moved = 0
        for u in order.tolist():
            if not out[u]:
                continue
            own, self_ = cls[u], b[u, u]
            r, l = right[u].copy(), left[u].copy()
            r[own] -= self_
            l[own] -= self_
            # Take u out: its class loses its bigrams.
            c[own] -= r
            c[:, own] -= l
            c[own, own] -= self_
            rows, cols = c.sum(1), c.sum(0)
            fc = _xlogx(c)
            gain_r = _xlogx(c + r[None, :]) - fc
            gain_l = _xlogx(c + l[:, None]) - fc
            diag = np.diagonal(c)
            # Marginals: a class i != k only gains l[i] (r[i]), whatever k is, so
            # what differs between choices is the marginal of k itself.
            gain = (gain_r.sum(1) - np.diagonal(gain_r) + gain_l.sum(0) - np.diagonal(gain_l)
                    + _xlogx(diag + r + l + self_) - np.diagonal(fc)
                    - _xlogx(rows + l + r.sum() + self_) + _xlogx(rows + l)
                    - _xlogx(cols + r + l.sum() + self_) + _xlogx(cols + r))
            gain[-1] = -np.inf
            best = int(gain.argmax())
            if gain[best] <= gain[own] + 1e-9:
                best = int(own)
            c[best] += r
            c[:, best] += l
            c[best, best] += self_
            if best != own:
                moved += 1
                cls[u] = best
                right[:, own] -= b[:, u]
                right[:, best] += b[:, u]
                left[:, own] -= b[u]
                left[:, best] += b[u]
        if not moved:
            break
    return cls


def likelihood(c: np.ndarray) -> float:
    """Class bigram log likelihood, up to what no move changes."""
    return float(_xlogx(c).sum() - _xlogx(c.sum(0)).sum() - _xlogx(c.sum(1)).sum())


def may_move(keys: np.ndarray, part: int, parts: int) -> np.ndarray:
    """The words of a part of a sweep, by hash; the end token never moves."""
    return ((mix(keys) >> np.uint64(40)) % np.uint64(parts) == np.uint64(part)) & (keys != END)


def best_class(c: np.ndarray, own: np.ndarray, word: np.ndarray, slot: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The class that raises the likelihood most for each of the words with class ``own``, were it
    moved alone. ``word`` (ascending), ``slot``, ``n``: how often a class is before it (slot: the class) and
    after it (slot: the class + number of classes)."""
    classes = len(c)
    size = c.sum(0)
    cells = np.concatenate((c, c.T)).astype(float)        # slot x class of the word
    logs = _xlogx(cells)

    def gains(s: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per entry, what each class would gain by it, and what its class would lose without it."""
        return _xlogx(cells[s] + k) - logs[s], logs[s] - _xlogx(np.maximum(cells[s] - k, 0))

    few = np.arange(1, FEW + 1)                           # most counts are small: those from tables
    to, off = gains(np.tile(np.arange(2 * classes), FEW), np.repeat(few, 2 * classes)[:, None].astype(float))
    best = own.copy()
    cut = np.searchsorted(word, np.arange(len(own) + 1))
    at = 0
    while at < len(own):                                  # bounded slices of the words
        end = max(at + 1, int(np.searchsorted(cut, cut[at] + (1 << 15), "right")) - 1)
        s, k, w = slot[cut[at]:cut[end]], n[cut[at]:cut[end]], word[cut[at]:cut[end]] - at
        i, mine = np.arange(len(s)), own[at:end][w]
        row = (np.minimum(k, FEW) - 1) * 2 * classes + s
        gain = to[row]
        gain[i, mine] = off[row, mine]                    # the word is in its own class
        many = np.flatnonzero(k > FEW)
        if len(many):
            g, o = gains(s[many], k[many, None].astype(float))
            gain[many] = g
            gain[many, mine[many]] = o[np.arange(len(many)), mine[many]]
        has = np.flatnonzero(cut[at + 1:end + 1] > cut[at:end])
        total = np.add.reduceat(gain, cut[at:end][has] - cut[at]) if len(has) else np.zeros((0, classes))
        times, t = np.unique(np.bincount(w, np.where(s < classes, k, 0), end - at)[has], return_inverse=True)
        o, j = own[at:end][has], np.arange(len(has))
        mass = (_xlogx(size + times[:, None]) - _xlogx(size))[t]
        mass[j, o] = _xlogx(size[o]) - _xlogx(np.maximum(size[o] - times[t], 0))
        total -= 2 * mass
        total[:, -1] = -np.inf                            # the end token's own class
        to_class = total.argmax(1)
        better = total[j, to_class] > total[j, o] + 1e-6
        best[at + has[better]] = to_class[better]
        at = end
    return best


_MESSAGE = "bucket int, chunk long, keys binary, classes binary, runs binary, slots binary, n binary"
_ANSWER = "bucket int, chunk long, moved long, classes binary"


def exchange_words(train: DataFrame, voc: Vocabulary, bigrams: np.ndarray, cls: np.ndarray, classes: int,
                   tolerance: float) -> tuple[np.ndarray, DataFrame]:
    """Class bigram counts and a table (bucket, classes) in the order of the vocabulary, once every
    word of the chunks ``train`` has been exchanged by its own contexts."""
    spark = train.sparkSession
    buckets, slots = voc.buckets, 2 * classes
    small, slot_type = np.min_scalar_type(classes - 1), np.min_scalar_type(slots - 1)
    shared = spark.sparkContext.broadcast((voc.frequent, cls))
    n_parts = partitions(spark)
    kept = (train.select("chunk", "n", "keys", "seq").repartition(n_parts, "chunk").sortWithinPartitions("chunk")
            .persist(StorageLevel.DISK_ONLY))

    def classed(row: dict, order: np.ndarray, told: list[dict] | None) -> np.ndarray:
        """Class of each of a chunk's words, in their order by bucket."""
        if told is None:
            return cls_of(np.frombuffer(row["keys"], np.uint64)[order])
        return np.frombuffer(b"".join(x["classes"] for x in sorted(told, key=lambda x: x["bucket"])), small).astype(np.int64)

    def cls_of(keys: np.ndarray) -> np.ndarray:
        frequent, cls = shared.value
        return cls[unit_of(keys, frequent)[0]]

    def over(fn: Callable[[dict, list[dict] | None], pa.Table], answers: DataFrame | None, schema: str) -> DataFrame:
        """``fn`` over each chunk and what the buckets last told it."""
        if answers is None:
            return kept.mapInArrow(lambda batches: (b for r in each(batches) for b in fn(r, None).to_batches()), schema)
        told = answers.where("chunk is not null").select("chunk", "bucket", "classes")
        return kept.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(
            lambda left, right: fn(left.to_pylist()[0], right.to_pylist()), schema)

    def pairs(row: dict, told: list[dict] | None) -> pa.Table:
        order, _ = by_bucket(np.frombuffer(row["keys"], np.uint64), buckets)
        of = np.empty(len(order), np.int64)
        of[order] = classed(row, order, told)
        c = of[sequence(row)]
        cell = np.concatenate(([classes - 1], c[:-1])) * classes + c
        n = np.bincount(cell, minlength=classes * classes)
        cell = np.flatnonzero(n)
        return pa.table({"cell": pa.array(cell, pa.int64()), "n": pa.array(n[cell], pa.int64())})

    def recount(answers: DataFrame) -> np.ndarray:
        out = np.zeros(classes * classes, np.int64)
        for r in over(pairs, answers, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
            out[r["cell"]] = r["n"]
        return out.reshape(classes, classes)

    def messages(part: int, parts: int) -> Callable[[dict, list[dict] | None], pa.Table]:
        def tell(row: dict, told: list[dict] | None) -> pa.Table:
            keys = np.frombuffer(row["keys"], np.uint64)
            order, spans = by_bucket(keys, buckets)
            keys = keys[order]
            mine = classed(row, order, told)
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            word = place[sequence(row)]
            c = mine[word]
            before = np.concatenate(([classes - 1], c[:-1]))
            moves = may_move(keys, part, parts)
            a, b = moves[word], moves[word[:-1]]
            code, n = np.unique(np.concatenate((word[a] * slots + before[a], word[:-1][b] * slots + classes + c[1:][b])),
                                return_counts=True)
            runs = np.bincount(code // slots, minlength=len(keys))
            cut = np.concatenate(([0], np.cumsum(runs)))
            slot, n, runs, mine = (code % slots).astype(slot_type), n.astype("<u4"), runs.astype("<u2"), mine.astype(small)
            packed = {"keys": lambda i, j: keys[i:j], "classes": lambda i, j: mine[i:j], "runs": lambda i, j: runs[i:j],
                      "slots": lambda i, j: slot[cut[i]:cut[j]], "n": lambda i, j: n[cut[i]:cut[j]]}
            return pa.table({"bucket": pa.array([k for k, _, _ in spans], pa.int32()),
                             "chunk": pa.array([row["chunk"]] * len(spans), pa.int64())}
                            | {name: pa.array([of(i, j).tobytes() for _, i, j in spans], pa.binary())
                               for name, of in packed.items()})

        return tell

    def decide(c: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def finish(bucket: int, keys: np.ndarray, own: np.ndarray, heard: list, asked: list) -> pa.RecordBatch:
            code, n = added(heard)
            best = best_class(c, own, code // slots, code % slots, n)
            told = [best] + [best[at] for _, at in asked]
            return pa.record_batch({
                "bucket": pa.array([bucket] * len(told), pa.int32()),
                "chunk": pa.array([None] + [k for k, _ in asked], pa.int64()),
                "moved": pa.array([int((best != own).sum())] + [None] * len(asked), pa.int64()),
                "classes": pa.array([x.astype(small).tobytes() for x in told], pa.binary())})

        def added(heard: list) -> tuple[np.ndarray, np.ndarray]:
            code, at = np.unique(np.concatenate([x for x, _ in heard]), return_inverse=True)
            return code, np.bincount(at, np.concatenate([n for _, n in heard]), len(code)).astype(np.int64)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bucket = None
            keys = own = heard = asked = None
            size = settled = 0
            for r in each(batches):
                if r["chunk"] is None:                     # the vocabulary's row comes first
                    if bucket is not None:
                        yield finish(bucket, keys, own, heard, asked)
                    bucket, keys = r["bucket"], np.frombuffer(r["keys"], np.uint64)
                    own, asked = np.zeros(len(keys), np.int64), []
                    heard, size, settled = [(np.zeros(0, np.int64), np.zeros(0, np.int64))], 0, 0
                    continue
                at = np.searchsorted(keys, np.frombuffer(r["keys"], np.uint64)).astype(np.uint32)
                own[at] = np.frombuffer(r["classes"], small)
                asked.append((r["chunk"], at))
                heard.append((np.repeat(at.astype(np.int64), np.frombuffer(r["runs"], "<u2")) * slots
                              + np.frombuffer(r["slots"], slot_type), np.frombuffer(r["n"], "<u4")))
                size += len(heard[-1][0])
                if size > max(1 << 20, settled):
                    heard, size = [added(heard)], 0
                    settled = len(heard[0][0])
            if bucket is not None:
                yield finish(bucket, keys, own, heard, asked)

        return run

    none = F.lit(None).cast("binary")
    words = voc.table.select("bucket", F.lit(None).cast("long").alias("chunk"), "keys", none.alias("classes"),
                             none.alias("runs"), none.alias("slots"), none.alias("n"))
    member = np.zeros((len(bigrams), classes), np.int64)
    member[np.arange(len(bigrams)), cls] = 1
    c = member.T @ bigrams @ member
    answers, parts, high = None, 2, likelihood(c)
    more, whole = voc.n_tokens > 0, False
    while more:
        start_of_sweep, fell = high, False
        for part in range(parts):
            dealt = words.unionByName(over(messages(part, parts), answers, _MESSAGE))
            dealt = dealt.repartition(min(n_parts, buckets), "bucket").sortWithinPartitions("bucket", F.col("chunk").asc_nulls_first())
            new = stage(dealt.mapInArrow(decide(c), _ANSWER), "brown-classes", blobs=True)
            if not new.where("chunk is null").agg(F.sum("moved")).first()[0]:
                continue
            now = recount(new)
            if likelihood(now) > high:
                answers, c, high = new, now, likelihood(now)
            else:
                fell = True
        whole |= not fell
        parts *= 1 + fell
        more = high - start_of_sweep >= tolerance * voc.n_tokens or not whole and parts <= 8
    kept.unpersist()
    if answers is not None:
        return c, answers.where("chunk is null").select("bucket", "classes")

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in each(batches):
            yield pa.record_batch({"bucket": pa.array([r["bucket"]], pa.int32()), "classes": pa.array(
                [cls_of(np.frombuffer(r["keys"], np.uint64)).astype(small).tobytes()], pa.binary())})

    return c, voc.table.select("bucket", "keys").mapInArrow(start, "bucket int, classes binary")


@dataclass
class Model:
    frequent: np.ndarray
    cls: np.ndarray                          # class of each unit, for words without a count
    transition: np.ndarray                   # log10 P(c | class before)
    emission: np.ndarray                     # log10(N_c + 0.5 (V_c + 1))
    base: float                              # log10(N + 0.5 (V + 1))


def fit(train: DataFrame, classes: int = 64, unit_share: float = 5e-4, strength: float = 20.0,
        tolerance: float = 0.01) -> tuple[Model, Vocabulary]:
    rows = chunks(train.select(F.lit(None).cast("long").alias("doc_id"), "text",
                               F.lit(False).alias("held_out")), "brown-train")
    voc = count_words(rows, unit_share)
    bigrams = count_bigrams(rows, voc.frequent)
    cls = exchange(bigrams, classes)
    c, classed = exchange_words(rows, voc, bigrams, cls, classes, tolerance)
    voc = replace(voc, table=stage(voc.table.join(classed, "bucket"), "brown-vocabulary", blobs=True))
    n_class = c.sum(0)
    small = np.min_scalar_type(classes - 1)

    def types(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in each(batches):
            own, n = np.unique(np.frombuffer(r["classes"], small), return_counts=True)
            yield pa.record_batch({"class": pa.array(own, pa.int32()), "n": pa.array(n, pa.int64())})

    v_class = np.zeros(classes)
    for r in (voc.table.select("classes").mapInArrow(types, "class int, n long").groupBy("class")
              .agg(F.sum("n").alias("n")).collect()):
        v_class[r["class"]] = r["n"]
    if voc.n_tokens:
        prior = (n_class + 1) / (n_class + 1).sum()
        transition = np.log10((c + strength * prior) / (c.sum(1, keepdims=True) + strength))
        emission = np.log10(n_class + 0.5 * (v_class + 1))
    else:
        transition, emission = np.zeros((classes, classes)), np.full(classes, np.log10(0.5))
    return Model(voc.frequent, cls, transition, emission,
                 float(np.log10(voc.n_tokens + 0.5 * (voc.n_types + 1)))), voc


def score(docs: DataFrame, model: Model, voc: Vocabulary, held_out: Column, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    buckets, n_train, base = voc.buckets, voc.n_tokens, model.base
    classes = len(model.emission)
    small = np.min_scalar_type(classes - 1)
    shared = spark.sparkContext.broadcast(model)
    id_type = dict(docs.dtypes)[id_col]
    rows = chunks(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                              F.coalesce(held_out, F.lit(False)).alias("held_out")), "brown-scan")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in each(batches):
            keys = np.frombuffer(row["keys"], np.uint64)
            order, spans = by_bucket(keys, buckets)
            keys = keys[order]
            yield pa.record_batch({"bucket": pa.array([k for k, _, _ in spans], pa.int32()),
                                   "chunk": pa.array([row["chunk"]] * len(spans), pa.int64()),
                                   "keys": pa.array([keys[a:b].tobytes() for _, a, b in spans], pa.binary())})

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, known, n, of = None, np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, small)
        for r in each(batches):
            if r["chunk"] is None:
                at, known = r["bucket"], np.frombuffer(r["keys"], np.uint64)
                n, of = np.frombuffer(r["counts"], np.int64), np.frombuffer(r["classes"], small)
                continue
            keys = np.frombuffer(r["keys"], np.uint64)
            count, told = np.zeros(len(keys), np.int64), np.zeros(len(keys), small)
            if r["bucket"] == at:
                i = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                same = known[i] == keys
                count[same], told[same] = n[i[same]], of[i[same]]
            yield pa.record_batch({"chunk": pa.array([r["chunk"]], pa.int64()), "bucket": pa.array([r["bucket"]], pa.int32()),
                                   "counts": pa.array([count.tobytes()], pa.binary()),
                                   "classes": pa.array([told.tobytes()], pa.binary())})

    def texts(left: pa.Table, right: pa.Table) -> pa.Table:
        m = shared.value
        row = left.select(["n", "keys", "seq", "sizes"]).to_pylist()[0]
        told = sorted(right.to_pylist(), key=lambda x: x["bucket"])
        keys = np.frombuffer(row["keys"], np.uint64)
        order, _ = by_bucket(keys, buckets)
        count, of = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
        count[order] = np.frombuffer(b"".join(x["counts"] for x in told), np.int64)
        of[order] = np.frombuffer(b"".join(x["classes"] for x in told), small)
        new = count == 0
        of[new] = m.cls[unit_of(keys[new], m.frequent)[0]]
        at = sequence(row)
        sizes = np.frombuffer(row["sizes"], "<i8")
        doc = np.repeat(np.arange(len(sizes)), sizes)
        c = of[at]
        before = np.concatenate(([classes - 1], c[:-1]))         # a text follows an end
        seen = np.bincount(doc, np.log10(count + 0.5)[at], len(sizes))
        local = np.bincount(doc, m.transition[before, c] - m.emission[c], len(sizes))
        known = np.bincount(doc, (count > 0)[at], len(sizes)).astype(np.int64)
        return pa.table({"doc_id": left.column("ids").combine_chunks().flatten(),
                         "held_out": left.column("held").combine_chunks().flatten(), "n_tokens": sizes, "n_known": known,
                         "train_tokens": np.full(len(sizes), n_train, np.int64),
                         "base_score": seen - sizes * base, "score": seen + local})

    none = F.lit(None).cast("binary")
    asked = (rows.select("chunk", "keys").mapInArrow(ask, "bucket int, chunk long, keys binary")
             .select("bucket", "chunk", "keys", none.alias("counts"), none.alias("classes")))
    words = voc.table.select("bucket", F.lit(None).cast("long").alias("chunk"), "keys", "counts", "classes")
    dealt = (words.unionByName(asked).repartition(buckets, "bucket")
             .sortWithinPartitions("bucket", F.col("chunk").asc_nulls_first()))
    told = dealt.mapInArrow(look_up, "chunk long, bucket int, counts binary, classes binary")
    return rows.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(
        texts, f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
               "base_score double, score double")
