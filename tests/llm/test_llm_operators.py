"""Operators against brute force on small tables with nulls, empty and long
texts, ties, repeated rows, and extra columns of clashing names."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from airlens.llm import (brown, decontamination, langid, multi_index, ngram_join, packing, quality,
                         suffix_dedup, tokenfile, toxicity)
from airlens.llm.components import components
from airlens.llm.tokens import Encoder, default_tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string, uid int, block int"


def table(spark, rows):
    return spark.createDataFrame(
        [(i, t, lang, "src0", len(t or ""), 1.0, "x", 7, 8) for i, t, lang in rows], SCHEMA)


def sentences(seed, n, words=("the", "sun", "rises", "over", "a", "quiet", "harbour", "while", "gulls", "cry", "and",
                              "boats", "drift", "home", "Früh", "señor")):
    rng = random.Random(seed)
    return " ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(n))


def corpus():
    base = [sentences(k, 60 + 7 * k) for k in range(8)]
    near = base[3].split()
    near[50] = "Changed"
    passage = sentences(99, 45)
    rows = [(k, t, "en" if k % 2 else "de") for k, t in enumerate(base)]
    rows += [(20, base[0], "en"), (21, base[0], "en"), (21, base[0], "en"), (22, " ".join(near), "en"),
             (23, sentences(5, 20) + " " + passage + " " + sentences(6, 30), "en"),
             (24, passage, None), (25, sentences(7, 9) + " " + passage, "de"),
             (30, None, "en"), (31, "", "en"), (32, " \t\n", "de"), (33, "one two", "en"), (34, "ONE two", "en"),
             (35, "!!! ?? 12", "de"), (None, "stray row with no id but with several words in it", "en"),
             (None, None, None), (40, sentences(11, 6000), "en"), (41, "ab" * 300, "de"), (42, "x" * 450, "de")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, corpus()).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, []).limit(0)


def rows_of(df, *cols):
    return Counter(tuple(r[c] for c in cols) for r in df.collect())


# --- tokens, files, packing ---------------------------------------------------

def test_encoder_equals_the_tokenizer():
    texts = [t or "" for _, t, _ in corpus()] + [
        "J̌ x\x1cy   <|endoftext|> it's I'LL don't ÅÄ ß 12ab 3.5 µ ª²", "İstanbul ΣΑΣ 你好 😀!!", "don’t 'S 'Tis\x85we'VE á̧"]
    e = Encoder(cache_size=50)
    want = e.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [list(e.encode(t)) for t in texts] == [w.ids for w in want]


def test_added_tokens_are_one_id(spark, scratch):
    from tokenizers import Tokenizer

    fresh = Tokenizer.from_file(default_tokenizer_path())
    marks = ["<|startoftext|>", "<|endoftext|>", "<|ENDOFTEXT|>", "<|endoftext|", "a", "'", "s", "É", "  ", "\n", "3", "你"]
    rng = random.Random(6)
    texts = ["a<|endoftext|>b", "x <|startoftext|> y"] + ["".join(rng.choices(marks, k=9)) for _ in range(300)]
    e = Encoder()
    want = [fresh.encode(t, add_special_tokens=False).ids for t in texts]
    assert [e.encode(t).tolist() for t in texts] == want
    assert want[0] == [320, 49407, 321]
    docs = table(spark, [(k, t, "en") for k, t in enumerate(texts)])
    tokenfile.write_tokens(docs, scratch)
    starts = np.cumsum([0] + [len(w) + 1 for w in want]).tolist()
    got = tokenfile.read_tokens(spark, scratch, ids=True).collect()
    assert sorted(r[1] for r in got) == starts[:-1]
    packed = {(r.doc_id, r.doc_tokens) for r in packing.pack(docs).collect()}
    assert packed == {(k, len(w) + 1) for k, w in enumerate(want)}


def test_simple8b_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 240, 4095, 4096, 4097, 20000):
        for top in (1, 2, 300, 50000, 1 << 32, 1 << 63):
            v = rng.integers(0, top, n, dtype=np.uint64)
            v[: n // 3] = 0
            words, blocks = tokenfile.encode_words(v)
            assert (tokenfile.decode_words(words, blocks.astype(np.int64), n) == v).all()


def test_token_files(spark, docs, empty, scratch):
    tokenfile.write_tokens(docs, scratch)
    got = tokenfile.read_tokens(spark, scratch, ids=True).collect()
    e = Encoder()
    want, at = [], 0
    for i, t, _ in sorted(corpus(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = list(e.encode(t)) + [1]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        at += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    tokenfile.write_tokens(empty, scratch + "-empty")
    assert tokenfile.read_tokens(spark, scratch + "-empty").count() == 0


def test_packing_covers_every_id_once_without_padding(docs, empty):
    e = Encoder()
    want = Counter()
    for i, t, _ in corpus():
        want[(i, len(e.encode(t)) + 1)] += 1
    got = packing.pack(docs, pool_tokens=9000).collect()
    seqs, cover = defaultdict(list), Counter()
    for r in got:
        assert r.length > 0
        seqs[r.sequence_id].append((r.offset, r.length))
        cover[(r.doc_id, r.doc_tokens)] += r.length
    for parts in seqs.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 4096 and (at & (at - 1)) == 0
    assert cover == Counter({k: k[1] * n for k, n in want.items()})
    assert packing.pack(empty).count() == 0


def test_pack_pool_takes_the_lowest_cost_with_room():
    pieces = packing.pack_pool([6, 5, 5, 4, 4], capacity=8)
    # 24 tokens, 3 sequences: the three dearest open one each, then the cheapest that fits, then cuts.
    assert [p[:4] for p in pieces[:3]] == [(0, 0, 6, 0), (1, 0, 5, 1), (2, 0, 5, 2)]
    filled = Counter()
    for _, _, n, s, _ in pieces:
        filled[s] += n
    assert filled == {0: 8, 1: 8, 2: 8}


# --- language model -----------------------------------------------------------

def test_brown_counts_and_scores(docs, empty):
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1
    model, voc = brown.fit(docs.where(~held), classes=8, unit_share=0.01)
    toks = {(i, t): (t or "").encode().lower().split() + [None] for i, t, _ in corpus()}
    count = Counter()
    for i, t, _ in corpus():
        if i is not None and zlib.crc32(str(i).encode()) % 5 != 1:
            count.update(toks[i, t])
    n, v = sum(count.values()), len(count)
    assert (voc.n_tokens, voc.n_types) == (n, v)
    got = brown.score(docs.where("doc_id is not null"), model, voc, held).collect()
    want = sorted((i, len(toks[i, t]), sum(count[w] > 0 for w in toks[i, t]),
                   sum(np.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in toks[i, t]))
                  for i, t, _ in corpus() if i is not None)
    got.sort(key=lambda r: (r.doc_id, r.n_tokens))
    for r, w in zip(got, want):
        assert (r.doc_id, r.n_tokens, r.n_known, r.train_tokens) == (*w[:3], n)
        assert r.base_score == pytest.approx(w[3], abs=1e-6) and r.score < 0
    # Emissions of a class and transitions out of one sum to one.
    assert np.allclose((10 ** model.transition).sum(1), 1)
    none, voc = brown.fit(empty)
    r = brown.score(docs.where("doc_id = 33"), none, voc, F.lit(True)).first()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (3, 0, 0) and abs(r.score) < 1e-9 and abs(r.base_score) < 1e-9


def test_brown_moves_every_word_by_its_contexts(spark):
    rng = random.Random(4)
    # Two kinds of rare words that alternate; length and last byte are the same for all of them.
    kinds = [[f"{k}{i:02d}z" for i in range(40)] for k in "pq"]
    alternating = [[rng.choice(kinds[i % 2]) for i in range(12)] for _ in range(300)]
    model, voc = brown.fit(table(spark, [(k, " ".join(t), "en") for k, t in enumerate(alternating)]),
                           classes=8, unit_share=0.5)
    other = [t[::2] + t[1::2] for t in alternating[:20]]       # the same words, kinds no longer alternate
    docs = table(spark, [(k, " ".join(t), "en") for k, t in enumerate(alternating[:20] + other)])
    got = {r.doc_id: r for r in brown.score(docs, model, voc, F.lit(False)).collect()}
    for k in range(20):
        assert got[k].base_score == pytest.approx(got[20 + k].base_score)
        assert got[k].score > got[20 + k].score + 1
    classes = {}
    for r in voc.table.collect():
        assert len(r.classes) == len(r["keys"]) // 8
        classes |= dict(zip(np.frombuffer(r["keys"], np.uint64).tolist(), r.classes))
    assert len(classes) == voc.n_types == 81
    of = [{classes[k] for k in brown.tokens([w.encode() for w in kind])[0][::2].tolist()} for kind in kinds]
    assert not of[0] & of[1]


def test_exchange_raises_the_class_likelihood():
    rng = np.random.default_rng(5)
    kind = np.append(rng.integers(0, 2, 29), 0)                # two hidden classes that alternate
    b = rng.poisson(np.where(kind[:, None] != kind, 20, 1)).astype(np.int64)
    got = brown.exchange(b, 3)

    def likelihood(cls):
        m = np.eye(3)[cls]
        c = m.T @ b @ m
        f = lambda x: (x * np.log(np.maximum(x, 1))).sum()     # noqa: E731
        return f(c) - f(c.sum(0)) - f(c.sum(1))

    assert likelihood(got) > likelihood(np.append(np.arange(29) % 2, 2))
    agree = (got[:-1] == kind[:-1]).mean()
    assert max(agree, 1 - agree) > 0.95


# --- classifiers --------------------------------------------------------------

def test_language_id(spark, docs, empty):
    fr = [(100 + k, sentences(k, 40, ("le", "chat", "été", "où", "garçon", "forêt")), "fr") for k in range(12)]
    en = [(200 + k, sentences(k, 40), "en") for k in range(12)]
    train = table(spark, fr[:9] + en[:9] + [(1, None, "fr"), (2, "x", None)])
    model = langid.fit(train, buckets=4096)
    got = {r.doc_id: r for r in langid.predict(table(spark, fr[9:] + en[9:] + corpus()), model).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in fr[9:] + en[9:])
    for i in (30, 31, 32):
        assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
    assert all(0 <= r.score <= 1 for r in got.values())
    assert langid.predict(docs, langid.fit(empty, buckets=4096)).where("lang_pred != 'und'").count() == 0


def test_quality_learns_and_handles_gaps(spark, docs, empty):
    good = [(k, sentences(k, 40 + 10 * k), "en") for k in range(40)]
    bad = [(100 + k, " ".join(w.upper() + "!!" for w in sentences(k, 40 + 10 * k).split()), "en") for k in range(40)]
    labels = spark.createDataFrame([(i, 1) for i, _, _ in good[:30]] + [(i, 0) for i, _, _ in bad[:30]]
                                   + [(5, None), (None, 1), (999, 0)], "doc_id long, label int")
    every = table(spark, good + bad)
    model = quality.fit(every, labels)
    got = {r.doc_id: r.score for r in quality.score(every, model).collect()}
    assert min(got[i] for i, _, _ in good[30:]) > 0.7 and max(got[i] for i, _, _ in bad[30:]) < 0.3
    assert quality.score(docs, model).where("score is null or score < 0 or score > 1").count() == 0
    assert quality.score(docs, model).count() == len(corpus())
    assert quality.score(empty, model).count() == 0
    assert {r.score for r in quality.score(docs, quality.fit(docs, labels.limit(0))).collect()} == {0.5}


def test_quality_fit_reads_every_passage(spark):
    rows = []
    for k in range(60):
        parts = [sentences(1000 * k + i, 200)[:1000] for i in range(100)]
        if k % 2:
            parts[2] = parts[2].upper().replace(" ", "!")       # one passage tells
        rows.append((k, "".join(parts), "en"))
    every = table(spark, rows)
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, label int")
    got = {r.doc_id: r.score for r in quality.score(every, quality.fit(every, labels)).collect()}
    assert all((got[k] > 0.5) == bool(k % 2) for k in range(40, 60))
    # Fewer rows, all of their passages; of equal ids the smallest text.
    few = quality.fit(table(spark, rows + [(1, rows[1][1] + "z", "en")]), labels, max_passages=350)
    order = [r.doc_id for r in labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(3).collect()]
    want = np.concatenate([quality.features(quality.passages(rows[k][1])) for k in order])
    assert np.allclose(few.mean, want.mean(0), atol=1e-5)


def test_toxicity_chain(spark, docs):
    rng = random.Random(2)
    rows, lab = [], []
    for k in range(300):
        a, b = rng.random() < 0.3, rng.random() < 0.3
        t = sentences(k, 40).split()
        if a:
            t.insert(5, "rudeword")
        if a and b:
            t.insert(9, "vileword")
        rows.append((k, " ".join(t), "en"))
        lab.append((k, int(a), int(a and b)))
    labels = spark.createDataFrame(lab[:200] + [(None, 1, 1), (250, None, 1)], "doc_id long, rude int, vile int")
    every = table(spark, rows)
    chain = toxicity.fit(every, labels, ["rude", "vile"])
    got = {r.doc_id: r for r in toxicity.score(every, chain, ["rude", "vile"]).collect()}
    for i, a, b in lab[200:]:
        assert (got[i].p_rude > 0.5) == bool(a) and (got[i].p_vile > 0.5) == bool(b)
    assert len(chain.thresholds) == 2
    assert toxicity.score(docs, chain, ["rude", "vile"]).count() == len(corpus())
    none = toxicity.fit(every, labels.limit(0), ["rude", "vile"])
    assert {r.p_vile for r in toxicity.score(docs, none, ["rude", "vile"]).collect()} == {0.0}


def test_toxicity_threshold_of_best_f1():
    p, y = np.array([0.02, 0.11, 0.32, 0.34, 0.9]), np.array([0, 0, 1, 1, 1])
    assert toxicity._threshold(p, y) == 0.3          # 0.15 to 0.3 are perfect: the nearest to 0.5
    assert toxicity._threshold(p, np.zeros(5)) == 0.5
    assert toxicity._threshold(np.full(4, 0.7), np.ones(4)) == 0.5


# --- duplicates ---------------------------------------------------------------

def brute_repeats(texts, length):
    seen = Counter()
    for b in texts:
        for i in range(len(b) - length + 1):
            seen[b[i:i + length]] += 1
    out = []
    for b in texts:
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        left = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not p for g, p in zip(gone, [False] + gone))
        out.append((len(b), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return out


@pytest.mark.parametrize("length,hot", [(200, 512), (200, 1), (40, 512), (40, 2)])
def test_repeats(docs, empty, length, hot):
    rows = corpus()
    want = Counter((i, *x) for (i, _, _), x in
                   zip(rows, brute_repeats([(t or "").encode() for _, t, _ in rows], length)))
    got = suffix_dedup.remove_repeats(docs, length=length, hot=hot)
    assert rows_of(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want
    assert suffix_dedup.remove_repeats(empty).count() == 0


def sets_of(rows, n=5):
    out = []
    for _, t, _ in rows:
        w = (t or "").encode().lower().split()
        out.append({tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    return out


def brute_classes(rows):
    sets, parent = sets_of(rows), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return Counter((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _, _) in enumerate(rows))


@pytest.mark.parametrize("piece", [256, 3])
def test_near_duplicate_classes(spark, docs, empty, piece):
    got = ngram_join.classes(docs, piece=piece)
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == brute_classes(corpus())
    # A family of edits: chains of links, cut into many pieces.
    rng = random.Random(4)
    words = sentences(1, 120).split()
    rows = []
    for k in range(40):
        words = list(words)
        for _ in range(3):
            words[rng.randrange(len(words))] = f"edit{rng.random()}"
        rows.append((k * 3 + 1, " ".join(words[: 120 - k % 7]), "en"))
    rng.shuffle(rows)
    got = ngram_join.classes(table(spark, rows).repartition(4), piece=piece)
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == brute_classes(rows)
    assert ngram_join.classes(empty).count() == 0


def test_trie_prunes_nothing_it_needs():
    rng = random.Random(8)
    for _ in range(30):
        pool = range(rng.randrange(8, 40))
        rows = []
        for c in range(25):
            t = sorted(rng.sample(pool, rng.randrange(3, len(pool) + 1) if len(pool) > 3 else 3))
            rows.append({"cid": c, "n": len(t) + rng.randrange(2), "tokens": np.array(t, np.uint64).tobytes(), "set": set(t)})
        parent = list(range(25))

        def find(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for i in range(25):
            for j in range(i):
                if 175 * len(rows[i]["set"] & rows[j]["set"]) >= 75 * (rows[i]["n"] + rows[j]["n"]):
                    parent[find(i)] = find(j)
        want = {frozenset(x for x in range(25) if find(x) == r) for r in {find(x) for x in range(25)}}
        p2 = list(range(25))
        for a, b in ngram_join.join_piece(rows, 75):
            p2[find(a, p2)] = find(b, p2)
        assert {frozenset(x for x in range(25) if find(x, p2) == r) for r in {find(x, p2) for x in range(25)}} == want


@pytest.mark.parametrize("small", [0, 1000])
def test_components(spark, small):
    rng = random.Random(small)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + k, 101 + k) for k in range(9)]
    links += [(200, 200 + k) for k in range(1, 30)] + [(None, 5), (7, None)]
    got = {r.node: r.component for r in components(
        spark.createDataFrame(links, "a long, b long").repartition(5), small=small).collect()}
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    assert got == {x: find(x) for x in parent}


def test_embeddings(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 16))
    vecs = [list(map(float, v)) for v in base]
    vecs += [list(map(float, v + rng.normal(size=16) * 0.04)) for v in base[:20] for _ in range(3)]
    vecs += [vecs[0]] * 5 + [[x * 3 for x in vecs[1]]]
    odd = [None, [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [1.0] * 7, []]
    rows = [(k, v) for k, v in enumerate(vecs + odd)] + [(500, [None] + [1.0] * 15), (3, vecs[3])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, n_links int, cell int")
    got = multi_index.near_duplicates(df.repartition(3), per_cell=4, block=16)
    good = [(i, v) for i, v in rows if v is not None and len(v) == 16 and None not in v
            and np.isfinite(v).all() and any(v)]
    x = np.array([v for _, v in good])
    x /= np.sqrt((x * x).sum(1))[:, None]
    near = (x @ x.T >= 0.95 - 1e-12) & ~np.eye(len(x), dtype=bool)
    label = np.arange(len(x))
    for _ in range(len(x)):
        label = np.array([min(label[i], *label[near[i]]) if near[i].any() else label[i] for i in range(len(x))])
    ids = [i for i, _ in good]
    least = {}
    for k, r in enumerate(label):
        least[r] = min(ids[k], least.get(r, ids[k]))
    want = Counter((ids[k], int(near[k].sum()), least[label[k]]) for k in range(len(x)))
    bad = Counter((i, 0, i) for i, v in rows) - Counter((i, 0, i) for i in ids)
    have = rows_of(got, "vec_id", "n_links", "component_id")
    found, true = sum(n * c for (_, n, _), c in have.items()), int(near.sum())
    assert found <= true and found >= 0.9 * true
    assert sum((have & (want + bad)).values()) >= 0.9 * len(rows)
    assert multi_index.near_duplicates(df.limit(0)).count() == 0


def test_embeddings_beside_a_large_group(spark):
    """A group of near copies has nearly all pairs; the others' links lie near the threshold."""
    rng = np.random.default_rng(5)

    def unit(x):
        return x / np.sqrt((x * x).sum(1, keepdims=True))

    base = unit(rng.normal(size=(250, 32)))
    side = [rng.normal(size=base.shape) for _ in range(3)]
    side = [unit(s - (s * base).sum(1, keepdims=True) * base) for s in side]
    others = np.concatenate([base] + [0.953 * base + (1 - 0.953 ** 2) ** 0.5 * s for s in side])
    hot = unit(unit(rng.normal(size=(1, 32))) + rng.normal(size=(500, 32)) * 0.001)
    x = np.concatenate([others, hot])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in multi_index.near_duplicates(df.repartition(3), block=64).collect()}
    want = (unit(x) @ unit(x).T >= 0.95).sum(1) - 1
    assert all(got[i] <= want[i] for i in got)
    share = np.array([got[i] / want[i] for i in range(len(x)) if want[i]])
    assert share[len(others):].mean() == 1 and share[:len(others)].mean() >= 0.99


def test_visits_reach_the_target():
    assert multi_index.visits_for(0.995, [0, 7, 9], [990, 5, 5]) == 8
    assert multi_index.visits_for(0.995, [0, 7, 9], [1, 1, 1]) == 10
    assert multi_index.visits_for(0.995, [], []) == 1


# --- benchmark ----------------------------------------------------------------

def test_benchmark_hits(spark, docs, empty):
    passage = sentences(99, 45)
    items = [("a", passage), ("b", " ".join(passage.split()[10:24])), ("c", "one two"), ("d", ""), ("e", None),
             (None, passage), ("f", "nowhere to be found in any of the documents of this table at all"), ("b2", "ONE,two!"),
             ("a", passage)]
    bench = spark.createDataFrame(items, "item_id string, text string")
    word = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    wins = defaultdict(set)
    for i, t in items:
        w = word.findall((t or "").encode().lower())
        if i is not None and w:
            for k in range(len(w) - min(10, len(w)) + 1):
                wins[tuple(w[k:k + 10])].add(i)
    want = Counter()
    for i, t, _ in corpus():
        w = word.findall((t or "").encode().lower())
        hit, got = set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in wins:
                    hit |= set(range(k, k + n))
                    got |= wins[tuple(w[k:k + n])]
        want[(i, len(w), len(hit), tuple(sorted(got)))] += 1
    out = decontamination.hits(docs, bench).withColumn("items", F.col("items"))
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in out.collect()) == want
    assert sum(n for (_, _, h, _), n in want.items() if h) >= 5
    assert decontamination.hits(docs, bench.limit(0)).where("n_hit > 0").count() == 0
    assert decontamination.hits(empty, bench).count() == 0


@pytest.mark.parametrize("w", [1, 2, 5, 6, 169])
def test_window_minima_are_shared(w):
    rng = np.random.default_rng(w)
    h = rng.integers(0, 9, 400).astype(np.uint64)
    want = [max(range(i, i + w), key=lambda k: (-int(h[k]), k)) for i in range(400 - w + 1)]
    assert decontamination.window_minima_at(h, w).tolist() == want


def test_marks_and_private_characters_are_no_letters(spark, docs):
    flag = chr(0x1F3F4) + "".join(chr(0xE0000 + ord(c)) for c in "gbsct") + chr(0xE007F)
    rows = [(1, flag, None), (2, chr(0xF0000) * 9, None), (3, chr(0x10FFFF), None), (4, chr(0x31350) * 3, None)]
    model = langid.fit(docs, buckets=4096)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(table(spark, rows), model).collect()}
    assert [got[i] for i in (1, 2, 3)] == [("und", 0.0)] * 3
    assert (got[4][0] != "und") == chr(0x31350).isalpha()


def test_languages_of_an_empty_table_and_too_many_labels(docs, empty):
    model = langid.fit(docs, buckets=4096)
    assert langid.predict(empty, model).collect() == []
    with pytest.raises(ValueError, match="languages"):
        langid.fit(docs, buckets=4096, max_langs=1)


def test_vectors_of_every_length_are_compared(spark):
    rng = np.random.default_rng(3)
    rows = []
    for dim in (8, 12):
        base = rng.normal(size=(300, dim))
        for v in np.concatenate((base, base[:150] * 2.0, base[:40] + rng.normal(size=(40, dim)) * 0.01)):
            rows.append((len(rows), v.tolist()))
    rows += [(len(rows), [1.0, 2.0, 3.0]), (len(rows) + 1, None), (len(rows) + 2, [0.0] * 8), (len(rows) + 3, [])]
    got = {r.vec_id: r for r in multi_index.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert len(got) == len(rows)
    links, true = 0, 0
    for dim in (8, 12):
        own = [(i, np.array(v)) for i, v in rows if v and len(v) == dim and any(v)]
        x = np.array([v / np.linalg.norm(v) for _, v in own])
        n = (x @ x.T >= 0.95).sum(1) - 1
        true += int(n.sum())
        links += sum(got[i].n_links for i, _ in own)
        assert all(got[i].n_links <= m for (i, _), m in zip(own, n.tolist()))
    assert links >= 0.98 * true > 0
    for i in range(len(rows) - 4, len(rows)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)


def test_a_document_without_an_id_is_not_held_out(spark):
    from airlens.llm.queries import held_out

    df = spark.createDataFrame([(None,), (1,), (2,)], "doc_id long")
    got = [r[0] for r in df.select(held_out(4, zlib.crc32(b"1") % 4)).collect()]
    assert got[0] is False and got[1] is True


def test_pieces_hold_the_ids_of_their_documents(docs):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(default_tokenizer_path())
    seen = Counter(i for i, _, _ in corpus())
    ids = {i: np.array(whole.encode(t or "", add_special_tokens=False).ids + [2], "<u4") for i, t, _ in corpus() if seen[i] == 1}
    pieces = defaultdict(list)
    for r in packing.pack(docs, capacity=256, pool_tokens=5000).collect():
        pieces[r.doc_id].append(r)
    for i, own in ids.items():
        rows = sorted(pieces[i], key=lambda r: r.start)
        assert [r.start for r in rows] == np.cumsum([0, *(r.length for r in rows[:-1])]).tolist()
        assert rows[-1].start + rows[-1].length == len(own)
        for r in rows:
            assert r.doc_tokens == len(own)
            assert r.ids_crc32 == zlib.crc32(own[r.start:r.start + r.length].tobytes())


def test_quality_scores_are_the_attention_weighted_passages():
    m = quality.Model(seed=4)
    rng = np.random.default_rng(2)
    m.mean, m.scale = rng.normal(size=quality.N_FEATURES), rng.uniform(0.5, 2, quality.N_FEATURES)
    m.p["w"], m.p["d"] = rng.normal(size=12), np.array([0.3])
    bags = [rng.normal(size=(n, quality.N_FEATURES)) for n in (1, 4, 2)]
    got = m.score(np.concatenate(bags), np.array([0, 1, 5]))
    for bag, score in zip(bags, got):
        h = [np.tanh((x - m.mean) / m.scale @ m.p["W"] + m.p["b"]) for x in bag]
        e = np.exp([np.tanh(v @ m.p["V"]) / (1 + np.exp(-(v @ m.p["U"]))) @ m.p["w"] for v in h])
        z = sum(a * v for a, v in zip(e / e.sum(), h))
        assert score == pytest.approx(1 / (1 + np.exp(-(z @ m.p["c"] + m.p["d"][0]))), abs=1e-12)
