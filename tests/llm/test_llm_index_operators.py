"""Digest index, ranked search and spelling variants against brute force, on
tables with nulls, empty and long texts, ties, repeated rows and columns of
clashing names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from airlens.llm import exact_dedup, ranked_search, spelling
from airlens.llm.exact_dedup import PerfectHash

SCHEMA = ("doc_id long, text string, lang string, n long, row long, digest string, member string, n_chars long, bucket int, "
          "word string, form string, score long, rank int, item_id long")


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", 1, 2, "d", "m", 3, 4, "w", "f", 5, 6, 7) for i, t in rows], SCHEMA)


LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(seed, n, words=None):
    rng = random.Random(seed)
    words = words or ["harbour", "Harbor", "quiet", "gulls", "señor", "Früh", "x9", "drifting", "drifter", "co-op", "naïve"]
    return " ".join(rng.choice(words) + rng.choice(["", "", ".", "1", "é"]) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rows = [(k, prose(k % 23, 20 + 9 * (k % 23))) for k in range(60)]
    rows += [(70, None), (71, ""), (71, ""), (72, " \n\t"), (None, "no id, harbour"), (None, "no id, harbour"), (None, None),
             (73, prose(3, 20 + 27)), (73, prose(3, 20 + 27)), (74, prose(5, 9000)), (75, "z" * 50_000), (76, "!!! -- ??"), (-5, "harbour")]
    return rows


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return table(spark, corpus).repartition(5).cache()


# --- digests ----------------------------------------------------------------

@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000])
def test_perfect_hash_is_minimal_and_perfect(n):
    rng = np.random.default_rng(n)
    a, b = rng.integers(0, 1 << 63, n, dtype=np.uint64), rng.integers(0, 1 << 63, n, dtype=np.uint64)
    a[:n // 2] = 7                                       # told apart by the second word alone
    mph = PerfectHash.build(a, b)
    assert sorted(mph.slots(a, b).tolist()) == list(range(n))
    assert mph.slots(a + np.uint64(1), b).max(initial=-1) < n
    assert len(mph.bits) * 64 <= max(64 * 12, 6 * n)


def test_perfect_hash_refuses_equal_keys():
    with pytest.raises(ValueError):
        PerfectHash.build(np.array([1, 1], np.uint64), np.array([2, 2], np.uint64))


def brute_groups(corpus):
    groups = defaultdict(list)
    for i, t in corpus:
        groups[t or ""].append(i)
    return groups


@pytest.mark.parametrize("history", ["true", "false", "cast(null as boolean)", "doc_id % 2 = 0", "doc_id > 40", "doc_id < 20"])
def test_exact_groups(docs, corpus, history, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BUCKET_DIGESTS", 8)
    got = exact_dedup.deduplicate(docs, F.expr(history)).collect()
    groups = brute_groups(corpus)
    best = {hashlib.sha256(t.encode()).hexdigest(): (max((i for i in ids if i is not None), default=None), len(ids)) for t, ids in groups.items()}
    assert Counter((r.doc_id, r.text_sha256) for r in got) == Counter((i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in corpus)
    assert all((r.keep_id, r.group_size) == best[r.text_sha256] for r in got)
    kept = [r for r in got if r.kept]
    assert Counter(r.text_sha256 for r in kept) == Counter(dict.fromkeys(best, 1))
    assert all(r.doc_id == r.keep_id for r in kept)


def test_history_repeats(docs, corpus):
    got = exact_dedup.deduplicate(docs, F.col("doc_id") % 2 == 0).collect()
    earlier = {t or "" for i, t in corpus if i is not None and i % 2 == 0}
    want = Counter(hashlib.sha256((t or "").encode()).hexdigest() for i, t in corpus if (i is None or i % 2) and (t or "") in earlier)
    assert Counter(r.text_sha256 for r in got if r.repeats_history) == want


def test_lookup_reads_the_index_alone(docs):
    rows = exact_dedup.digests(docs)
    every = exact_dedup.winners(rows)
    index = exact_dedup.build_index(every.where("n > 1"), buckets=3)
    got = {bytes(r.digest): r for r in exact_dedup.lookup(index, every).collect()}
    for r in every.collect():
        found = got[bytes(r.digest)]
        assert found.member == (r.n > 1)
        assert found.n == (2 * r.n if r.n > 1 else 1)


def test_normalised_texts(spark):
    d = table(spark, [(1, "One  two"), (2, "one two"), (3, "three")])
    got = exact_dedup.deduplicate(d, F.lit(False), normalise=lambda c: F.lower(F.regexp_replace(c, r"\s+", " "))).collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in got} == {(1, 2, False), (2, 2, True), (3, 3, True)}


def test_digests_of_an_empty_table(docs):
    assert exact_dedup.deduplicate(docs.limit(0), F.lit(True)).collect() == []


# --- ranked search ------------------------------------------------------------

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(LOW))


def brute_search(corpus, items, k):
    all_terms = [(i, Counter(terms(t))) for i, t in corpus if terms(t)]
    n_docs, total = len(all_terms), sum(sum(c.values()) for _, c in all_terms)
    df = Counter(t for _, c in all_terms for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in all_terms:
            m = 25 + (75 * sum(c.values()) * n_docs) // total
            s = sum(int(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in terms(text) if c[t])
            if s > 0:
                scored.append((-s, i is not None, i or 0))
        out += [(item, r, i if known else None, -s) for r, (s, known, i) in enumerate(sorted(scored)[:k], 1)]
    return Counter(out)


ITEMS = [(1, "Harbour gulls, x9!"), (2, "drifter drifter naïve1 nowhere"), (3, None), (4, "..."), (5, "absent"), (6, "HARBOUR"), (6, "quiet señoré"),
         (None, "id id no"), (7, prose(9, 400))]


@pytest.mark.parametrize("postings, block, k", [(1 << 20, 1 << 17, 10), (40, 1, 3), (300, 8, 1), (1, 50, 100)])
def test_ranks_equal_brute_force(spark, docs, corpus, postings, block, k):
    index = ranked_search.build_index(docs, shard_postings=postings)
    got = ranked_search.search(index, table(spark, [(i, t) for i, t in ITEMS]).drop("item_id").withColumnRenamed("doc_id", "item_id"),
                               k=k, block_terms=block)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, got.collect())) == brute_search(corpus, ITEMS, k)


def test_strata_are_ordered_and_bounded(docs):
    index = ranked_search.build_index(docs)
    seen = 0
    for r in index.table.collect():
        shard = ranked_search.Shard(r.asDict())
        m = np.frombuffer(r["m"], "<i8")
        assert (np.diff(m) > 0).all() and shard.stratum_docs.sum() == len(r["ids"])
        # In a stratum a term's first run bounds the others.
        for a, b in zip(shard.first_run, shard.first_run[1:]):
            s = shard.stratum[a:b]
            assert (np.diff(s.astype(int)) >= 0).all()
            for u in np.unique(s):
                own = shard.impact[a:b][s == u]
                assert (np.diff(own) <= 0).all()
        seen += len(r["ids"])
    assert seen == index.n_docs


def test_visits_end_below_the_bound():
    ids = [*range(40)]
    import pyarrow as pa
    # Document 0 of the shortest stratum has the term most often; all others once, ever longer.
    shard = ranked_search.Shard(ranked_search.pack_shard(
        pa.array(ids, pa.int64()), np.arange(40) * 50 + 25, np.arange(40), np.full(40, 9, np.uint64), np.array([9] + [1] * 39)).to_pylist()[0])
    visited = []
    steps = ranked_search.visit(shard, shard.places(np.array([9], np.uint64)), np.array([1000]), 1, 1)
    found = next(steps)
    try:
        while True:
            visited += found[0].tolist()
            found = steps.send(int(found[1].max()))
    except StopIteration:
        pass
    assert visited == [0]


def test_search_of_empty_tables(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    none = ranked_search.build_index(docs.limit(0))
    assert (none.n_docs, none.n_terms) == (0, 0)
    assert ranked_search.search(none, items).collect() == []
    got = ranked_search.search(ranked_search.build_index(docs), items.limit(0))
    assert got.collect() == [] and got.columns == ["item_id", "rank", "doc_id", "score"]


# --- spelling variants ----------------------------------------------------------

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def brute_words(corpus, min_length, min_count, damage):
    c = Counter()
    for i, t in corpus:
        for run in RUN.findall(t or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{i}:{run}".encode())
            if damage and i is not None and h % damage == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            c[run] += 1
    return {w: n for w, n in c.items() if len(w) >= min_length and n >= min_count}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_variants(words, ratio):
    near = {a: [b for b in words if a != b and abs(len(a) - len(b)) < 2 and one_edit(a, b)] for a in words}
    form = {}
    for a, others in near.items():
        best = min(others, key=lambda b: (-words[b], b), default=None)
        form[a] = best if best is not None and words[best] >= ratio * words[a] else None

    def root(a):
        while form[a] is not None:
            a = form[a]
        return a

    return {(a, form[a], root(a), n, len(near[a]), words[form[a]] if form[a] else None) for a, n in words.items()}


@pytest.mark.parametrize("damage", [0, 3, 7])
def test_word_counts(docs, corpus, damage, monkeypatch):
    monkeypatch.setattr(spelling, "RUN_BYTES", 700)
    got = spelling.count_words(docs, min_length=5, min_count=2, damage=damage)
    assert {r.word: r.n for r in got.collect()} == brute_words(corpus, 5, 2, damage)


def test_crcs_of_spans():
    data = np.frombuffer(b"".join(bytes([97 + i % 26]) * (i % 90) for i in range(200)), np.uint8)
    cuts = np.sort(np.random.default_rng(1).integers(0, len(data), 60))
    start, end = cuts[:-1], cuts[1:]
    before = np.array([zlib.crc32(b"%d:" % i) for i in range(len(start))], np.uint32)
    got = spelling.span_crcs(data, start, end, before)
    assert got.tolist() == [zlib.crc32(b"%d:" % i + data[a:b].tobytes()) for i, (a, b) in enumerate(zip(start, end))]


def vocabulary(seed, n, alphabet="abcdeé÷ÿ"):
    rng = random.Random(seed)
    words = set()
    while len(words) < n:
        w = "".join(rng.choice(alphabet) for _ in range(rng.randint(6, 9)))
        words.add(w)
        for _ in range(rng.randint(0, 3)):               # chains of edits
            k = rng.randrange(len(w))
            w = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice(alphabet) + w[k + 1:], w[:k] + rng.choice(alphabet) + w[k:]])
            if len(w) >= 6:
                words.add(w)
    words |= {"a" * 300, "a" * 301, "a" * 150 + "b" + "a" * 149}
    return {w: 5 * rng.choice([1, 1, 2, 5, 25, 125, 626]) for w in words}


@pytest.mark.parametrize("cell, leaf, block", [(1 << 13, 128, 4096), (16, 4, 10), (60, 1, 3)])
def test_variants_equal_brute_force(spark, cell, leaf, block, monkeypatch):
    monkeypatch.setattr(spelling, "LEAF_WORDS", leaf)
    monkeypatch.setattr(spelling, "QUERY_BLOCK", block)
    words = vocabulary(cell, 500)
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    got = spelling.variants(df, ratio=5, cell=cell)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in got.collect()} == brute_variants(words, 5)


def test_planes_of_a_sample_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(spelling, "SAMPLE_WORDS", 20)
    words = vocabulary(4, 400, "abc")
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert {tuple(r) for r in spelling.variants(df, cell=10).collect()} == brute_variants(words, 5)


def test_a_chain_of_forms(spark):
    words = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "aabbbb": 3125, "abbbbb": 15625, "zzzzzzz": 9}
    got = {r.word: (r.form, r.root) for r in spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    assert got["aaaaaa"] == ("aaaaab", "abbbbb") and got["zzzzzzz"] == (None, "zzzzzzz")


def test_words_of_an_empty_table(docs):
    words = spelling.count_words(docs.limit(0))
    assert words.collect() == [] and spelling.variants(words).collect() == []


def test_registered_spelling_parameters(spark, corpus, docs):
    words = brute_words(corpus, 6, 5, 199)
    got = spelling.variants(spelling.count_words(docs, min_length=6, min_count=5, damage=199), ratio=5)
    assert {tuple(r) for r in got.collect()} == brute_variants(words, 5)
