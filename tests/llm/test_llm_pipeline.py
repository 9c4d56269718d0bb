"""The pipeline's stages on a driver table, each against brute force on its
own input, and the registered queries."""

import os
import sys
from collections import Counter

import pytest

import __spark_entry__ as entry
from airlens.llm.common import read_table

sys.path.insert(0, os.path.dirname(__file__))
from test_llm_operators import brute_classes, brute_repeats  # noqa: E402

import corpus_pipeline as cp  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs = read_table(spark, SF, "documents")
    out = [docs]
    for k, (_, step) in enumerate(cp.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        step(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def as_dict(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_return_documents(steps):
    for df in steps[1:-1]:
        assert df.columns == cp.COLUMNS


def test_quality_drops_only_what_it_rejects(spark, steps):
    before, after = as_dict(steps[0]), as_dict(steps[1])
    assert all(before[i] == r for i, r in after.items())
    labels = {r.doc_id: r.quality for r in read_table(spark, SF, "labels").collect()}
    good = [i for i, q in labels.items() if q == 1 and i in before]
    assert sum(i in after for i in good) >= 0.95 * len(good)


def test_one_document_of_each_group_stays(steps):
    rows = [(r.doc_id, r.text, r.lang) for r in steps[1].collect()]
    want = {c for _, _, c in brute_classes(rows)}
    assert set(as_dict(steps[2])) == want and steps[2].count() == len(want)


def test_repeated_passages_go(steps):
    before, after = sorted(as_dict(steps[2]).items()), as_dict(steps[3])
    assert len(after) == len(before)
    for (i, r), (_, removed, _, _) in zip(before, brute_repeats([r.text.encode() for _, r in before], 200)):
        assert after[i].n_chars == len(after[i].text)
        if not removed:
            assert after[i].text == r.text
        else:
            assert len(after[i].text.encode()) in range(len(r.text.encode()) - removed - 8, len(r.text.encode()) - removed + 1)


def test_packing_keeps_every_document(steps):
    total = Counter()
    for r in steps[5].collect():
        total[r.doc_id] += r.length
    assert set(total) == set(as_dict(steps[4]))


def test_run_equals_its_stages(spark, steps):
    got = {(r.doc_id, r.start, r.length, r.ids_crc32) for r in cp.run(spark, SF).collect()}
    assert {(d, s + n) for d, s, n, _ in got} >= {(r.doc_id, r.doc_tokens) for r in steps[5].collect()}


def test_repeated_rows_and_nulls(spark):
    rows = [(1, "a b c d e f", "en", "s", 11), (1, "a b c d e f", "en", "s", 11), (2, "A b c d e f", "en", "s", 11),
            (3, None, None, None, None), (4, "", "en", "s", 0), (None, "other words of a row without id", "en", "s", 9),
            (1, "another text of the same id with words", "en", "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = Counter((r.doc_id, r.text) for r in cp.drop_near_duplicates(spark, docs, SF).collect())
    assert got == Counter([(1, rows[0][1]), (3, None), (4, ""), (None, rows[5][1]), (1, rows[6][1])])
    cut = cp.drop_repeated_passages(spark, docs, SF)
    assert Counter((r.doc_id, r.text) for r in cut.collect()) == Counter((r[0], r[1]) for r in rows)
    assert cp.drop_contaminated(spark, docs, SF).count() == len(rows)
    assert cp.drop_near_duplicates(spark, docs.limit(0), SF).count() == 0


def test_rows_without_words_stay(spark):
    blank = [(None, None, "en", "s", None), (None, None, "de", "s", None), (None, None, "en", "s", None),
             (5, "", "en", "s", 0), (5, "", "en", "t", 0), (5, " \t\x0b", "en", "t", 3), (5, " \t\x0b", None, "t", 3)]
    worded = [(6, "\x1c", "en", "s", 1), (6, "\x1c", "en", "s", 1), (7, "one two", "en", "s", 7), (7, "one two", "de", "s", 7)]
    docs = spark.createDataFrame(blank + worded, "doc_id long, text string, lang string, source string, n_chars long")
    got = Counter(map(tuple, cp.drop_near_duplicates(spark, docs, SF).collect()))
    assert all(got[r] == n for r, n in Counter(blank).items())
    assert got[worded[0]] == 1 and got[worded[2]] + got[worded[3]] == 1 and sum(got.values()) == len(blank) + 2


def test_every_operator_has_a_query():
    names = entry.queries()
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names
