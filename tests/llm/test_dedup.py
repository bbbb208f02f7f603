"""Dedup operators against plain models on messy texts."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import jaccard, repeats, suffix_tree
from strata.llm.jaccard import OccurrenceIndex, link_sets, one_of_each, similar_components
from strata.llm.lines import dedup_lines, drop_shared_lines
from strata.llm.suffix_array import remove_repeats, suffix_array
from strata.llm.suffix_tree import remove_later_repeats
from tests.llm import brute


def result(df, *columns):
    return sorted((tuple(r[c] if not isinstance(r[c], bytearray) else bytes(r[c]) for c in columns) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(11)
    out = brute.messy(rnd)
    return out + [(None, out[3][1]), (out[5][0], out[5][1])]      # a row without an id, a row that repeats


def test_suffix_array_orders_all_suffixes():
    rnd = random.Random(3)
    for _ in range(400):
        s = [rnd.randint(1, rnd.choice([1, 2, 3, 9])) for _ in range(rnd.randint(0, 40))] + [0]
        assert suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def test_repeats_of_bytes(spark, rows):
    got = result(remove_repeats(brute.frame(spark, rows)), "doc_id", "n_bytes", "n_removed", "kept")
    want = brute.without_repeats(rows, 400)
    assert got == want and sum(r[2] > 0 for r in want) > 10


def test_repeats_split_anchors_are_the_same(spark, rows):
    got = result(remove_repeats(brute.frame(spark, rows), size=60, gram=16, group_bytes=100), "doc_id", "n_bytes", "n_removed", "kept")
    assert got == brute.without_repeats(rows, 60)


def test_later_repeats_of_words(spark, rows):
    distinct = rows[:-1]                                          # rows equal in id and text count as one document
    got = result(remove_later_repeats(brute.frame(spark, distinct)), "doc_id", "n_words", "n_removed", "kept")
    want = brute.without_later(distinct, 20)
    assert got == want and sum(r[2] > 0 for r in want) > 10
    again = result(remove_later_repeats(brute.frame(spark, rows)), "doc_id", "n_words", "n_removed", "kept")
    assert set(again) == set(got) and len(again) == len(got) + 1


def test_later_repeats_split_anchors_and_long_prefixes(spark, rows, monkeypatch):
    distinct = rows[:-1]
    got = result(remove_later_repeats(brute.frame(spark, distinct), size=6, gram=2, group_bytes=50), "doc_id", "n_words", "n_removed", "kept")
    assert got == brute.without_later(distinct, 6)
    group_sizes = suffix_tree.prefix_groups.__defaults__
    monkeypatch.setattr(suffix_tree.prefix_groups, "__defaults__", (2,))
    got = result(remove_later_repeats(brute.frame(spark, distinct)), "doc_id", "n_words", "n_removed", "kept")
    assert group_sizes != (2,) and got == brute.without_later(distinct, 20)


def test_small_groups_in_a_task(spark, rows, monkeypatch):
    monkeypatch.setattr(repeats, "GROUP_BYTES", 1)
    assert result(remove_repeats(brute.frame(spark, rows), group_bytes=1 << 22), "doc_id", "n_removed") == [
        (r[0], r[2]) for r in brute.without_repeats(rows, 400)]


@pytest.mark.parametrize("k, num", [(4, 85), (5, 80), (1, 60)])
def test_similar_components(spark, rows, k, num):
    got = result(similar_components(brute.frame(spark, rows), k=k, num=num), "doc_id", "n_shingles", "component_id")
    assert got == brute.components(rows, k, num, 100)


def test_similar_components_split_paths_are_the_same(spark, rows, monkeypatch):
    monkeypatch.setattr(jaccard, "REPORT_FROM", 1)
    got = result(similar_components(brute.frame(spark, rows), k=2, num=60, bucket_rows=2, block_tokens=60), "doc_id", "n_shingles", "component_id")
    assert got == brute.components(rows, 2, 60, 100)


def profiled(texts, k=4):
    """Set sizes, two fingerprints and signatures of ``texts`` as the operator describes them."""
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc", "text"])
    return pa.Table.from_batches(jaccard._profiles(k, 85, 100, np.zeros(0, np.uint64), np.zeros(0, np.int64))([batch])).combine_chunks().to_batches()[0]


def test_long_unrelated_texts_that_share_a_token_are_no_family():
    rnd = random.Random(8)
    texts = ["four words in common " + brute.sentence(rnd, n) for n in (3000, 3100, 5000, 5100, 9000)]
    words = texts[3].split()
    texts += [" ".join(words[:-200]) + " " + brute.sentence(rnd, 150), " ".join(brute.sentence(rnd, 10) if i == 500 else w for i, w in enumerate(words))]
    p = profiled(texts)
    bucket = pa.RecordBatch.from_arrays([pa.array([7] * len(texts)), *(p.column(c) for c in ("f1", "f2", "n", "signature"))], ["token", "f1", "f2", "n", "signature"])
    edges = pa.Table.from_batches(jaccard._may_link(85, 100)([bucket]))
    f1 = p.column("f1").to_pylist()
    assert {f1.index(x) for c in ("a", "b") for x in edges.column(c).to_pylist()} == {3, 5, 6} and edges.num_rows == 2


def test_bound_is_never_below_the_overlap():
    rnd = random.Random(9)
    base = brute.sentence(rnd, 4000).split()
    texts = [" ".join(base[rnd.randint(0, 50):n]) + " " + brute.sentence(rnd, 1 + n // 50) for n in (60, 900, 1000, 1010, 1100, 2000, 2060, 2300, 4000)] + ["one", "the the " * 300]
    p, sets = profiled(texts), [brute.shingles(t, 4) for t in texts]
    n = np.array([len(s) for s in sets])
    signed = jaccard.Signatures(p.column("signature").to_pylist(), n)
    assert p.column("n").to_pylist() == n.tolist() and len(set(signed.slots.tolist())) > 2
    for q, s in enumerate(sets):
        bound = signed.bound(q, np.arange(len(sets)))
        assert all(b >= len(s & t) for b, t in zip(bound, sets)) and bound[q] == len(s)
    # slots that are full count the rest in the excess, on one side or both, whatever the number of slots
    crowded = [[rnd.randrange(1 << 6) + (rnd.randrange(1 << 40) << 13) for _ in range(m)] for m in (900, 1000, 1100, 1500, 2100)]
    crowded = [np.unique(np.array(c + crowded[0][:800], np.uint64)) for c in crowded]
    n = np.array([len(c) for c in crowded])
    row = np.repeat(np.arange(len(n)), n)
    signed = jaccard.Signatures(jaccard.signatures(row, np.concatenate(crowded), n), n)
    assert signed.excess.min() > 0 and len(set(signed.slots.tolist())) > 1
    for q, c in enumerate(crowded):
        assert all(b >= len(np.intersect1d(c, d)) for b, d in zip(signed.bound(q, np.arange(len(n))), crowded))


def test_few_rows_of_wide_signatures_in_a_batch(spark, rows, monkeypatch):
    p = profiled([t for _, t in rows])
    p = p.select(["n", "f1", "f2", "prefix", "signature"])
    everything = jaccard.BitFilter(np.full(1 << 10, 255, np.uint8), 13)
    want = pa.Table.from_batches(jaccard._prefix_tokens(everything)([p]))
    monkeypatch.setattr(jaccard, "SIGNATURE_BYTES", 1000)
    few = list(jaccard._prefix_tokens(everything)([p]))
    assert pa.Table.from_batches(few).equals(want) and max(b.num_rows for b in few) < 20
    got = result(similar_components(brute.frame(spark, rows), k=4, num=85), "doc_id", "n_shingles", "component_id")
    assert got == brute.components(rows, 4, 85, 100)


def test_occurrence_search_finds_all_links():
    rnd = random.Random(5)
    for _ in range(30):
        base = [rnd.sample(range(60), rnd.randint(1, 30)) for _ in range(4)]
        sets = [np.unique(np.array([x if rnd.random() > 0.1 else rnd.randint(0, 90) for x in rnd.choice(base)], np.uint64)) for _ in range(25)]
        index = OccurrenceIndex(sets)
        for q in range(len(sets)):
            want = {i for i, s in enumerate(sets) if 100 * len(set(s) & set(sets[q])) >= 70 * len(set(s) | set(sets[q]))}
            assert set(index.search(q, 70, 100)) | {q} == want | {q}
        root = link_sets(sets, 70, 100)
        assert (root <= np.arange(len(sets))).all()


def test_one_of_each_keeps_columns(spark, rows):
    df = brute.frame(spark, rows)
    kept = one_of_each(df, k=5, num=80)
    want = {d for d, _, c in brute.components(rows, 5, 80, 100) if d is not None and d == c}
    assert kept.schema == df.schema and {r.doc_id for r in kept.collect()} - {None} == want


def test_shared_lines(spark, rows):
    df = brute.frame(spark, rows)
    got = result(dedup_lines(df), "doc_id", "kept", "n_lines", "n_dropped")
    want = brute.without_shared_lines(rows)
    assert got == want and sum(r[3] for r in want) > 5
    whole = drop_shared_lines(df)
    assert whole.columns == [*df.columns, "n_lines", "n_dropped"]
    assert {r.doc_id for r in whole.where("text IS NULL").collect()} == {200}


def test_empty_tables(spark):
    df = brute.frame(spark, [])
    for out in (remove_repeats(df), remove_later_repeats(df), similar_components(df), dedup_lines(df)):
        assert out.collect() == []
    df = brute.frame(spark, [(None, None), (1, ""), (1, "")])
    assert result(similar_components(df), "doc_id", "n_shingles", "component_id") == [(1, 0, 1), (1, 0, 1), (None, 0, None)]
    assert result(remove_repeats(df), "doc_id", "n_removed") == [(1, 0), (1, 0), (None, 0)]
    assert result(remove_later_repeats(df), "doc_id", "n_removed") == [(1, 0), (1, 0), (None, 0)]


@pytest.mark.parametrize("kind", ["int", "string"])
def test_ids_of_other_types_and_rows_without_one(spark, rows, kind):
    few = [r for r in rows if r[0] is None or r[0] < 120]
    df = brute.frame(spark, few).withColumn("doc_id", F.col("doc_id").cast(kind))
    own = (lambda x: x if kind == "int" or x is None else str(x))
    typed = [(own(d), t) for d, t in few]
    got = result(similar_components(df, k=4, num=85, den=100), "doc_id", "n_shingles", "component_id")
    assert got == brute.components(typed, 4, 85, 100)
    kept = result(dedup_lines(df), "doc_id", "kept", "n_lines", "n_dropped")
    assert kept == brute.without_shared_lines(typed)
    assert any(d is None for d, *_ in kept)
