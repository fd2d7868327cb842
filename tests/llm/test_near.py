"""Operator 10 against a plain version."""

from __future__ import annotations

import random

import pytest

from sluice.llm import near
from sluice.llm import queries as q
from tests.llm import brute
from tests.llm.test_tokens import rows

COLUMNS = ("n_shingles", "component_id", "kept")


def chained_documents(seed=1, base=3, copies=40):
    """Chains of copies, each a few words away from one before it, so groups hold pairs that aren't linked."""
    rng = random.Random(seed)
    docs = []
    for _ in range(base):
        family = [[f"w{rng.randint(0, 5000)}" for _ in range(rng.randint(100, 300))]]
        for _ in range(copies):
            words = list(rng.choice(family))
            for _ in range(rng.choice([0, 1, 1, 2, 6])):
                words[rng.randrange(len(words))] = f"x{rng.randint(0, 99999)}"
            family.append(words)
        docs += [" ".join(w) for w in family]
    docs += [None, "", " \n ", "one two", "One\ttwo", "a b c d e", "a b c d e", "a a a a a a a a a"]
    order = rng.sample(range(len(docs) * 3), len(docs))
    return list(zip(order, docs))


def test_small_tables(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert rows(q.op10_minhash(spark, "/root/testdata/sf0.001"), *COLUMNS) == brute.near_groups(docs)


@pytest.mark.parametrize("seed", [1, 2])
def test_chains(spark, seed, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 20)
    docs = chained_documents(seed)
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id bigint, text string, label string")
    assert rows(near.near_duplicates(df, threshold=(85, 100)), *COLUMNS) == brute.near_groups(docs)
    kept = {r["doc_id"] for r in near.keep_one(df, threshold=(85, 100)).collect()}
    assert kept == {i for i, x in brute.near_groups(docs).items() if x[2]}


def test_recall_on_all_documents(spark):
    """Every component of the given corpus is found; README has the figures of the larger one."""
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    assert rows(q.op10_minhash(spark, "/root/testdata/sf0.01"), *COLUMNS) == brute.near_groups(docs)


def test_clashing_names(spark):
    text = " ".join(f"w{k}" for k in range(50))
    df = spark.createDataFrame([(1, text, "a", 1), (2, text, "b", 2), (3, None, "c", 3)], "doc_id bigint, text string, _gone string, label int")
    assert sorted((r["doc_id"], r["_gone"]) for r in near.keep_one(df).collect()) == [(1, "a"), (3, "c")]


def test_nulls_repeats_and_empty(spark):
    text = " ".join(f"w{k}" for k in range(50))
    df = spark.createDataFrame([(None, text), (None, text), (4, text), (4, text), (9, text)], "doc_id bigint, text string")
    got = sorted((r["doc_id"] or 0, r["component_id"], r["kept"]) for r in near.near_duplicates(df).collect())
    assert got == [(0, None, True), (0, None, True), (4, 4, True), (4, 4, True), (9, 4, False)]
    assert near.near_duplicates(df.limit(0)).count() == 0
    assert near.keep_one(df).count() == 4


def test_components_of_long_paths(spark):
    n = 60
    ids = random.Random(3).sample(range(1000), n)
    links = spark.createDataFrame([(min(a, b), max(a, b)) for a, b in zip(ids, ids[1:])], "a bigint, b bigint")
    assert {(r["id"], r["label"]) for r in near.components(links).collect()} == {(i, min(ids)) for i in ids}


def test_block_pairs_drop_no_link():
    import numpy as np
    import pyarrow as pa

    step = 1 << 64 - near.BINS.bit_length() + 1
    common = [k + 1 for k in range(850)]  # all in the first bin
    sets = [common, [*common, *[(k + 5) * step + 7 for k in range(150)]], [*common[:400], *[(k + 5) * step + 9 for k in range(450)]]]
    h, owner = np.array([x for s in sets for x in s], np.uint64), np.repeat(np.arange(3), [len(s) for s in sets])
    bands = [list(range(2 * near.BANDS))] * 3
    rows = [{"table": 0, "key": 0, "lo": 0, "hi": 0, "doc": k, "n": len(s), "label": k, "block": 0, "bands": bands[k], "sketch": m.tobytes()} for k, (s, m) in enumerate(zip(sets, near.sketches(h, owner, 3)))]
    out = [r for b in near._block_pairs(85, 100)([pa.RecordBatch.from_pylist(rows)]) for r in b.to_pylist()]
    assert out == [{"a": 0, "b": 1}]


def star_documents(copies, seed=4, hub=True):
    """A text and copies of it, each with a few changed words or so many that it is linked with none; the first rows are far ones."""
    rng = random.Random(seed)
    base = [f"w{k}" for k in range(150)]
    docs = []
    for k in range(copies):
        words = list(base)
        for at in rng.sample(range(150), 9 if k < 5 else 0 if hub and k == 5 else rng.choice([1, 1, 2, 3, 4, 7, 9])):
            words[at] = f"x{k}_{at}"
        docs.append((k, " ".join(words)))
    return docs


def test_rows_that_meet_grow_with_the_group(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 20)
    plain, count = near._block_pairs, {}
    for copies in (150, 600):
        rows_met = spark.sparkContext.accumulator(0)

        def counted(num, den, rows_met=rows_met):
            pairs = plain(num, den)

            def seen(batches):
                def each():
                    for batch in batches:
                        rows_met.add(batch.num_rows)
                        yield batch

                return pairs(each())

            return seen

        monkeypatch.setattr(near, "_block_pairs", counted)
        docs = star_documents(copies)
        df = spark.createDataFrame(docs, "doc_id bigint, text string")
        assert rows(near.near_duplicates(df, threshold=(85, 100)), *COLUMNS) == brute.near_groups(docs)
        count[copies] = rows_met.value
    assert count[600] < 8 * count[150]  # 16 times if all pairs of blocks meet


def test_copies_without_their_text(spark, monkeypatch):
    """Many members lie just beyond the threshold from all others, so they ask the blocks of their key."""
    monkeypatch.setattr(near, "BLOCK", 20)
    docs = star_documents(200, hub=False)
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert rows(near.near_duplicates(df, threshold=(85, 100)), *COLUMNS) == brute.near_groups(docs)
