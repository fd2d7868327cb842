"""Operator 8 against a plain version."""

from __future__ import annotations

import random

import numpy as np
import pytest

from sluice.llm import queries as q
from sluice.llm import spans as s
from tests.llm import brute
from tests.llm.test_tokens import rows

COLUMNS = ("n_bytes", "n_removed", "n_spans", "kept_sha256")


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id bigint, text string")


def odd_documents(seed=4):
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choices("abcdé \n", k=n))
    shared = [word(k) for k in (60, 99, 100, 101, 150, 400)]
    docs = []
    for i in range(120):
        parts = [word(rng.randint(0, 200))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(shared), word(rng.randint(0, 120))]
        docs.append((i, "".join(parts)))
    docs += [(200, None), (201, ""), (202, "a" * 1000), (203, "ab" * 600), (204, "a" * 99), (205, "a" * 100), (206, docs[0][1]), (207, docs[5][1][:-1] + "x")]
    rng.shuffle(docs)
    return docs


def test_small_tables(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert rows(q.op8_suffix_dedup(spark, "/root/testdata/sf0.001"), *COLUMNS) == brute.repeated_spans(docs)


@pytest.mark.parametrize("hot", [1, 4096])
def test_odd_documents(spark, hot, monkeypatch):
    monkeypatch.setattr(s, "HOT_RUNS", hot)
    docs = odd_documents()
    assert rows(s.digest_repeats(frame(spark, docs).repartition(3)), *COLUMNS) == brute.repeated_spans(docs)


def test_null_ids_repeated_rows_and_empty_tables(spark):
    text = "".join(random.Random(1).choices("abc", k=300))
    got = s.digest_repeats(frame(spark, [(None, text), (None, text), (1, text), (1, text), (2, text)])).collect()
    assert sorted((r["doc_id"] or 0, r["n_removed"]) for r in got) == [(0, 0), (0, 0), (1, 0), (1, 0), (2, 300)]
    assert s.digest_repeats(frame(spark, []).limit(0)).count() == 0


def test_small_steps_settle_the_same():
    """Groups cut across batches, one row a batch, give the same as one batch."""
    import pyarrow as pa

    rng = np.random.default_rng(2)
    for _ in range(40):
        cols = [np.zeros(60, np.int32), *rng.integers(0, 6, (2, 60)), *rng.integers(0, 9, (2, 60)), np.ones(60, np.int64)]
        order = np.lexsort((cols[4], cols[3], cols[2], cols[1]))
        whole = pa.RecordBatch.from_arrays([pa.array(c[order]) for c in cols], names=["kind", "key", "sub", "doc", "at", "n"])
        parts = [whole.slice(k, 1) for k in range(60)]
        a, b = (sorted(tuple(r.values()) for x in s._settle(iter(y)) for r in x.to_pylist()) for y in ([whole], parts))
        assert a == b


def test_remove_repeats_keeps_columns(spark):
    docs = odd_documents(9)
    df = spark.createDataFrame([(t, i, f"s{i}", len(t or ""), f"n{i}") for i, t in docs], "text string, doc_id bigint, data string, n_chars bigint, _null string")
    got = s.remove_repeats(df, length_col="n_chars").collect()
    want = brute.repeated_spans(docs)
    assert len(got) == len(docs)
    for r in got:
        size, removed, _, _ = want[r["doc_id"]]
        assert r["data"] == f"s{r['doc_id']}" and r["_null"] == f"n{r['doc_id']}" and r["n_chars"] == (len(r["text"]) if r["text"] is not None else None)
        assert len((r["text"] or "").encode()) <= size - removed
