"""Operator 9 against plain versions and held-out likelihood."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pytest

from sluice.llm import lattice as m
from sluice.llm import queries as q
from tests.llm import brute


def segmentations(word, weights):
    """Probability of the word by trying every segmentation."""
    if not word:
        return 1.0
    return sum(weights[word[:k]] * segmentations(word[k:], weights) for k in range(1, len(word) + 1) if word[:k] in weights)


PIECES = [b" a", b" ab", b"b", b"c", b"bc", b"abc", b" ", b"a"]


def test_forward_is_the_sum_over_segmentations():
    p = np.linspace(1, 2, len(PIECES))
    p /= p.sum()
    weights = dict(zip(PIECES, p))
    words = [b"a", b"abc", b"abcbc", b"cab", b"bbbbbb", b"abcabc"]
    got = m.Lattice(PIECES, np.log(p)).log_likelihood(words)
    assert np.allclose(np.exp(got), [segmentations(b" " + w, weights) for w in words])


def test_expected_counts_add_up():
    p = np.full(len(PIECES), 1 / len(PIECES))
    words, counts = [b"abc", b"ab", b"abcabc"], np.array([2.0, 1.0, 3.0])
    got = m.Lattice(PIECES, np.log(p)).expected_counts(words, counts)
    covered = sum(n * len(x) for n, x in zip(got, PIECES))
    assert math.isclose(covered, sum(c * (len(w) + 1) for w, c in zip(words, counts)))


@pytest.mark.parametrize("common", [40, 100_000])
def test_small_tables(spark, common):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    docs += [(1002, None), (1001, ""), (1000, "Zq" * 300)]
    df = spark.createDataFrame([(i, t, f"x{i % 3}" if i % 3 else None, 1) for i, t in docs], "doc_id bigint, text string, lang string, row int")
    counts = brute.word_counts(docs)
    n, v = sum(counts.values()), len(counts)
    got = {r["doc_id"]: r for r in m.score_documents(df, q.tokenizer("piece_bpe_32k.model"), common_words=common).collect()}
    assert len(got) == len(docs)
    for i, text in docs:
        tokens = [*brute.WORDS.findall(brute.lower(text)), "\n"]
        r = got[i]
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 7 == 2)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(counts[t] > 0 for t in tokens), n)
        assert math.isclose(r["base_score"], sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens), rel_tol=1e-9)
        assert r["score"] < 0 and math.isfinite(r["score"])
    pieces, weights = m.read_vocabulary(q.tokenizer("piece_bpe_32k.model"))
    want = brute.lattice_scores([d for d in docs if d[0] != 1000], {i: i % 3 for i, _ in docs if i != 1000}, pieces, weights / weights.sum(), m.PRIOR)
    assert zlib.crc32(b"1000") % 7 == 2  # held out, so its word of 600 bytes, beyond plain floats, isn't trained on
    for i, x in want.items():
        assert math.isclose(got[i]["score"], x, rel_tol=1e-9)


def test_many_classes(spark):
    docs = [(i, f"w{i % 5} common words of class {i % 12}", f"c{i % 12}") for i in range(200)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    pieces, weights = m.read_vocabulary(q.tokenizer("piece_bpe_32k.model"))
    want = brute.lattice_scores([d[:2] for d in docs], {i: k for i, _, k in docs}, pieces, weights / weights.sum(), m.PRIOR)
    for r in m.score_documents(df, q.tokenizer("piece_bpe_32k.model")).collect():
        assert math.isclose(r["score"], want[r["doc_id"]], rel_tol=1e-9)


def test_very_long_words():
    """Forward and backward over a word in stretches are those over the whole; a megabyte takes seconds."""
    rng = np.random.default_rng(3)
    p = np.linspace(1, 2, len(PIECES)) / 20
    word = bytes(rng.choice(list(b"abc"), 40_000).tolist())
    one = m.Lattice(PIECES, np.log(p))
    whole = one.expected_counts([word], np.ones(1))
    assert math.isclose(sum(n * len(x) for n, x in zip(whole, PIECES)), len(word) + 1, rel_tol=1e-6)
    assert math.isfinite(one.log_likelihood([word * 25])[0])


def test_held_out_texts_are_likelier_than_by_the_base(spark):
    got = q.op9_subword_lattice(spark, "/root/testdata/sf0.1").where("held_out").agg({"score": "sum", "base_score": "sum"}).collect()[0]
    assert got["sum(score)"] > got["sum(base_score)"]


def test_empty_table(spark):
    assert m.score_documents(spark.createDataFrame([], "doc_id bigint, text string, lang string"), q.tokenizer("piece_bpe_32k.model")).count() == 0
