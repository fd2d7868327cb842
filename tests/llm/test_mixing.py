"""Operator 12: targets against a plain version, rounding by its laws."""

from __future__ import annotations

from collections import defaultdict

import pytest

from sluice.llm import mixing
from sluice.llm import queries as q
from tests.llm.brute import WORDS

SF = "/root/testdata/sf0.01"


def plain_targets(sizes, weights=(5, 2, 1), share=150, cap=2):
    """Targets of {source: size}: dealt by weight, cut at the cap, the excess dealt again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, free, left = {}, set(names), sum(sizes.values()) * share / 100
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > cap * sizes[s]}
        for s in over or free:
            target[s] = float(cap * sizes[s]) if over else left * weight[s] / total
        left -= sum(target[s] for s in over)
        free -= over or free
    return target


def check(made, docs, cap=2):
    """made: (id, source, size, source_size, target, taken) rows; docs: (id, text, source)."""
    sizes, largest = defaultdict(int), defaultdict(int)
    for _, text, source in docs:
        n = len(WORDS.findall(text or ""))
        sizes[source] += n
        largest[source] = max(largest[source], n)
    target, taken = plain_targets(sizes), defaultdict(int)
    assert sorted((m[0] or 0, str(m[1]), m[2]) for m in made) == sorted((i or 0, str(s), len(WORDS.findall(t or ""))) for i, t, s in docs)
    for _, source, size, source_size, goal, got in made:
        assert source_size == sizes[source] and goal == pytest.approx(target[source], rel=1e-12, abs=1e-9)
        assert 0 <= got <= cap * size and (not size or got % size == 0)
        taken[source] += got
    for source, n in taken.items():
        assert abs(n - target[source]) <= largest[source] + 1e-6
    return taken, target


def result(df):
    return sorted([(r["doc_id"], r["source"], r["size"], r["source_size"], r["target"], r["taken"]) for r in df.collect()], key=repr)


@pytest.mark.parametrize("bucket", [512, 7])
def test_whole_table(spark, bucket, monkeypatch):
    """Both as one chain a source and as a tree of several levels; near the target, whatever the partitions."""
    monkeypatch.setattr(mixing, "BUCKET", bucket)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    made = result(mixing.mix_sources(docs))
    taken, target = check(made, [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()])
    assert sum(abs(taken[s] - target[s]) for s in taken) < 0.02 * sum(target.values())
    assert made == result(mixing.mix_sources(docs.repartition(7, "text")))
    if bucket == 512:
        assert sorted(tuple(r) for r in q.op12_source_mix(spark, SF).collect()) == sorted((m[0], *m[2:]) for m in made)
    else:
        whole = {m[0]: m[5] for m in made}
        other = {m[0]: m[5] for m in result(mixing.mix_sources(docs, seed=2))}
        assert whole.keys() == other.keys() and sum(whole[i] != other[i] for i in whole) > 100


def test_expectations(spark):
    """Over many like sources documents of every size come to the copies that they are due."""
    docs = spark.range(300 * 30).selectExpr("id AS doc_id", "concat('s', lpad(cast(id DIV 30 AS string), 3, '0')) AS source", "repeat('w ', cast(1 + id % 10 AS int)) AS text")
    made = mixing.mix_sources(docs, weights=(3, 2, 1)).groupBy("target", "size").agg({"copies": "avg", "source_size": "max", "*": "count"}).collect()
    assert len(made) == 30
    for r in made:
        assert r["count(1)"] == 300 and abs(r["avg(copies)"] - r["target"] / r["max(source_size)"]) < 0.12


def test_odd_rows(spark):
    rows = [(i, "one two three" * (i % 4), ["a", "b", None, "", "é", "z"][i % 6]) for i in range(90)] + [(None, "no id", "a"), (5, None, "a"), (6, " \n ", "only blank"), (7, "big " * 5000, "lone")]
    rows += [(8, "same row here", "hot")] * 300 + [(8, "same row here", "a")] * 5 + [(9, "x y", "hot")]
    docs = spark.createDataFrame([(*r, 1, "t") for r in rows], "doc_id bigint, text string, source string, size int, target string")
    made = result(mixing.mix_sources(docs))
    check(made, rows)
    assert made == result(mixing.mix_sources(docs.repartition(5)))
    hot = [m[5] for m in made if m[1] == "hot" and m[0] == 8]
    assert len(hot) == 300 and max(hot) - min(hot) <= 3
    assert mixing.mix_sources(docs.limit(0)).count() == 0
    blank = docs.where("source = 'only blank'")
    assert [tuple(r)[2:] for r in mixing.mix_sources(blank).collect()] == [(0, 0, 0.0, 0, 0)]


def test_equal_rows_beyond_a_run(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RUN", 4)
    docs = spark.createDataFrame([(1, "a b", "s")] * 10 + [(2, "c", "s")], "doc_id int, text string, source string")
    check(result(mixing.mix_sources(docs)), [(1, "a b", "s")] * 10 + [(2, "c", "s")])


def test_no_python_in_the_plan(spark):
    plan = mixing.mix_sources(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan
