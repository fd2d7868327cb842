"""Each stage against a plain version on its own input, and the run as a whole."""

from __future__ import annotations

import random

import corpus_pipeline as p
from sluice.llm import queries as q
from sluice.llm.near import near_duplicates
from sluice.llm.quality import score_quality
from sluice.llm.spans import digest_repeats
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def cut_text(text, removed):
    """The text without the characters that lose a byte; removed marks bytes."""
    out, at = [], 0
    for c in text:
        n = len(c.encode())
        if not any(removed[at : at + n]):
            out.append(c)
        at += n
    return "".join(out)


def removed_bytes(docs, length=100):
    first = {}
    for i, text in sorted(docs.items()):
        b = text.encode()
        for k in range(len(b) - length + 1):
            first.setdefault(b[k : k + length], (i, k))
    out = {}
    for i, text in docs.items():
        b = text.encode()
        gone = [False] * len(b)
        for k in range(len(b) - length + 1):
            if first[b[k : k + length]] < (i, k):
                gone[k : k + length] = [True] * length
        out[i] = gone
    return out


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    assert [name for name, _ in p.STAGES] == ["quality", "near_duplicates", "repeated_spans", "decontamination", "byte_bpe"]
    text = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}

    one = p.quality(spark, docs, SF).cache()
    good = {r["doc_id"] for r in score_quality(docs, q.quality_model(spark, SF)).where("kept").collect()}
    assert one.columns == columns and set(text(one)) == good and 0 < len(good) < docs.count()

    two = p.near_duplicates(spark, one, SF).cache()
    groups = brute.near_groups(list(text(one).items()), 80, 100)
    assert two.columns == columns and set(text(two)) == {i for i, g in groups.items() if g[2]}

    three = p.repeated_spans(spark, two, SF).cache()
    before, gone = text(two), removed_bytes(text(two))
    assert three.columns == columns and text(three) == {i: cut_text(t, gone[i]) for i, t in before.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in three.collect()) and any(map(any, gone.values()))

    four = p.decontamination(spark, three, SF).cache()
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    judged = brute.contamination(list(text(three).items()), items)
    assert four.columns == columns and text(four) == {i: t for i, t in text(three).items() if not judged[i][-1]}

    five = p.byte_bpe(spark, four, SF).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in five} == brute.byte_bpe(list(text(four).items()), q.PATTERN)
    assert all(len(r["ids"]) == 4 * r["n_tokens"] for r in five)

    whole = p.run(spark, SF).collect()
    assert sorted(whole, key=lambda r: r["doc_id"]) == sorted(five, key=lambda r: r["doc_id"])


def test_odd_rows_pass_every_stage(spark):
    """Null texts and ids, repeated rows and ids, clashing names, and an empty table."""
    good = spark.read.parquet(f"{SF}/documents.parquet").orderBy("n_chars", ascending=False).limit(2).collect()
    rows = [(10, None, "en", 1, "a", 0, "p"), (None, None, None, None, None, None, None), (11, "", "en", 2, "b", 0, "q"), (None, good[0]["text"], "en", 3, "c", 5, "r")]
    rows += [(12, good[1]["text"], "en", 4, "d", 9, "s")] * 2 + [(12, "another text with this id", "en", 4, "d", 9, "s")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, label int, _gone string, n_chars bigint, `_null` string")
    for name, stage in p.STAGES:
        empty = stage(spark, docs.limit(0), SF)
        out = stage(spark, docs, SF)
        assert empty.count() == 0
        if name == "byte_bpe":
            assert out.count() == len(rows)
        else:
            assert out.columns == docs.columns and empty.columns == docs.columns
            ids = [r["doc_id"] for r in out.collect()]
            assert set(ids) <= {None, 10, 11, 12}
            if name != "quality":
                assert len(ids) == len(rows)


def words(seed, n=60):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))


def test_ids_with_several_texts(spark):
    """Long texts of one id are documents of their own: none is emptied or dropped for another's sake, in any stage."""
    one, two, three, four = words(1), words(2), words(3), words(4)
    rows = [(0, one), (1, one), (1, two), (2, three), (2, two), (3, four), (3, four), (9, three), (9, four), (9, words(5))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "cast(0 AS bigint) AS n_chars")
    got = lambda df: sorted((r["doc_id"], r["text"]) for r in df.collect())

    kept = got(p.near_duplicates(spark, docs, SF))
    assert {t for _, t in kept} == {t for _, t in rows}, "each different text stays once"
    assert len(set(kept)) == len({t for _, t in rows}) and kept.count((3, four)) in (0, 2)

    cut = p.repeated_spans(spark, docs, SF).collect()
    assert len(cut) == len(rows)
    left = [r["text"] for r in cut if r["text"]]
    assert set(left) == {t for _, t in rows}
    assert all(left.count(t) == (2 if t == four and (3, four) in [(r["doc_id"], r["text"]) for r in cut] else 1) for t in set(left))
    digests = digest_repeats(docs).collect()
    assert sorted((r["doc_id"], r["n_removed"]) for r in digests) == sorted((r["doc_id"], 0 if r["text"] else 419) for r in cut)
    assert sorted(r["doc_id"] for r in near_duplicates(docs).collect()) == sorted(i for i, _ in rows)
    for name, stage in p.STAGES:
        if name in ("decontamination", "byte_bpe"):
            assert stage(spark, docs, SF).count() == len(rows)
