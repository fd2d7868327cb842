"""Operator 11 against SQL, a plain version and its own round trip."""

from __future__ import annotations

import hashlib
import random

import pytest

from sluice.llm import middle
from sluice.llm import oracle
from sluice.llm import queries as q
from tests.llm.test_tokens import rows
from tests.oracle import connect, difference


def plain_version(doc, text, seed="1"):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(text)
    a, b = sorted([h1 % (n + 1), h2 % (n + 1)])
    if not text or any(m in text for m in middle.MARKS) or h3 % 100 >= 90:
        return n, "plain", None, None, text, text
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}", text
    return n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}", text


def odd_texts():
    rng = random.Random(5)
    alphabet = ["<", "<P", "<S", "P>", "S>", "M>", ">", "a", "\n", "é", "é", "\u0000", "漢", "👩‍👩‍👧", "🇩🇪", "\r\n", "<<S", "<M"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(900)]
    return texts + [None, "", "a", "x<P>y", "x<S>y", "<M>", "long é漢👩 " * 500]


@pytest.mark.parametrize("limit", [middle.SLICE, 7])
def test_odd_texts(spark, monkeypatch, limit):
    texts = odd_texts()
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, "no id", "x", 1), (3, texts[3], "x", 1), (3, texts[3], "x", 1)], "doc_id int, text string, form string, a int")
    if limit != middle.SLICE:  # slices of a few code points, in this process
        import pyarrow as pa

        monkeypatch.setattr(middle, "SLICE", limit)
        given = [t or "" for t in texts]
        cuts = [plain_version(i, t)[2:4] for i, t in enumerate(given)]
        a = [c[0] or 0 for c in cuts]
        b = [x + (c[1] or 0) for x, c in zip(a, cuts)]
        got = middle.pieces(pa.array(given, pa.large_string()), pa.array(a, pa.int64()), pa.array(b, pa.int64()))
        assert [p.to_pylist() for p in got] == [[t[:x] for t, x in zip(given, a)], [t[x:y] for t, x, y in zip(given, a, b)], [t[y:] for t, y in zip(given, b)]]
        return
    made = middle.fill_in_middle(docs)
    assert made.schema["doc_id"].dataType.simpleString() == "int"
    got = [tuple(r)[1:] for r in made.orderBy("doc_id").collect()]
    want = [plain_version(None, "no id")] + [plain_version(i, t) for i, t in enumerate(texts) for _ in range(3 if i == 3 else 1)]
    assert got == want
    assert {r[1] for r in got} == {"plain", "psm", "spm"}
    assert middle.fill_in_middle(docs.limit(0)).count() == 0


def test_ids_of_text_and_marks(spark):
    docs = spark.createDataFrame([("k1", "some words"), ("k2", None)], "key string, body string")
    made = middle.fill_in_middle(docs, "key", "body", seed="7", marks=("[p]", "[s]", "[m]"), plain=0).orderBy("key").collect()
    assert made[0]["restored"] == "some words" and made[0]["output"].startswith(("[p]", "[s]")) and made[1]["form"] == "plain"
    with pytest.raises(ValueError):
        middle.fill_in_middle(docs, "key", "body", marks=("aba", "<S>", "<M>"))
    with pytest.raises(ValueError):
        middle.fill_in_middle(docs.withColumnRenamed("key", "form"), "form", "body")


def test_query_and_sql(spark):
    sf = "/root/testdata/sf0.01"
    made = q.op11_fill_in_middle(spark, sf)
    assert difference(made, oracle.fill_in_middle(), connect(sf)) == ""
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = {i: (*v[:4], sha(v[4]), sha(v[5])) for i, v in ((i, plain_version(i, t)) for i, t in docs)}
    assert rows(made, "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256") == want
