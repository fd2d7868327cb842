"""Operators 4 to 7 against plain versions."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from sluice.llm import decontaminate
from sluice.llm import queries as q
from tests.llm import brute

SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "a", "aaaa" * 400, "one two\nthree", "one two\nthree", "two  spaces\n\nand lines\r\n\ttabs ", "<|endoftext|> it's", "日本語 テキスト\x00nul", "x" * 5000 + " " * 300]


def documents(spark, texts):
    return spark.createDataFrame([(i, t, "src") for i, t in enumerate(texts)], "doc_id bigint, text string, n_tokens string")


def rows(df, *cols):
    return {r["doc_id"]: tuple(r[c] for c in cols) for r in df.collect()}


@pytest.fixture(scope="module")
def small(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def test_bpe_matches_library(spark, small):
    got = rows(q.op7_byte_bpe(spark, SF), "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == brute.byte_bpe(small, q.PATTERN)


def test_bpe_odd_texts(spark):
    from sluice.llm.bpe import digest_documents, encode_documents

    file, docs = q.tokenizer("byte_bpe_multi_50k.tiktoken"), documents(spark, ODD)
    want = brute.byte_bpe(list(enumerate(ODD)), q.PATTERN)
    assert rows(digest_documents(docs, file, q.PATTERN), "n_tokens", "ids_sha256", "decoded_sha256") == want
    full = encode_documents(docs, file, q.PATTERN).collect()
    assert all(bytes(r["decoded"]) == (ODD[r["doc_id"]] or "").encode() for r in full)
    assert digest_documents(docs.limit(0), file, q.PATTERN).count() == 0


def test_odd_unicode_equals_both_libraries():
    """Cutting into chunks gives the libraries' ids on texts made to break it: odd spaces, marks, digits, cases, scripts."""
    import tiktoken
    from tokenizers import Tokenizer

    from sluice.llm.bpe import TextCodec, read_ranks
    from sluice.llm.wavelet import _Encoder

    parts = [" ", " ", " ", "  ", "\n", "\n\n", "\t", "\u00a0", "\u2003", "\u3000", "\x00", "\x0b", "\x85", "'s", "'", "'ll", "n't", "...", ",", "!?", "###", "_", "-", "²", "Ⅷ", "٣", "12", "a1", "é", "ß", "Éa", "e\u0301", "ʰ", "ǅ",
             "word", "Word", "wörd", "слово", "Ѐ\u0483", "日本", "한국", "ﬁ", "🙂", "👩\u200d👩", "\ufeff", "\u200b", "<|endoftext|>", "<|endof", "\U0002ebf0", "x" * 210]
    rng = random.Random(11)
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(4_000)]
    with open(q.tokenizer("byte_bpe_50k.json"), encoding="utf-8") as f:
        content = f.read()
    library, encoder = Tokenizer.from_str(content), _Encoder(content)
    for added in (True, False):
        library.encode_special_tokens = not added
        want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
        assert [np.frombuffer(x, "<u2").tolist() for x in encoder.encode(texts, added)] == want
    with open(q.tokenizer("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        lines = f.read()
    codec = TextCodec(read_ranks(lines), q.PATTERN)
    exact = tiktoken.Encoding("own", pat_str=q.PATTERN, mergeable_ranks=read_ranks(lines), special_tokens={})
    assert [np.frombuffer(x, "<u4").tolist() for x in codec.encode(texts)] == exact.encode_ordinary_batch(texts)


def test_join_equals_direct_merge():
    from sluice.llm.bpe import MonoidBpe, read_ranks

    with open(q.tokenizer("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        bpe = MonoidBpe(read_ranks(f.read()))
    rng = random.Random(5)
    for _ in range(400):
        data = bytes(rng.choices(b"aabcdet hn\xc3\xa9", k=rng.randint(2, 200)))
        cut = rng.randint(1, len(data) - 1)
        assert bpe.join(bpe._merge(data[:cut]), bpe._merge(data[cut:])) == bpe._merge(data) == bpe._tree(data)


def test_token_shards(spark, small):
    got = rows(q.op4_wavelet_shards(spark, SF), "start", "n_tokens", "ids_crc32")
    assert got == brute.token_shards(small)


def test_token_shards_odd_texts_and_lookups(spark):
    from sluice.llm import wavelet as w
    from sluice.llm.storage import new_path

    path = new_path(spark, "t")
    w.write_token_shards(documents(spark, ODD).repartition(3), q.tokenizer("byte_bpe_50k.json"), path, shard_bytes=2000, shard_tokens=300)
    want = brute.token_shards(list(enumerate(ODD)))
    assert rows(w.read_documents(spark, path, digest=True), "start", "n_tokens", "ids_crc32") == want
    full = {r["doc_id"]: np.frombuffer(r["ids"], "<u4") for r in w.read_documents(spark, path).collect()}
    assert sum(r["n"] for r in w.count_token(spark, path, 0).collect()) == sum(int((x == 0).sum()) for x in full.values())
    firsts = {(r["part"], r["piece"]): r["n"] for r in w.read_token_shards(spark, path).selectExpr("part", "piece", "n_tokens AS n").collect()}
    ids = np.concatenate([full[i] for i in sorted(full)])
    for token in (0, int(ids[3]), 49_000):
        places, before = [], 0
        found = w.find_token(spark, path, token).collect()
        for key in sorted(firsts):
            places += [before + r["position"] for r in found if (r["part"], r["piece"]) == key]
            before += firsts[key]
        assert sorted(places) == np.flatnonzero(ids == token).tolist()
    empty = new_path(spark, "t")
    w.write_token_shards(documents(spark, ODD).limit(0), q.tokenizer("byte_bpe_50k.json"), empty)
    assert w.read_documents(spark, empty).count() == 0


def test_token_shards_with_added_tokens(spark, tmp_path):
    from tokenizers import Tokenizer

    texts = [*ODD, "a<|endoftext|> b", "<|endoftext|><|endoftext|>\n<|endoftext", "plain text, <|endoftext |>", "one two"]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    library, want, start = Tokenizer.from_file(q.tokenizer("byte_bpe_50k.json")), {}, 0
    for i, t in enumerate(texts):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        want[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert rows(q.op4_wavelet_shards(spark, str(tmp_path)), "start", "n_tokens", "ids_crc32") == want


def test_wavelet_matrix():
    from sluice.llm.wavelet import WaveletMatrix

    values = np.random.default_rng(1).integers(0, 50, 3000).astype("<u2")
    m = WaveletMatrix(len(values), *WaveletMatrix.build(values))
    assert (m.to_numpy() == values).all()
    assert all(m.access(i) == values[i] for i in range(0, 3000, 37))
    assert all(m.rank(v, 2000) == (values[:2000] == v).sum() for v in range(60))
    at = np.flatnonzero(values == 7)
    assert [m.select(7, j) for j in range(len(at))] == at.tolist()
    assert m.select(7, len(at)) == -1 and m.select(55, 0) == -1


def test_contamination(spark, small):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = rows(q.op5_decontamination(spark, SF), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == brute.contamination(small, items)
    assert any(x[-1] for x in got.values())


@pytest.mark.parametrize("block_words", [5, 1000])
def test_contamination_odd_items(spark, block_words):
    from sluice.llm.decontaminate import find_contamination

    rng = random.Random(3)
    text = lambda n: " ".join(rng.choices("a b C d".split(), k=n))
    items = [(k, text(rng.choice([1, 3, 12, 13, 14, 30]))) for k in range(3, 12)] + [(100, None), (101, " ,; "), (9, "a b")]
    docs = [(k, text(rng.randint(0, 80)).replace(" ", rng.choice([" ", ", ", "\n"]))) for k in range(60)] + [(70, None), (71, ""), (72, items[0][1])]
    got = rows(find_contamination(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), block_words=block_words), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == brute.contamination(docs, items)


@pytest.mark.parametrize("block_words", [8, 1000])
def test_contaminated_spans_are_cut_to_the_byte(spark, block_words):
    from sluice.llm.decontaminate import remove_contaminated

    passage = "One two, three; FOUR five six seven eight nine ten eleven twelve thirteen fourteen"
    items = [(1, passage.lower()), (2, "a short item here")]
    docs = [
        (1, f"Keep THIS, Please. {passage} -- And This, \u00e9h!", "x", None), (2, passage, "x", 5), (3, "Nothing of it.", None, 1), (None, None, "y", 2),
        (5, "w " * 600 + passage, "z", 7), (5, "A short ITEM / here \u2014 a short item, here!", "z", 7),
    ]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, `_` string, row int")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r["doc_id"], (r["text"] or "")[:4]): r for r in remove_contaminated(df, bench, spans=True, length_col="row", block_words=block_words).collect()}
    assert got[1, "Keep"]["text"] == "Keep THIS, Please.  -- And This, \u00e9h!" and got[1, "Keep"]["row"] == len(got[1, "Keep"]["text"])
    assert got[3, "Noth"]["text"] == docs[2][1] and got[None, ""]["text"] is None and got[5, "w w "]["text"] == docs[4][1]
    assert [r["text"] for k, r in got.items() if k[0] == 5 and k[1] != "w w "] == [" \u2014 !"] and len(got) == 5
    dropped = remove_contaminated(df, bench, block_words=block_words).collect()
    assert sorted((r["doc_id"] or 0) for r in dropped) == [0, 3, 5] and remove_contaminated(df.limit(0), bench, block_words=block_words).count() == 0


def test_shards(spark, small):
    got = q.op6_sharding(spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(i for i, _ in small)
    texts = dict(small)
    for r in got:
        b = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(b) + 8, zlib.crc32(b), "rows", None)
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(slots) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_shards_do_not_depend_on_input_order(spark):
    from sluice.llm.sharding import shard_documents

    docs = spark.createDataFrame([(i if i % 9 else None, f"text {i}", "b") for i in range(300)], "doc_id bigint, text string, bucket string")
    a, b = ({(r["doc_id"], r["text"]): (r["shard"], r["slot"]) for r in shard_documents(d, 7, bucket_bytes=500).collect()} for d in (docs, docs.repartition(5)))
    assert a == b and len(a) == 300
    assert shard_documents(docs.limit(0), 7).count() == 0
    clash = shard_documents(docs.selectExpr("*", "1 AS _first", "'x' AS shard", "2.5 AS slot", "3 AS _"), 7, bucket_bytes=500)
    assert {(r["doc_id"], r["text"]): (r["shard"], r["slot"]) for r in clash.collect()} == a and set(clash.columns) == {*docs.columns, "_first", "_", "bucket", "bucket_row", "shard", "slot"}


def test_short_items_that_repeat_stay_small():
    """Thousands of equal one-word items cost one text, and short items that end inside long ones are followed by links."""
    import pickle
    import time

    rng = random.Random(3)
    long = [(f"l{k}", [b"w%d" % rng.randint(0, 4000) if rng.random() < 0.9 else b"yes" for _ in range(60)]) for k in range(1000)]
    short = [(f"s{k}", [b"yes"]) for k in range(16_000)] + [("two", [b"oh", b"yes"]), ("three", [b"so", b"oh", b"yes"])]
    automaton = decontaminate.ItemAutomaton(long + short, 13)
    assert len(pickle.dumps(automaton)) < 30_000_000 and len(automaton.ends) <= 4
    words = [b"so", b"oh", b"yes", *long[5][1][:30], b"no"]
    begin = time.time()
    hit, found = automaton.scan(words)
    assert time.time() - begin < 0.2
    assert found == {f"s{k}" for k in range(16_000)} | {"two", "three", "l5"} and hit[:33].all() and not hit[33]


def test_chunks_are_looked_up_once():
    """A lookup for each different chunk of a group of texts, not for each chunk."""
    from sluice.llm.chunks import ChunkCache

    class Counted(dict):
        n = 0

        def get(self, *a):
            self.n += 1
            return super().get(*a)

        def __getitem__(self, key):
            self.n += 1
            return super().__getitem__(key)

    plain = lambda chunks: [x.encode() for x in chunks]
    cache = ChunkCache(plain, plain, lambda text: b"[" + text.encode() + b"]")
    cache._known = Counted()
    texts = ["one two, three\nfour " * 500 + "end", "", "one  two", "nul\x00 one", "x" * 300, "two, one"] * 3
    assert cache.encode(texts) == [texts[0].encode(), b"", b"[one  two]", b"[nul\x00 one]", b"[" + b"x" * 300 + b"]", b"two, one"] * 3
    assert cache._known.n < 100 and cache.encode([]) == []


def test_planes_in_steps():
    from sluice.llm.wavelet import STEP, WaveletMatrix

    rng = np.random.default_rng(3)
    for n in (0, 1, STEP - 1, STEP, 3 * STEP + 777):
        values = rng.integers(0, 50_257, n).astype("<u2")
        matrix = WaveletMatrix(n, *WaveletMatrix.build(values))
        assert (matrix.to_numpy() == values).all()
        assert all(matrix.access(i) == values[i] for i in range(0, n, 5_003))
        assert n == 0 or matrix.rank(int(values[0]), n) == (values == values[0]).sum()
