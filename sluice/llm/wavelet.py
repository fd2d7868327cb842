"""Token ids as one wavelet matrix per shard.

A wavelet matrix keeps a sequence of numbers as one bit-plane for each binary digit, most significant
first; below each plane the numbers whose digit was 0 come before those whose digit was 1, each in
their old order. With a running count of ones for each block of 512 bits, access, counting (rank) and
finding an occurrence (select) take one step for each plane. A shard is one row of one compressed file:
documents in ascending id order, their lengths, the planes and the counts.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.chunks import ChunkCache
from sluice.llm.storage import new_path

#: Bits in a block of the rank directory.
BLOCK_BITS = 512
#: Numbers that a plane is made from or undone to at a time, so that they stay in a core's cache; a multiple of 8.
STEP = 1 << 15
#: Text bytes that make a shard, and ids at which a shard is closed whatever its text was.
SHARD_BYTES, SHARD_TOKENS = 24 << 20, 16 << 20

SHARD_SCHEMA = "part int, piece int, n_docs bigint, n_tokens bigint, doc_ids binary, has_id binary, lengths binary, planes array<binary>, ranks array<binary>"


class WaveletMatrix:
    """A sequence of numbers below 2 ** len(planes)."""

    def __init__(self, n: int, planes: list[bytes], ranks: list[bytes]):
        self.n, self.planes = n, [np.frombuffer(x, np.uint8) for x in planes]
        self.ranks = [np.frombuffer(x, "<u4") for x in ranks]
        self.zeros = [n - int(self._ones(k, n)) for k in range(len(planes))]

    @classmethod
    def build(cls, values: np.ndarray, bits: int = 16) -> tuple[list[bytes], list[bytes]]:
        """Planes and rank directories of the numbers."""
        planes, ranks = [], []
        for k in range(bits - 1, -1, -1):
            digit, parts, sides = values.dtype.type(1 << k), [], ([], [])
            for at in range(0, len(values), STEP):
                some = values[at : at + STEP]
                one = (some & digit) != 0
                parts.append(np.packbits(one, bitorder="little"))
                if k:
                    sides[0].append(np.compress(~one, some))
                    sides[1].append(np.compress(one, some))
            packed = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
            per_byte = np.bitwise_count(packed)
            step = BLOCK_BITS // 8
            sums = np.add.reduceat(per_byte, np.arange(0, len(per_byte), step), dtype=np.uint32) if len(per_byte) else np.zeros(0, np.uint32)
            planes.append(packed.tobytes())
            ranks.append(np.concatenate([[0], np.cumsum(sums)]).astype("<u4").tobytes())
            if k and len(values):
                values = np.concatenate(sides[0] + sides[1])
        return planes, ranks

    def _ones(self, k: int, i: int) -> int:
        """Ones before position i of plane k."""
        block = i // BLOCK_BITS
        lo, plane = block * BLOCK_BITS // 8, self.planes[k]
        count = int(self.ranks[k][block]) + int(np.bitwise_count(plane[lo : i // 8]).sum())
        return count + (int(plane[i // 8]) & (1 << i % 8) - 1).bit_count() if i % 8 else count

    def access(self, i: int) -> int:
        """The number at position i."""
        value = 0
        for k, plane in enumerate(self.planes):
            one = plane[i // 8] >> i % 8 & 1
            ones = self._ones(k, i)
            i = self.zeros[k] + ones if one else i - ones
            value = value << 1 | int(one)
        return value

    def rank(self, value: int, i: int) -> int:
        """How often the number stands before position i."""
        lo, hi = self._range(value, 0, i)
        return hi - lo

    def _range(self, value: int, lo: int, hi: int) -> tuple[int, int]:
        for k in range(len(self.planes)):
            a, b = self._ones(k, lo), self._ones(k, hi)
            one = value >> len(self.planes) - 1 - k & 1
            lo, hi = (self.zeros[k] + a, self.zeros[k] + b) if one else (lo - a, hi - b)
        return lo, hi

    def select(self, value: int, j: int) -> int:
        """Position of occurrence j (from 0) of the number; -1 if there are fewer."""
        return int(self.select_many(value, np.array([j]))[0])

    def select_many(self, value: int, j: np.ndarray) -> np.ndarray:
        """The same for many occurrences at once, a step for each plane."""
        lo, hi = self._range(value, 0, self.n)
        good = (j >= 0) & (j < hi - lo)
        at = lo + j[good]
        for k in range(len(self.planes) - 1, -1, -1):
            one = value >> len(self.planes) - 1 - k & 1
            at = self._find(k, one, at - self.zeros[k] if one else at)
        out = np.full(len(j), -1, np.int64)
        out[good] = at
        return out

    def _find(self, k: int, one: int, j: np.ndarray) -> np.ndarray:
        """Positions of the digits number j (from 0) in plane k: the block by the rank directory, the place by a count inside."""
        if not len(j):
            return j
        before = self.ranks[k].astype(np.int64)
        before = before if one else np.arange(len(before)) * BLOCK_BITS - before
        block = np.searchsorted(before, j, "right") - 1
        size = BLOCK_BITS // 8
        rows = np.zeros((len(j), size), np.uint8)
        at = block[:, None] * size + np.arange(size)
        inside = at < len(self.planes[k])
        rows[inside] = self.planes[k][at[inside]]
        bits = np.unpackbits(rows, axis=1, bitorder="little")
        count = np.cumsum(bits if one else 1 - bits, axis=1, dtype=np.int16)
        return block * BLOCK_BITS + np.argmax(count > (j - before[block])[:, None], axis=1)

    def to_numpy(self) -> np.ndarray:
        """All numbers, by undoing the planes from the last to the first."""
        values = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for k in range(len(self.planes) - 1, -1, -1):
            above, digit, low, high = np.empty_like(values), values.dtype.type(1 << len(self.planes) - 1 - k), 0, self.zeros[k]
            for at in range(0, self.n, STEP):
                part = above[at : at + STEP]
                one = np.unpackbits(self.planes[k][at // 8 : (at + STEP) // 8], count=len(part), bitorder="little").view(bool)
                ones = int(np.count_nonzero(one))
                part[~one] = values[low : low + len(part) - ones]
                part[one] = values[high : high + ones] | digit
                low, high = low + len(part) - ones, high + ones
            values = above
        return values


def byte_alphabet() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it can be seen, else one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + k) for k, b in enumerate(rest)}


class _Encoder:
    """The tokenizer of a Python worker. New chunks are encoded many at a time, as one text.

    A chunk without leading space gets a newline before it, which is a piece of its own, so chunks meet where
    the pre-tokeniser cuts; the tokens' lengths in bytes tell where each chunk's ids end.
    """

    _built: dict[int, _Encoder] = {}

    def __init__(self, content: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(content)
        self._tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text, but for with_added()
        self._added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=False)
        self._bytes = np.zeros(max(vocabulary.values()) + 2, np.int64)
        for token, i in vocabulary.items():  # one character of the byte-level alphabet is one byte
            self._bytes[i] = len(token)
        self._cache = ChunkCache(self._letters_by(content), self.many, self.whole, limit=1_000_000)

    def _letters_by(self, content: str) -> Callable[[list[str]], list[bytes]]:
        """The tokenizer's merges without its pattern, for chunks that are one piece each; the pattern costs more than the merges."""
        from tokenizers import Tokenizer

        parts = json.loads(content)
        before = parts["pre_tokenizer"] or {}
        if parts["normalizer"] or before.get("type") != "ByteLevel" or before["add_prefix_space"]:
            return self.many
        parts |= {"added_tokens": [], "post_processor": None, "decoder": None, "pre_tokenizer": {"type": "CharDelimiterSplit", "delimiter": " "}}
        merges, alphabet = Tokenizer.from_str(json.dumps(parts)), byte_alphabet() | {ord("\n"): " "}

        def letters(chunks: list[str], size: int = 1_000) -> list[bytes]:
            out = []
            for k in range(0, len(chunks), size):
                some = chunks[k : k + size]
                text = "\n".join(some).encode().decode("latin-1").translate(alphabet)
                ids = np.array(merges.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u2")
                ends = np.cumsum(list(map(len, map(str.encode, some))))
                stops = (2 * np.searchsorted(np.cumsum(self._bytes[ids]), ends) + 2).tolist()
                packed = ids.tobytes()
                out += [packed[a:b] for a, b in zip([0, *stops], stops)]
            return out

        return letters

    def whole(self, text: str) -> bytes:
        return array("H", self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    def has_added(self, text: str) -> bool:
        """Whether the string of an added token stands in the text."""
        return any(x in text for x in self._added)

    def with_added(self, text: str) -> bytes:
        """The text's ids as the library gives them by itself: the strings of added tokens are those tokens."""
        self._tokenizer.encode_special_tokens = False
        try:
            return self.whole(text)
        finally:
            self._tokenizer.encode_special_tokens = True

    def many(self, chunks: list[str], size: int = 4_000) -> list[bytes]:
        out = []
        for k in range(0, len(chunks), size):
            some = chunks[k : k + size]
            spaced = [x if x[0] in " \n" else "\n" + x for x in some]
            ids = np.array(self._tokenizer.encode_batch_fast(["".join(spaced)], add_special_tokens=False)[0].ids, "<u2")
            ends = np.cumsum(list(map(len, map(str.encode, spaced))))
            stops = np.searchsorted(np.cumsum(self._bytes[ids]), ends) + 1
            packed = ids.tobytes()
            starts = [0, *stops[:-1].tolist()]
            out += [packed[2 * (a + (x is not y)) : 2 * b] for a, b, x, y in zip(starts, stops.tolist(), some, spaced)]
        return out

    @classmethod
    def of_worker(cls, content: str) -> _Encoder:
        if (key := hash(content)) not in cls._built:
            cls._built = {key: cls(content)}
        return cls._built[key]

    def encode(self, texts: list[str], added_tokens: bool) -> list[bytes]:
        """Bytes of each text's ids, in order. Texts with an added token's string don't go by chunks if it counts as the token."""
        apart = {k for k, x in enumerate(texts) if self.has_added(x)} if added_tokens else set()
        found = self._cache.encode([x for k, x in enumerate(texts) if k not in apart] if apart else texts)
        for k in sorted(apart):
            found.insert(k, self.with_added(texts[k]))
        return found


def write_token_shards(docs: DataFrame, tokenizer_file: str, path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES, shard_tokens: int = SHARD_TOKENS, added_tokens: bool = True) -> None:
    """Encodes every row, appends the end id, and writes shards in ascending id order under ``path``.

    Rows are dealt out by ranges of the id, before encoding, and sorted within a range; null ids come
    first. A null text counts as empty and holds the end id alone. Repeated rows are kept. Ids must be
    integers; the tokenizer's ids must be below 65,536. Other columns are left out. An empty table writes
    no shard. The string of an added token, such as <|endoftext|>, is that token, as the library has it by
    default; without ``added_tokens`` it is ordinary text.
    """
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as f:
        content = spark.sparkContext.broadcast(f.read())
    docs = docs.select(F.col(id_col).cast("bigint").alias("i"), F.col(text_col).alias("t"))
    total = docs.select(F.sum(F.octet_length("t"))).first()[0] or 0

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, piece, encoder = TaskContext.get().partitionId(), 0, _Encoder.of_worker(content.value)
        end, doc_ids, ids, size = np.array([end_id], "<u2").tobytes(), [], [], 0

        def shard() -> pa.RecordBatch:
            lengths = np.array([len(x) // 2 for x in ids], "<u4")
            planes, ranks = WaveletMatrix.build(np.frombuffer(b"".join(ids), "<u2"))
            known = np.array([x is not None for x in doc_ids])
            row = {"part": part, "piece": piece, "n_docs": len(ids), "n_tokens": int(lengths.sum()), "doc_ids": np.array([x or 0 for x in doc_ids], "<i8").tobytes(), "has_id": np.packbits(known, bitorder="little").tobytes(), "lengths": lengths.tobytes(), "planes": planes, "ranks": ranks}
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([("part", pa.int32()), ("piece", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.binary()), ("has_id", pa.binary()), ("lengths", pa.binary()), ("planes", pa.list_(pa.binary())), ("ranks", pa.list_(pa.binary()))]))

        for batch in batches:
            for at in range(0, batch.num_rows, 5000):
                rows = batch.slice(at, 5000)
                new = [x + end for x in encoder.encode([x or "" for x in rows.column(1).to_pylist()], added_tokens)]
                doc_ids += rows.column(0).to_pylist()
                ids += new
                size += sum(map(len, new)) // 2
                if size >= shard_tokens:
                    yield shard()
                    piece, doc_ids, ids, size = piece + 1, [], [], 0
        if ids:
            yield shard()

    n = max(1, -(-total // shard_bytes))
    (docs.repartitionByRange(n, "i").sortWithinPartitions("i").mapInArrow(build, SHARD_SCHEMA)
         .write.option("compression", "zstd").parquet(path))


def read_token_shards(spark, path: str) -> DataFrame:
    """The shards under ``path``, one row each."""
    return spark.read.schema(SHARD_SCHEMA).parquet(path)


def read_documents(spark, path: str, digest: bool = False) -> DataFrame:
    """Documents of the shards: (doc_id, start, n_tokens, ids binary or ids_crc32), from the files alone.

    ``start`` counts the ids of all documents before, over all shards; the place of a shard is a running
    sum over the shards' totals. Ids are little-endian unsigned 32-bit integers.
    """
    shards = read_token_shards(spark, path)
    totals = shards.select("part", "piece", "n_tokens").orderBy("part", "piece").toArrow()
    first = np.cumsum([0, *totals.column("n_tokens").to_pylist()])[:-1]
    # a table of known size, so Spark sends it to all executors only while it is small
    places = spark.createDataFrame(totals.drop_columns("n_tokens").append_column("_first", pa.array(first, pa.int64())))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {k: v[0] for k, v in batch.slice(at, 1).to_pydict().items()}
                lengths, n = np.frombuffer(row["lengths"], "<u4").astype(np.int64), row["n_docs"]
                values = WaveletMatrix(row["n_tokens"], row["planes"], row["ranks"]).to_numpy()
                stops = np.cumsum(lengths)
                doc_ids = pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=~np.unpackbits(np.frombuffer(row["has_id"], np.uint8), count=n, bitorder="little").view(bool))
                cut = [values[a:b].astype("<u4") for a, b in zip((stops - lengths).tolist(), stops.tolist())]
                last = pa.array(map(zlib.crc32, cut), pa.int64()) if digest else pa.array([x.tobytes() for x in cut], pa.binary())
                same = [pa.array(np.full(n, row[k]), pa.int32()) for k in ("part", "piece")]
                yield pa.RecordBatch.from_arrays([*same, doc_ids, pa.array(stops - lengths), pa.array(lengths), last], names=["part", "piece", "doc_id", "_at", "n_tokens", "ids"])

    docs = shards.mapInArrow(unpack, f"part int, piece int, doc_id bigint, _at bigint, n_tokens bigint, ids {'bigint' if digest else 'binary'}")
    return docs.join(places, ["part", "piece"]).select("doc_id", (F.col("_first") + F.col("_at")).alias("start"), "n_tokens", F.col("ids").alias("ids_crc32" if digest else "ids"))


def count_token(spark, path: str, token: int) -> DataFrame:
    """(part, piece, n): how often the id stands in each shard, by rank."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = WaveletMatrix(row["n_tokens"], row["planes"], row["ranks"]).rank(token, row["n_tokens"])
                yield pa.RecordBatch.from_pydict({"part": pa.array([row["part"]], pa.int32()), "piece": pa.array([row["piece"]], pa.int32()), "n": pa.array([n], pa.int64())})

    return read_token_shards(spark, path).mapInArrow(count, "part int, piece int, n bigint")


def find_token(spark, path: str, token: int) -> DataFrame:
    """(part, piece, position): every place of the id in each shard, by select."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                matrix = WaveletMatrix(row["n_tokens"], row["planes"], row["ranks"])
                for lo in range(0, n := matrix.rank(token, matrix.n), 10_000):
                    at = matrix.select_many(token, np.arange(lo, min(n, lo + 10_000)))
                    same = [pa.array([row[k]] * len(at), pa.int32()) for k in ("part", "piece")]
                    yield pa.RecordBatch.from_arrays([*same, pa.array(at, pa.int64())], names=["part", "piece", "position"])

    return read_token_shards(spark, path).mapInArrow(find, "part int, piece int, position bigint")


def encode_and_read(docs: DataFrame, tokenizer_file: str, end_id: int = 0, path: str | None = None, **columns) -> DataFrame:
    """Writes shards (under a new shared path if none is given) and reads the documents' digests back."""
    path = path or new_path(docs.sparkSession, "token-shards")
    write_token_shards(docs, tokenizer_file, path, end_id, **columns)
    return read_documents(docs.sparkSession, path, digest=True)
