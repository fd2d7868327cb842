"""Byte-level BPE encoding and decoding as a monoid tree reduction.

A piece of text is encoded by halves. Two encoded neighbours are joined by encoding anew a window of
tokens around the seam. The window grows until its outermost tokens are compatible with the tokens
next to them; two tokens are compatible if encoding their joined bytes gives the same two tokens. A
sequence whose neighbours are all compatible is the encoding of its bytes, so tokens outside the window
cannot change and the join is exact. Joining is associative; decoding is concatenation up the tree.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.chunks import ChunkCache

#: Sub-pieces up to this many bytes are merged directly.
LEAF_BYTES = 4
#: Fixed value: no token id of the vocabularies in use reaches it, so ids fit unsigned 32 bits.
ID_TYPE = "<u4"


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """Token bytes to rank from the content of a rank file."""
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines.splitlines() if x)}


class MonoidBpe:
    """Encodes pieces of bytes by merge ranks; decodes ids."""

    def __init__(self, ranks: dict[bytes, int], memo_limit: int = 300_000):
        self.ranks, self._limit = ranks, memo_limit
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self._halves: dict[bytes, tuple[int, ...]] = {}
        self._pairs: dict[tuple[int, int], bool] = {}
        self._windows: dict[bytes, tuple[int, ...]] = {}

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one piece; a piece that is a token is that token."""
        rank = self.ranks.get(piece)
        return (rank,) if rank is not None else self._tree(piece)

    def _tree(self, data: bytes) -> tuple[int, ...]:
        found = self._halves.get(data)
        if found is None:
            if len(data) <= LEAF_BYTES:
                found = self._merge(data)
            else:
                half = len(data) // 2
                found = self.join(self._tree(data[:half]), self._tree(data[half:]))
            if len(data) <= 16:
                if len(self._halves) > self._limit:
                    self._halves = {}
                self._halves[data] = found
        return found

    def compatible(self, a: int, b: int) -> bool:
        """Whether the two tokens stay apart when their bytes are encoded together."""
        known = self._pairs.get((a, b))
        if known is None:
            known = self._window(self.tokens[a] + self.tokens[b]) == (a, b)
            if len(self._pairs) > self._limit:
                self._pairs = {}
            self._pairs[a, b] = known
        return known

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """The encoding of the joined bytes of two encodings."""
        if not left or not right or self.compatible(left[-1], right[0]):
            return left + right
        i = j = 1
        while True:
            i, j = min(i, len(left)), min(j, len(right))
            window = self._window(b"".join([self.tokens[t] for t in left[-i:] + right[:j]]))
            firm_left = i == len(left) or self.compatible(left[-i - 1], window[0])
            firm_right = j == len(right) or self.compatible(window[-1], right[j])
            if firm_left and firm_right:
                return left[:-i] + window + right[j:]
            i, j = i + (0 if firm_left else max(1, i // 2)), j + (0 if firm_right else max(1, j // 2))

    def _window(self, data: bytes) -> tuple[int, ...]:
        """Direct merging of a few tokens' bytes; the same short windows come up again and again."""
        found = self._windows.get(data)
        if found is None:
            found = self._merge(data)
            if len(data) <= 12:
                if len(self._windows) > self._limit:
                    self._windows = {}
                self._windows[data] = found
        return found

    def _merge(self, data: bytes) -> tuple[int, ...]:
        """Merges the adjacent pair of lowest rank, the leftmost of equals, until none is left."""
        ranks = self.ranks
        if len(data) > 64:
            return self._merge_long(data)
        parts = [data[k : k + 1] for k in range(len(data))]
        best = [ranks.get(data[k : k + 2]) for k in range(len(data) - 1)]
        while True:
            low, at = None, -1
            for k, rank in enumerate(best):
                if rank is not None and (low is None or rank < low):
                    low, at = rank, k
            if low is None:
                return tuple([ranks[p] for p in parts])
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del best[at]
            if at:
                best[at - 1] = ranks.get(parts[at - 1] + parts[at])
            if at < len(best):
                best[at] = ranks.get(parts[at] + parts[at + 1])

    def _merge_long(self, data: bytes) -> tuple[int, ...]:
        """The same with a heap and links, for windows of many bytes."""
        n, ranks = len(data), self.ranks
        parts: list[bytes | None] = [data[k : k + 1] for k in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, k, 2) for k in range(n - 1) if (r := ranks.get(data[k : k + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, k, size = heapq.heappop(heap)
            m = after[k]
            if parts[k] is None or m >= n or len(parts[k]) + len(parts[m]) != size:
                continue
            parts[k], parts[m], after[k] = parts[k] + parts[m], None, after[m]
            if after[k] < n:
                before[after[k]] = k
            for a in (before[k], k):
                if a >= 0 and after[a] < n:
                    both = parts[a] + parts[after[a]]
                    if (r := ranks.get(both)) is not None:
                        heapq.heappush(heap, (r, a, len(both)))
        return tuple([ranks[p] for p in parts if p is not None])

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the ids."""
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


class TextCodec:
    """Whole texts to packed ids and back, one codec for each Python worker."""

    _built: dict[tuple[str, int], TextCodec] = {}

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.bpe, self._find = MonoidBpe(ranks), regex.compile(pattern).findall
        self._cache = ChunkCache(self._one_piece, self._pieces, lambda text: self._pieces([text])[0], limit=400_000)

    def _one_piece(self, chunks: list[str]) -> list[bytes]:
        encode = self.bpe.encode_piece
        return [array("I", encode(x.encode())).tobytes() for x in chunks]

    def _pieces(self, chunks: list[str]) -> list[bytes]:
        encode, find, out = self.bpe.encode_piece, self._find, []
        for chunk in chunks:
            ids = array("I")
            for piece in find(chunk):
                ids.extend(encode(piece.encode("utf-8", "surrogatepass")))
            out.append(ids.tobytes())
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        return self._cache.encode(texts)

    def decode(self, ids: bytes) -> bytes:
        return self.bpe.decode(np.frombuffer(ids, ID_TYPE))

    @classmethod
    def of_worker(cls, content: bytes, pattern: str) -> TextCodec:
        key = (pattern, hash(content))
        if key not in cls._built:
            cls._built = {key: cls(read_ranks(content), pattern)}
        return cls._built[key]


def encode_documents(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids binary, decoded binary) of every row; ids are little-endian unsigned 32-bit.

    The rank file has a fixed size (about 1 MB), is read by the driver and sent once to each executor.
    No shuffle. A null text counts as empty: no ids. Repeated rows and null ids stay as rows; other
    columns of the input are left out, so none can clash. Texts of any length are encoded whole.
    """
    with open(rank_file, "rb") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = TextCodec.of_worker(content.value, pattern)
        for batch in batches:
            for part in _small(batch):
                ids = codec.encode([x or "" for x in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array(map(codec.decode, ids), pa.binary())],
                    names=[id_col, "n_tokens", "ids", "decoded"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(encode, f"`{id_col}` {kind}, n_tokens bigint, ids binary, decoded binary")


def digest_documents(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row, by the same codec.

    The ids never leave the Python worker; nulls, repeats and other columns as in encode_documents.
    """
    with open(rank_file, "rb") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, sha = TextCodec.of_worker(content.value, pattern), lambda x: hashlib.sha256(x).hexdigest()
        for batch in batches:
            for part in _small(batch):
                ids = codec.encode([x or "" for x in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(map(sha, ids), pa.string()), pa.array([sha(codec.decode(x)) for x in ids], pa.string())],
                    names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(digest, f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def _small(batch: pa.RecordBatch, rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Slices of a batch, so that Python objects of few rows exist at once."""
    for k in range(0, batch.num_rows, rows):
        yield batch.slice(k, rows)
