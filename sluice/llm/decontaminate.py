"""Benchmark decontamination with a generalised suffix automaton of the test items.

Automata of the normalised items are built on the driver, each over a bounded number of words, and one of them is
broadcast at a time. Each document streams through it word by word; the state and the length of the longest match that
ends at a word tell which windows of the items end there. A benchmark within the bound takes one pass over the
documents; a larger one takes a pass for each automaton, whose hits are written and meet their documents in a join.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.storage import written

#: Words in one automaton (some 400 bytes a word); a larger benchmark goes in several blocks, one after another.
BLOCK_WORDS = 250_000
#: What a pass over a block finds in a document: ranges of words (from, to, from, to ..) and items.
HITS = "struct<ranges:array<int>,items:array<string>>"
#: Letters to lower case, digits and everything beyond ASCII kept, all other ASCII to a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def fold_words(text: bytes) -> list[bytes]:
    """Normalised words of a UTF-8 text."""
    return text.translate(_FOLD).split()


class ItemAutomaton:
    """Generalised suffix automaton over word numbers, with the items of each window. Its size follows the words of different items, however often they repeat."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int):
        self.window, self.vocab = window, {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        texts: dict[tuple[int, ...], dict[object, None]] = {}  # items of equal words are one text
        for item, words in items:
            if words:
                texts.setdefault(tuple(self.vocab.setdefault(w, len(self.vocab)) for w in words), {})[item] = None
        for words in texts:
            last = 0
            for word in words:
                last = self._extend(last, word)
        self.shortest = min([min(len(words), window) for words in texts], default=0)
        self.members = [tuple(x) for x in texts.values()]
        self.items: list[set] = [set() for _ in self.next]
        self.ends: dict[int, list[tuple[int, int]]] = {}
        for number, words in enumerate(texts):
            self._mark(number, words)
        self._pack()

    def _pack(self) -> None:
        """Flat tables instead of one container a state; of each state the nearest one, itself or by links, at which short items end."""
        self.width = len(self.vocab)
        self.edges = {state * self.width + word: to for state, out in enumerate(self.next) for word, to in out.items()}
        self.items = {state: frozenset(x) for state, x in enumerate(self.items) if x}
        self.link, self.length, self.nearest = array("i", self.link), array("i", self.length), array("i", bytes(4 * len(self.next)))
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.nearest[state] = state if state in self.ends else self.nearest[self.link[state]]
        del self.next

    def _extend(self, last: int, word: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if word in nxt[last]:
            q = nxt[last][word]
            return q if length[q] == length[last] + 1 else self._clone(last, word, q)
        new = self._state(length[last] + 1, {}, 0)
        p = last
        while p != -1 and word not in nxt[p]:
            nxt[p][word] = new
            p = link[p]
        if p != -1:
            q = nxt[p][word]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, word, q)
        return new

    def _state(self, length: int, nxt: dict[int, int], link: int) -> int:
        self.next.append(nxt)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _clone(self, p: int, word: int, q: int) -> int:
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p != -1 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def _mark(self, number: int, words: tuple[int, ...]) -> None:
        """Notes the text at every state with one of its windows, or at the state of a short one."""
        state, size = 0, min(len(words), self.window)
        for word in words:
            state = self.next[state][word]
            s = state
            while s > 0 and self.length[s] >= size and number not in self.items[s]:
                self.items[s].add(number)
                s = self.link[s]
        if len(words) < self.window:
            s = state
            while self.length[self.link[s]] >= len(words):
                s = self.link[s]
            self.ends.setdefault(s, []).append((len(words), number))

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set]:
        """Which words stand inside an occurrence of a window; the items of these windows."""
        hit, found = np.zeros(len(words) + 1, np.int32), set()
        if not self.shortest or len(words) < self.shortest:
            return hit[:-1] > 0, found
        codes = np.fromiter(map(self.vocab.get, words, repeat(-1)), np.int64, len(words))
        edges = np.flatnonzero(np.diff(np.concatenate([[False], codes >= 0, [False]]).astype(np.int8)))
        starts, stops = edges[::2], edges[1::2]
        window, width, edges, link, length, ends, nearest = self.window, self.width, self.edges, self.link, self.length, self.ends, self.nearest
        for lo, hi in zip(*(x[stops - starts >= self.shortest].tolist() for x in (starts, stops))):
            state = size = 0
            for at, code in enumerate(codes[lo:hi].tolist(), lo + 1):
                while (to := edges.get(state * width + code)) is None and state:
                    state = link[state]
                    size = length[state]
                if to is not None:
                    state, size = to, size + 1
                if size >= window:
                    s = state
                    while length[link[s]] >= window:
                        s = link[s]
                    hit[at - window] += 1
                    hit[at] -= 1
                    found |= self.items[s]
                s = nearest[state]
                while s:
                    for short, number in ends[s]:
                        if short <= size:
                            hit[at - short] += 1
                            hit[at] -= 1
                            found.add(number)
                    s = nearest[link[s]]
        return np.cumsum(hit[:-1]) > 0, {item for number in found for item in self.members[number]}


def automata(benchmark: DataFrame, id_col: str, text_col: str, window: int, block_words: int = BLOCK_WORDS) -> Iterator[ItemAutomaton]:
    """Automata of all items, each over at most block_words words (or one longer item), built one at a time.

    Rows come to the driver partition by partition; no block waits for the whole table.
    """
    items, total = [], 0
    for row in benchmark.select(F.col(id_col).alias("i"), F.encode(F.col(text_col), "UTF-8").alias("t")).dropna().toLocalIterator():
        words = fold_words(bytes(row["t"]))
        if items and total + len(words) > block_words:
            yield ItemAutomaton(items, window)
            items, total = [], 0
        items.append((row["i"], words))
        total += len(words)
    if items:
        yield ItemAutomaton(items, window)


def _ranges(hit: np.ndarray) -> list[int]:
    return np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))).tolist()


def _with_hits(docs: DataFrame, text_col: str, blocks: Iterator[ItemAutomaton]) -> tuple[DataFrame, Broadcast | None]:
    """The documents with HITS as a last column, under a name of its own; or with nulls there and the one automaton that finds them."""
    spark, name = docs.sparkSession, "_" * (1 + max(map(len, docs.columns)))
    one, two = next(blocks, None), next(blocks, None)
    if two is None:
        return docs.withColumn(name, F.lit(None).cast(HITS)), spark.sparkContext.broadcast(one) if one else None
    row = name + "row"
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "documents")

    def marks(block: Broadcast) -> DataFrame:
        def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 500):
                    part, out = batch.slice(at, 500), []
                    for r, text in zip(*(c.to_pylist() for c in part.columns)):
                        hit, found = block.value.scan(fold_words(text or b""))
                        if found:
                            out.append((r, _ranges(hit), list(map(str, found))))
                    columns = zip(*out) if out else [[]] * 3
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.list_(pa.int32()), pa.list_(pa.string())))], names=["row", "ranges", "items"])

        return rows.select(row, F.encode(F.col(text_col), "UTF-8")).mapInArrow(mark, "row bigint, ranges array<int>, items array<string>")

    found = None
    for block in chain((one, two), blocks):
        sent = spark.sparkContext.broadcast(block)
        part = written(marks(sent), "hits")
        sent.unpersist()
        found = part if found is None else found.unionByName(part)
    hits = found.groupBy("row").agg(F.struct(F.flatten(F.collect_list("ranges")).alias("ranges"), F.flatten(F.collect_list("items")).alias("items")).alias(name))
    return rows.join(hits.withColumnRenamed("row", row), row, "left").select(*[F.col(f"`{c}`") for c in docs.columns], name), None


def _judge(text: bytes, hits: dict | None, block: Broadcast | None) -> tuple[np.ndarray, set[str]]:
    """Which words of a document are hit, and by which items."""
    words = fold_words(text)
    if block is not None:
        hit, found = block.value.scan(words)
        return hit, set(map(str, found))
    hit = np.zeros(len(words), bool)
    for lo, hi in zip(hits["ranges"][::2], hits["ranges"][1::2]) if hits else ():
        hit[lo:hi] = True
    return hit, set(hits["items"]) if hits else set()


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text", window: int = 13, share: tuple[int, int] = (1, 20), block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row for each document: (id, n_words, n_hit, n_items, items_sha256, contaminated).

    A window is ``window`` consecutive words of an item, or a shorter item whole. A document is
    contaminated if at least share[0] of share[1] of its words stand inside occurrences of windows.
    No shuffle while the benchmark fits one block. Null text has no words; items without words or id, and an
    empty benchmark, hit nothing; repeated items count once by id; repeated rows and null ids of
    documents stay as rows. Only the named columns are read, so others can't clash.
    """
    marked, block = _with_hits(docs.select(F.col(id_col).alias("i"), F.encode(F.col(text_col), "UTF-8").cast("binary").alias("t")), "t", automata(benchmark, item_id, item_text, window, block_words))
    num, den = share

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part, rows = batch.slice(at, 500), []
                for text, hits in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    hit, found = _judge(text or b"", hits, block)
                    n = int(hit.sum())
                    rows.append((len(hit), n, len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), n > 0 and den * n >= num * len(hit)))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
                cols = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([part.column(0), *cols], names=[id_col, "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    kind = docs.schema[id_col].dataType.simpleString()
    return marked.mapInArrow(scan, f"`{id_col}` {kind}, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean")


def cut_words(text: bytes, hit: np.ndarray) -> bytes:
    """The text without its hit words and what stands between neighbouring ones; every other byte stays."""
    places = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(_FOLD))]
    edges = _ranges(hit)
    cuts = [x for lo, hi in zip(edges[::2], edges[1::2]) for x in (places[lo][0], places[hi - 1][1])]
    bounds = [0, *cuts, len(text)]
    return b"".join(text[a:b] for a, b in zip(bounds[::2], bounds[1::2]))


def remove_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = 13, share: tuple[int, int] = (1, 20), spans: bool = False, length_col: str | None = None, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The documents with all their columns, without the contaminated ones.

    With ``spans`` a contaminated document stays and loses the bytes of its hit words alone (``length_col`` is set to
    its new number of characters); a document is dropped only if no word is left. Others are never touched. Null texts, null ids and
    repeated rows stay; an empty table stays empty. Columns may have any names.
    """
    marked, block = _with_hits(docs, text_col, automata(benchmark, item_id, item_text, window, block_words))
    names, at, (num, den) = docs.columns, docs.columns.index(text_col), share
    size_at = docs.columns.index(length_col) if length_col else None

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part, keep, texts = batch.slice(k, 500), [], []
                for text, hits in zip(part.column(at).to_pylist(), part.column(part.num_columns - 1).to_pylist()):
                    data = (text or "").encode()
                    hit, _ = _judge(data, hits, block)
                    n = int(hit.sum())
                    bad = n > 0 and den * n >= num * len(hit)
                    if bad and spans:
                        text = cut_words(data, hit).decode()
                    keep.append(not bad or spans and n < len(hit))
                    texts.append(text)
                cols = part.columns[:-1]
                cols[at] = pa.array(texts, cols[at].type)
                if spans and size_at is not None:
                    cols[size_at] = pa.array([len(t) if t is not None else None for t in texts], cols[size_at].type)
                yield pa.RecordBatch.from_arrays(cols, names=names).filter(pa.array(keep, pa.bool_()))

    return marked.mapInArrow(keep, docs.schema)
