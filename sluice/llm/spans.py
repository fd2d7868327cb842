"""Exact substring de-duplication: depth-limited radix sort of suffixes, most significant digit first.

Suffixes are only ordered through ``length`` bytes; suffixes still equal after the last digit are exactly
the repeated windows. The passes, each of which drops what has become unique:

1. digit one of a window is the least hash among the short grams inside it. It only depends on the
   window's bytes, and neighbouring windows mostly share it, so a run of windows travels as one row;
2. digit two of a run is the hash of all bytes that its windows cover. Runs that agree are repeats in
   full and all but the first are settled; runs alone with digit one are settled as new;
3. what is left are the first runs of different classes under one digit one: the edges of repeated
   passages. Their bytes are ordered by eight-byte digits, group by group, down to ``length`` bytes.

A key that many documents share is pre-aggregated in every task before it travels; in pass three the
windows of a very common digit one are dealt out by a further digit, so no task gets a whole hot group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.hashing import BASE, BYTE, INVERSE, MUL, mix, powers
from sluice.llm.rowkeys import free_name, with_ids, with_keys
from sluice.llm.storage import written

#: Bytes of the short grams (a power of two).
GRAM = 32
#: Runs under one first digit beyond which pass three deals out single windows.
HOT_RUNS = 4_096
#: Parts that the runs under one first digit are dealt out over when they are marked as hot.
SALTS = 64
#: Bytes of text hashed at once.
BLOCK = 1 << 19

CLASS, GONE, OPEN = 0, 1, 2
_ROW = "kind int, key bigint, sub bigint, doc bigint, at bigint, n bigint"


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position, by doubling."""
    h, size, level = BYTE[data], 1, 0
    while size < GRAM:
        h = h[:-size] * MUL[level] + h[size:]
        size, level = size * 2, level + 1
    return mix(h)


def _slide(x: np.ndarray, span: int) -> np.ndarray:
    """Least of each ``span`` neighbours."""
    size = 1
    while size * 2 <= span:
        x, size = np.minimum(x[:-size], x[size:]), size * 2
    return x if size == span else np.minimum(x[: len(x) - (span - size)], x[span - size :])


class Runs:
    """Runs of windows with one first digit, in the texts of one batch."""

    def __init__(self, length: int):
        self.length = length
        self._up, self._down = None, None

    def of(self, docs: list[tuple[int, bytes]]) -> list[np.ndarray]:
        """Columns key, sub, doc, at, n of every run."""
        out, held, size = [], [], 0
        for doc, text in docs:
            if len(text) >= self.length:
                held.append((doc, text))
                size += len(text)
                if size >= BLOCK:
                    out.append(self._block(held))
                    held, size = [], 0
        if held:
            out.append(self._block(held))
        return [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 5

    def _block(self, docs: list[tuple[int, bytes]]) -> tuple[np.ndarray, ...]:
        length = self.length
        data = np.frombuffer(b"".join(t for _, t in docs), np.uint8)
        sizes = np.array([len(t) for _, t in docs])
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        grams = gram_hashes(data)
        least = _slide(grams, length - GRAM + 1)
        n = len(least)
        if self._up is None or len(self._up) < len(grams) + 1:
            self._up, self._down = powers(BASE, len(grams) + 1), powers(INVERSE, len(grams) + 1)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(grams * self._up[: len(grams)], dtype=np.uint64)])
        turn = np.empty(n, bool)
        turn[0] = True
        np.not_equal(least[1:], least[:-1], out=turn[1:])
        turn[1:] |= grams[: n - 1] == least[:-1]  # the least gram leaves: no two windows of a run are equal
        turn[first[first < n]] = True
        starts = np.flatnonzero(turn)
        which = np.searchsorted(first, starts, "right") - 1
        last = first[which] + sizes[which] - length  # the document's last window
        stops = np.minimum(np.concatenate([starts[1:], [n]]), last + 1)
        good = stops > starts
        starts, stops, which = starts[good], stops[good], which[good]
        span = stops + (length - GRAM)  # grams start..span of the covered bytes
        sub = mix((sums[span] - sums[starts]) * self._down[starts] + (stops - starts).astype(np.uint64))
        ids = np.array([d for d, _ in docs], np.int64)
        return least[starts].view(np.int64), sub.view(np.int64), ids[which], starts - first[which], stops - starts


def _frame(kind, key, sub, doc, at, n) -> pa.RecordBatch:
    size = len(doc)
    cols = [np.full(size, kind, np.int32) if np.isscalar(kind) else kind, key, sub if sub is not None else np.zeros(size, np.int64), doc, at, n]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["kind", "key", "sub", "doc", "at", "n"])


def _runs(length: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = Runs(length)
        for batch in batches:
            for k in range(0, batch.num_rows, 1_000):
                part = batch.slice(k, 1_000)
                key, sub, doc, at, n = runs.of(list(zip(part.column(0).to_pylist(), part.column(1).to_pylist())))
                if not len(key):
                    continue
                order = np.lexsort((at, doc, sub, key))
                key, sub, doc, at, n = (x[order] for x in (key, sub, doc, at, n))
                new = np.concatenate([[True], (key[1:] != key[:-1]) | (sub[1:] != sub[:-1])])
                lead = np.flatnonzero(new)[np.cumsum(new) - 1]
                again = ~new & ((doc != doc[lead]) | (at != at[lead]))
                yield _frame(CLASS, key[new], sub[new], doc[new], at[new], n[new])
                yield _frame(GONE, mix(doc[again].view(np.uint64)).view(np.int64), None, doc[again], at[again], n[again])

    return find


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs in order of (kind, key, sub, doc, at): copies are gone, firsts of several classes stay open.

    Only the first run of a key that has one class so far is held back, whatever the size of its group.
    """
    held, last, several, lead = None, None, False, None  # last: (key, sub) of the row before
    for batch in batches:
        kind, key, sub, doc, at, n = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        passed = kind == GONE
        if passed.any():
            yield batch.filter(pa.array(passed))
            kind, key, sub, doc, at, n = (x[~passed] for x in (kind, key, sub, doc, at, n))
        if not len(key):
            continue
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (sub[1:] != sub[:-1])
        if last is not None:
            new[0] = (key[0], sub[0]) != last
        at_new = np.flatnonzero(new)
        # the class's first row, for rows that continue one
        index = np.cumsum(new) - 1
        lead_doc = np.where(index >= 0, doc[at_new[np.maximum(index, 0)]] if len(at_new) else 0, lead[0] if lead else 0)
        lead_at = np.where(index >= 0, at[at_new[np.maximum(index, 0)]] if len(at_new) else 0, lead[1] if lead else 0)
        again = ~new & ((doc != lead_doc) | (at != lead_at))
        if again.any():
            yield _frame(GONE, key[again], None, doc[again], at[again], n[again])
        lead = (int(lead_doc[-1]), int(lead_at[-1]))
        rows = np.stack([key[new], doc[new], at[new], n[new]], 1)
        if last is not None and several and len(rows) and rows[0, 0] == last[0]:
            carried = last[0]
        else:
            carried = None
        if held is not None:
            rows = np.concatenate([[held], rows])
        last = (int(key[-1]), int(sub[-1]))
        if not len(rows):
            continue
        bounds = np.flatnonzero(np.concatenate([[True], rows[1:, 0] != rows[:-1, 0]]))
        sizes = np.diff(np.concatenate([bounds, [len(rows)]]))
        many = np.repeat(sizes > 1, sizes) | (rows[:, 0] == carried if carried is not None else False)
        open_rows = rows[many]
        if len(open_rows):
            yield _frame(OPEN, open_rows[:, 0].copy(), None, open_rows[:, 1].copy(), open_rows[:, 2].copy(), open_rows[:, 3].copy())
        several = bool(many[-1])
        held = None if several else rows[-1]


def _first_windows(rows: list[tuple[int, int, int, int, bytes]], length: int) -> tuple[np.ndarray, ...]:
    """All windows of rows (key, doc, at, n, bytes), ordered digit by digit within their key.

    Returns which windows are first of their group and not, as arrays row, offset, first.
    """
    n = np.array([r[3] for r in rows])
    data = np.frombuffer(b"".join(r[4] for r in rows) + bytes(8), np.uint8)
    base = np.concatenate([[0], np.cumsum([len(r[4]) for r in rows])[:-1]])
    row = np.repeat(np.arange(len(rows)), n)
    offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = base[row] + offset
    words = np.lib.stride_tricks.as_strided(data, (len(data) - 7, 8), (1, 1))
    group = np.unique(np.array([r[0] for r in rows]), return_inverse=True)[1][row]
    alive = np.arange(len(row))
    first = np.ones(len(row), bool)
    for depth in range(0, length, 8):
        digit = words[at[alive] + min(depth, length - 8)].copy().view(np.uint64)[:, 0]
        order = np.lexsort((digit, group))
        g, d = group[order], digit[order]
        new = np.concatenate([[True], (g[1:] != g[:-1]) | (d[1:] != d[:-1])])
        label = np.cumsum(new) - 1
        more = np.bincount(label)[label] > 1
        alive, group = alive[order[more]], label[more]
        if not len(alive):
            return row, offset, first
    docs, places = np.array([r[1] for r in rows])[row[alive]], np.array([r[2] for r in rows])[row[alive]] + offset[alive]
    order = np.lexsort((places, docs, group))
    g, dd, pp, w = group[order], docs[order], places[order], alive[order]
    new = np.concatenate([[True], g[1:] != g[:-1]])
    lead = np.flatnonzero(new)[np.cumsum(new) - 1]
    first[w] = (dd == dd[lead]) & (pp == pp[lead])
    return row, offset, first


def _ranges(doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbouring windows as runs (doc, at, n)."""
    order = np.lexsort((at, doc))
    doc, at = doc[order], at[order]
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (at[1:] > at[:-1] + 1)]) if len(doc) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    stops = np.concatenate([starts[1:], [len(doc)]]) - 1
    return doc[starts], at[starts], at[stops] - at[starts] + 1 if len(starts) else at[starts]


def _order_windows(length: int, most: int = 100_000):
    """Rows (key, doc, at, n, data) in order of (key, doc, at) to runs of windows that aren't first."""

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, windows = [], 0

        def solve(rows, keep_key):
            row, offset, first = _first_windows(rows, length)
            again = ~first
            doc, at = np.array([r[1] for r in rows])[row[again]], np.array([r[2] for r in rows])[row[again]] + offset[again]
            doc, at, n = _ranges(doc, at)
            kept = []
            if keep_key is not None:  # later rows of this key still need its distinct windows
                for k in np.flatnonzero(first):
                    r = rows[row[k]]
                    if r[0] == keep_key:
                        o = int(offset[k])
                        kept.append((r[0], r[1], r[2] + o, 1, r[4][o : o + length]))
            return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(at, pa.int64()), pa.array(n, pa.int64())], names=["doc", "at", "n"]), kept

        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("key", "doc", "at", "n", "data"))):
                if windows >= most and (held[-1][0] != r[0] or windows >= 4 * most):
                    done, held = solve(held, r[0] if held[-1][0] == r[0] else None)
                    windows = len(held)
                    yield done
                held.append(r)
                windows += r[3]
        if held:
            yield solve(held, None)[0]

    return order


def repeated_runs(docs: DataFrame, packed: DataFrame, length: int = 100) -> DataFrame:
    """(doc, at, n): window starts at .. at+n-1 of the document repeat an earlier window.

    ``docs`` has doc bigint, data binary; ``packed`` the same with data compressed.
    """
    spark = docs.sparkSession
    runs = docs.mapInArrow(_runs(length), _ROW)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    settled = runs.repartition(parts, "key").sortWithinPartitions("kind", "key", "sub", "doc", "at").mapInArrow(_settle, _ROW)
    spans = written(settled.select("kind", "key", "doc", "at", "n"), "spans")
    gone = spans.where(F.col("kind") == GONE).select("doc", "at", "n")
    open_runs = spans.where(F.col("kind") == OPEN).select("key", "doc", "at", "n")
    hot = open_runs.groupBy("key").count().where(F.col("count") > HOT_RUNS).select("key", F.lit(True).alias("hot"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = open_runs.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(SALTS)).cast("int"))
    asked = (salted.join(hot, ["key", "salt"], "left").groupBy("doc")
             .agg(F.collect_list(F.struct("key", "at", "n", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("asked")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part, rows = batch.slice(at, 200), []
                for doc, data, asked in zip(*(part.column(c).to_pylist() for c in ("doc", "data", "asked"))):
                    text = unpack.decompress(data)
                    for a in sorted(asked, key=lambda a: a["at"]):
                        lo, n = a["at"], a["n"]
                        if not a["hot"]:
                            rows.append((a["key"], doc, lo, n, text[lo : lo + n + length - 1]))
                            continue
                        for p in range(lo, lo + n):
                            window = text[p : p + length]
                            rows.append((int.from_bytes(hashlib.blake2b(window, digest_size=8).digest(), "little", signed=True), doc, p, 1, window))
                cols = list(zip(*rows)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["key", "doc", "at", "n", "data"])

    pieces = packed.join(asked, "doc").mapInArrow(cut, "key bigint, doc bigint, at bigint, n bigint, data binary")
    more = pieces.repartition(parts, "key").sortWithinPartitions("key", "doc", "at").mapInArrow(_order_windows(length), "doc bigint, at bigint, n bigint")
    return gone.unionByName(more)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        for k in range(0, batch.num_rows, 500):
            part = batch.slice(k, 500)
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array([pack.compress(x) for x in part.column(part.num_columns - 1).to_pylist()], pa.binary())], names=part.schema.names)


def covered(spans: list[dict] | None, size: int, length: int) -> list[tuple[int, int]]:
    """Maximal byte ranges covered by the runs of windows."""
    out: list[tuple[int, int]] = []
    for lo, n in sorted((s["at"], s["n"]) for s in spans or ()):
        hi = min(size, lo + n + length - 1)
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def _with_spans(docs: DataFrame, id_col: str, text_col: str, length: int, rest: Column | None = None) -> DataFrame:
    """(doc, rest if given, data packed, spans) of every row with an id."""
    doc, data = F.col(id_col).cast("bigint").alias("doc"), F.coalesce(F.encode(F.col(text_col), "UTF-8"), F.lit(b"")).alias("data")
    plain = docs.where(F.col(id_col).isNotNull()).select(doc, data)
    schema = "doc bigint, data binary"
    packed = plain.mapInArrow(_pack, schema)
    found = repeated_runs(plain.where(F.octet_length("data") >= length), packed, length)
    lists = found.groupBy("doc").agg(F.collect_list(F.struct("at", "n")).alias("spans"))
    if rest is not None:
        whole = docs.where(F.col(id_col).isNotNull()).select(doc, rest.alias("rest"), data)
        packed = whole.mapInArrow(_pack, whole.schema)
    return packed.join(lists, "doc", "left")


def digest_repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: (id, n_bytes, n_removed, n_spans, kept_sha256).

    A byte is removed if a string of ``length`` bytes that covers it also starts earlier, in a smaller id
    or earlier in the same document. Null text counts as empty. Rows with a null id are judged on
    nothing: they lose no byte. Equal rows are one document, whose copies get the same spans; different texts of one
    id are documents of their own (of which all but one come behind all ids in order, see rowkeys). Ids must be integers.
    Other columns aren't read.
    """
    key = free_name(docs)
    docs, keys = with_keys(docs, id_col, text_col, key)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part, rows = batch.slice(at, 200), []
                for doc, data, spans in zip(*(part.column(c).to_pylist() for c in ("doc", "data", "spans"))):
                    text = unpack.decompress(data)
                    gone = covered(spans, len(text), length)
                    edges = [0, *(x for r in gone for x in r), len(text)]
                    kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                    rows.append((doc, len(text), len(text) - len(kept), len(gone), hashlib.sha256(kept).hexdigest()))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(),) * 4 + (pa.string(),))], names=["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    done = _with_spans(docs, key, text_col, length).mapInArrow(digest, "doc bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    text = F.coalesce(F.encode(F.col(text_col), "UTF-8"), F.lit(b""))
    size = F.octet_length(text).cast("bigint")
    without = docs.where(F.col(id_col).isNull()).select(F.lit(None).cast("bigint").alias("doc"), size.alias("n_bytes"), F.lit(0).cast("bigint").alias("n_removed"), F.lit(0).cast("bigint").alias("n_spans"), F.sha2(text, 256).alias("kept_sha256"))
    return with_ids(done, ["doc"], keys).unionByName(without).withColumnRenamed("doc", id_col)


def remove_repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """The same rows and columns, texts without their removed bytes.

    A character that loses one of its bytes goes as a whole. ``length_col`` is set to the new number of
    characters. Null texts stay null; empty results and rows with a null id stay as they are. Equal rows and different
    texts of one id count as in digest_repeats. Ids must be integers. Columns may have any names.
    """
    names, schema, key = docs.columns, docs.schema, free_name(docs)
    docs, _ = with_keys(docs, id_col, text_col, key)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            texts = []
            for data, spans in zip(*(batch.column(c).to_pylist() for c in ("data", "spans"))):
                text = unpack.decompress(data)
                edges = [0, *(x for r in covered(spans, len(text), length) for x in r), len(text)]
                texts.append("".join(text[a:b].decode("utf-8", "ignore") for a, b in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("rest")), pa.array(texts, pa.string())], names=["rest", "text"])

    keep = [c for c in names if c != text_col]
    rest = F.struct(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(text_col).isNull().alias("empty"))
    inner = docs.select(rest.alias("rest")).schema["rest"].dataType.simpleString()
    done = _with_spans(docs, key, text_col, length, rest).mapInArrow(cut, f"rest {inner}, text string")
    text = F.when(F.col("rest.empty"), F.lit(None)).otherwise(F.col("text"))
    cols = {c: F.col(f"rest.row.`{c}`") for c in keep} | {text_col: text}
    if length_col:
        cols[length_col] = F.char_length(text).cast(schema[length_col].dataType)
    done = done.select(*(cols[c].alias(c) for c in names))
    return done.unionByName(docs.where(F.col(id_col).isNull()).drop(key))
