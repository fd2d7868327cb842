"""Near-duplicates by MinHash with tensored banding, verified on full shingle sets.

Two small collections of minhash bands are computed, m bands each. A table key joins a band of the first
with a band of the second, so m * m tables cost 2 * m bands of minhashes instead of m * m. Documents of
equal shingle sets are one class and only its smallest id goes on. Within a table key, members are first
held against one pivot and connected components of the verified links are formed. Keys whose members then
still belong to several components are taken up again, and only they. Those with many members are held against
hubs, as long as that halves their rows. Then documents meet under the table key, in blocks of bounded size, and every
pair across components is verified under the first key that it shares, but for pairs that exact bounds from sizes,
shingles and sketches rule out. In a large key only members outside its main component that can still be linked go to several
blocks, so near copies of one text cost rows in proportion to their number. No key is capped and no pair that shares a
key and can be linked is passed over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.hashing import BASE, BYTE, INVERSE, MUL, mix, powers
from sluice.llm.rowkeys import free_name, with_ids, with_keys
from sluice.llm.storage import written

#: Bands in each collection and minhashes in a band: a pair at similarity 0.85 shares no key with
#: probability 7e-5, at 0.8 with 5e-4.
BANDS, ROWS = 8, 2
#: Members that one task holds against a pivot.
PIVOT_MEMBERS = 256
#: Bins of the sketch (a power of two).
BINS = 512
#: Members of a block when documents of one table key are compared with each other.
BLOCK = 384

_SHORT, _ALL = int(MUL[11]), (1 << 64) - 1
_LOW = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])


def shingle_sets(texts: list[bytes], width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of all texts, one after another, and how many each has."""
    sizes = np.array([len(t) + 1 for t in texts])
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    begin = np.cumsum(sizes) - sizes
    letter = ~_SPACE[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], letter]).astype(np.int8)))
    starts, stops = edges[::2], edges[1::2]
    sums = np.concatenate([[np.uint64(0)], np.cumsum(BYTE[_LOW[data]] * powers(BASE, len(data)), dtype=np.uint64)])
    down = powers(INVERSE, len(data))
    words = mix((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(np.uint64))
    which = np.searchsorted(begin, starts, "right") - 1
    count = np.bincount(which, minlength=len(texts))
    n = len(words) - width + 1
    if n > 0:
        h = words[:n].copy()
        for k in range(1, width):
            h = h * MUL[10] + words[k : n + k]
        good = which[:n] == which[width - 1 :]
        h, doc = mix(h[good]), which[:n][good]
    else:
        h, doc = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        first, extra = np.cumsum(count) - count, []
        for d in short.tolist():
            x = int(count[d])
            for w in words[first[d] : first[d] + count[d]].tolist():
                x = (x * _SHORT + w) & _ALL
            extra.append(x)
        h, doc = np.concatenate([h, mix(np.array(extra, np.uint64))]), np.concatenate([doc, short])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], np.bincount(doc[new], minlength=len(texts))


def band_values(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each set (starting at ``first`` in h, none empty) the bands of both collections."""
    out = []
    for band in range(2 * BANDS):
        value = np.full(len(first), band + 1, np.uint64)
        for row in range(ROWS):
            value = mix(value * MUL[12] + np.minimum.reduceat(h * MUL[16 + band * ROWS + row], first))
        out.append(value)
    return np.stack(out, 1).view(np.int64)


def sketches(h: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """One byte of the least hash in each bin of the hash range, 0 for an empty bin; h is in order."""
    bins = (h >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    new = np.ones(len(h), bool)
    new[1:] = (bins[1:] != bins[:-1]) | (owner[1:] != owner[:-1])
    out = np.zeros((n, BINS), np.uint8)
    out[owner[new], bins[new]] = (mix(h[new]) % np.uint64(255) + np.uint64(1)).astype(np.uint8)
    return out


def _slices(batch: pa.RecordBatch, column: int, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of about ``size`` bytes of the column."""
    lengths = pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(np.int64)
    cuts = np.flatnonzero(np.diff(np.cumsum(lengths) // size)) + 1
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
        if hi > lo:
            yield batch.slice(lo, hi - lo)


def _signatures(width: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, 1):
                h, n = shingle_sets(part.column(1).to_pylist(), width)
                some = np.flatnonzero(n)
                first = (np.cumsum(n) - n)[some]
                d1, d2, bands, marks = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64), [None] * len(n), [None] * len(n)
                if len(some):
                    d1[some], d2[some] = (np.add.reduceat(mix(h * MUL[k]), first).view(np.int64) for k in (6, 7))
                    owner = np.repeat(np.arange(len(some)), n[some])
                    for i, row, mark in zip(some.tolist(), band_values(h, first), sketches(h, owner, len(some))):
                        bands[i], marks[i] = row, mark.tobytes()
                none = n == 0
                cols = [part.column(0), pa.array(n, pa.int64()), pa.array(d1, mask=none), pa.array(d2, mask=none), pa.array(bands, pa.list_(pa.int64())), pa.array(marks, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=["doc", "n", "d1", "d2", "bands", "sketch"])

    return sign


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        for part in _slices(batch, 1):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([pack.compress(x) for x in part.column(1).to_pylist()], pa.binary())], names=["doc", "data"])


def _verify(width: int, num: int, den: int):
    """Rows (pivot, salt, doc, data) in order, the pivot's own row first in each group, to links."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, pivot, own = zstandard.ZstdDecompressor(), None, None
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                rows = batch.slice(at, 200).to_pylist()
                h, n = shingle_sets([unpack.decompress(r["data"]) for r in rows], width)
                links = []
                for r, x in zip(rows, np.split(h, np.cumsum(n)[:-1])):
                    if not r["member"]:
                        pivot, own = r["pivot"], x
                    elif pivot == r["pivot"]:
                        place = np.searchsorted(own, x)
                        place[place == len(own)] = 0
                        both = int((own[place] == x).sum())
                        if den * both >= num * (len(own) + len(x) - both):
                            links.append((min(pivot, r["doc"]), max(pivot, r["doc"])))
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return verify


def verified_links(pairs: DataFrame, texts: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose shingle sets are similar enough; texts has doc, data.

    Members of a pivot a are dealt out over groups of bounded size, each with the pivot's text.
    """
    groups = pairs.groupBy("a").count().select(F.col("a").alias("pivot"), F.ceil(F.col("count") / PIVOT_MEMBERS).cast("int").alias("parts"))
    members = (pairs.select(F.col("a").alias("pivot"), F.col("b").alias("doc")).join(groups, "pivot")
               .select("pivot", F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int").alias("salt"), "doc", F.lit(True).alias("member")))
    pivots = groups.select("pivot", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"), F.col("pivot").alias("doc"), F.lit(False).alias("member"))
    rows = members.unionByName(pivots).join(texts, "doc").select("pivot", "salt", "doc", "member", "data")
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "pivot", "salt").sortWithinPartitions("pivot", "salt", "member").mapInArrow(_verify(width, num, den), "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """(id, label) of every linked id; label is the smallest id that can be reached.

    Labels of neighbours and labels of labels are taken in turn until nothing changes, each step a
    written table; no component ever comes together in one task or on the driver.
    """
    both = written(links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a")).distinct(), "links")
    labels = written(both.groupBy(F.col("u").alias("id")).agg(F.least(F.min("v"), F.col("u")).alias("label")), "labels")
    total = lambda df: df.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
    now = total(labels)
    while now is not None:
        near = both.join(labels, both.u == labels.id).groupBy("v").agg(F.min("label").alias("near"))
        step = written(labels.join(near, labels.id == near.v).select("id", F.least("label", "near").alias("label")), "labels")
        up = step.select(F.col("id").alias("up"), F.col("label").alias("top"))
        labels = written(step.join(up, step.label == up.up).select("id", F.col("top").alias("label")), "labels")
        before, now = now, total(labels)
        if before == now:
            break
    return labels


def may_link(n: np.ndarray, m: int, marks: np.ndarray, mark: np.ndarray, num: int, den: int) -> np.ndarray:
    """Which sets (sizes n, sketches marks) can reach similarity num / den with one set (m, mark); exact, no linked pair is ruled out.

    Bins of unequal marks have unequal least hashes, the smaller of which is in one set only. So the sets differ by at
    least as many elements as there are such bins, and by the difference of their sizes.
    """
    apart = np.maximum((marks != mark).sum(1), np.abs(n - m))
    return (num + den) * apart <= (den - num) * (n + m)


def _block_pairs(num: int, den: int):
    """Rows (table, key, lo, hi, doc, n, label, block, bands, sketch) in order of the first four to pairs (a, b)."""

    def compare(rows: list[dict], lo: int, hi: int, table: int) -> pa.RecordBatch:
        sides = [[r for r in rows if r["block"] == x] for x in (lo, hi)]
        out = ([], [])
        if sides[0] and sides[1]:
            docs, counts, labels, bands, marks = zip(*((np.array([r["doc"] for r in s]), np.array([r["n"] for r in s]), np.array([r["label"] for r in s]), np.array([r["bands"] for r in s]), np.frombuffer(b"".join(bytes(r["sketch"]) for r in s), np.uint8).reshape(-1, BINS)) for s in sides))
            for k in range(len(docs[0])):
                cand = labels[1] != labels[0][k]
                if lo == hi:
                    cand[: k + 1] = False
                at = np.flatnonzero(cand)
                shared = bands[1][at] == bands[0][k]
                one, two = shared[:, :BANDS], shared[:, BANDS:]
                at = at[one.any(1) & two.any(1) & (np.argmax(one, 1) * BANDS + np.argmax(two, 1) == table)]
                at = at[may_link(counts[1][at], counts[0][k], marks[1][at], marks[0][k], num, den)]
                out[0].extend(np.minimum(docs[1][at], docs[0][k]).tolist())
                out[1].extend(np.maximum(docs[1][at], docs[0][k]).tolist())
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["a", "b"])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                for r in batch.slice(at, 500).to_pylist():
                    group = (r["table"], r["key"], r["lo"], r["hi"])
                    if group != now and held:
                        yield compare(held, now[2], now[3], now[0])
                        held = []
                    now = group
                    held.append(r)
        if held:
            yield compare(held, now[2], now[3], now[0])

    return pairs


def open_members(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """(table, key, doc, label, size) of the keys whose members have several labels; size is the key's number of members."""
    label = labels.select(F.col("id").alias("doc"), "label")
    labelled = buckets.select("table", "key", "doc").join(label, "doc", "left").select("table", "key", "doc", F.coalesce("label", "doc").alias("label"))
    ends = labelled.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("key", "size")
    return written(labelled.join(ends, "key"), "open")


def hub_pairs(large: DataFrame) -> DataFrame:
    """(a, b): the hub a of each key and every member b of another label. A hub is the member that meets most others, over all its keys."""
    met = large.groupBy("doc").agg(F.sum("size").alias("met"))
    hubs = large.join(met, "doc").groupBy("key").agg(F.max(F.struct("met", "doc", "label")).alias("hub"))
    return large.join(hubs, "key").where(F.col("label") != F.col("hub.label")).select(F.col("hub.doc").alias("a"), F.col("doc").alias("b")).distinct()


def _shingles(width: int):
    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                h, n = shingle_sets([unpack.decompress(x) for x in part.column(1).to_pylist()], width)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(np.repeat(np.arange(len(n)), n))), pa.array(h.view(np.int64))], names=["doc", "h"])

    return shingles


def linkable(large: DataFrame, signed: DataFrame, texts: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """(doc, n, most) of the members that can be linked with any other; exact, no linked pair is ruled out.

    ``most`` counts the shingles that stand in another member too: no overlap is larger, and the other set is as large as the overlap at least.
    """
    docs = large.select("doc").distinct()
    shingles = texts.join(docs, "doc", "left_semi").select("doc", "data").mapInArrow(_shingles(width), "doc bigint, h bigint")
    alone = shingles.groupBy("h").agg(F.count(F.lit(1)).alias("k"), F.min("doc").alias("doc")).where("k = 1").groupBy("doc").agg(F.count(F.lit(1)).alias("alone"))
    sizes = signed.select("doc", "n").join(docs, "doc", "left_semi").dropDuplicates(["doc"])
    return sizes.join(alone, "doc", "left").select("doc", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("most")).where(den * F.col("most") >= num * F.col("n"))


def meetings(members: DataFrame, signed: DataFrame, texts: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """(table, key, lo, hi, doc, label, block): which documents of a key meet, those of block lo with those of block hi.

    The members of a key of bounded size are one block. In a larger key, members that can't be linked are left out, and only those
    that haven't the key's most frequent label ask (of two labels, one at least asks). The others are dealt out over blocks by
    size, and a member asks the blocks that hold a size with which its overlap can be large enough.
    """
    place = ["table", "key", "lo", "hi", "doc", "label", "block"]
    zero = F.lit(0).cast("bigint")
    small = members.where(F.col("size") <= BLOCK).select("table", "key", zero.alias("lo"), zero.alias("hi"), "doc", "label", zero.alias("block"))
    large = members.where(F.col("size") > BLOCK).drop("size")
    if large.isEmpty():
        return small
    rest = written(large.join(linkable(large, signed, texts, width, num, den), "doc").withColumn("step", F.floor(F.log("n") * 50)), "rest")
    tops = rest.groupBy("key", "label").count().groupBy("key").agg(F.max(F.struct("count", "label")).alias("top")).select("key", F.col("top.label").alias("top"))
    steps = rest.groupBy("key", "step").agg(F.min("n").alias("least"), F.max("n").alias("greatest"), F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
    fits = ((num + den) * F.col("most") >= num * (F.col("n") + F.col("least"))) & (den * F.col("greatest") >= num * F.col("n")) & (den * F.col("n") >= num * F.col("least"))
    asking = written(rest.join(tops, "key").where("label != top").drop("step", "top").join(steps, "key").where(fits), "asking")
    asked = asking.groupBy("key", "step", "parts").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("chunks"))
    within = lambda column: F.pmod(F.xxhash64("doc"), F.col(column))
    spread = lambda column: F.explode(F.sequence(F.lit(0), F.col(column) - 1))
    number = lambda part: F.shiftleft("step", 32) + part
    ask = asking.join(asked.drop("parts"), ["key", "step"]).withColumn("lo", -1 - within("chunks")).withColumn("part", spread("parts")).withColumn("hi", number(F.col("part"))).withColumn("block", F.col("lo"))
    answer = rest.join(asked, ["key", "step"]).withColumn("chunk", spread("chunks")).withColumn("lo", (-1 - F.col("chunk")).cast("bigint")).withColumn("hi", number(within("parts"))).withColumn("block", F.col("hi"))
    return small.unionByName(ask.select(place)).unionByName(answer.select(place))


def pairs_across(members: DataFrame, signed: DataFrame, texts: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """(a, b) of all documents of different labels that share a table key and may be linked.

    ``members`` has table, key, doc, label, size: the members of keys with several labels. They meet in blocks of bounded
    size; a pair is taken up under the first key that it shares.
    """
    facts = signed.select("doc", "n", "bands", "sketch").join(members.select("doc").distinct(), "doc", "left_semi").dropDuplicates(["doc"])
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = meetings(members, signed, texts, width, num, den).join(facts, "doc")
    return rows.repartition(parts, "table", "key", "lo", "hi").sortWithinPartitions("table", "key", "lo", "hi", "doc").mapInArrow(_block_pairs(num, den), "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, threshold: tuple[int, int] = (4, 5)) -> DataFrame:
    """One row for each document: (id, n_shingles, component_id, kept).

    Words are runs of characters other than ASCII white space, A-Z lower-cased; a set holds the distinct
    ``width``-word shingles, or the whole sequence of a shorter text. Two documents are linked if their
    sets' similarity is threshold[0] / threshold[1] at least, judged on the full sets. component_id is the
    smallest id that can be reached by links. Null and wordless texts have empty sets, are linked with
    nothing and kept. Rows with a null id are kept, without component. Equal rows count as one document; different texts
    of one id are documents of their own (of which all but one come behind all ids in order, see rowkeys). Ids must be
    integers. Other columns aren't read.
    """
    key = free_name(docs)
    keyed, keys = with_keys(docs, id_col, text_col, key)
    found = with_ids(_judged(keyed, key, text_col, width, *threshold), ["doc", "component_id"], keys)
    return found.select(F.col("doc").alias(id_col), "n_shingles", "component_id", "kept")


def _judged(docs: DataFrame, key_col: str, text_col: str, width: int, num: int, den: int) -> DataFrame:
    """(doc, n_shingles, component_id, kept) by key."""
    plain = docs.select(F.col(key_col).alias("doc"), F.coalesce(F.encode(F.col(text_col), "UTF-8"), F.lit(b"")).alias("data"))
    signed = written(plain.mapInArrow(_signatures(width), "doc bigint, n bigint, d1 bigint, d2 bigint, bands array<bigint>, sketch binary"), "signatures")
    classes = written(signed.where("n > 0 and doc is not null").groupBy("d1", "d2").agg(F.min("doc").alias("rep")), "classes")
    tables = F.transform(F.sequence(F.lit(0), F.lit(BANDS * BANDS - 1)), lambda k: F.xxhash64(k, F.get("bands", F.floor(k / BANDS).cast("int")), F.get("bands", BANDS + k % BANDS)))
    keys = signed.select("doc", "bands").join(classes.select(F.col("rep").alias("doc")), "doc", "left_semi").select("doc", F.posexplode(tables).alias("table", "key"))
    ends = keys.groupBy("key").agg(F.min("doc").alias("pivot"), F.max("doc").alias("other")).where("pivot < other").select("key", "pivot")
    buckets = written(keys.join(ends, "key"), "buckets")
    packed = plain.where("doc is not null").mapInArrow(_pack, "doc bigint, data binary")
    texts = written(packed.join(buckets.select("doc").distinct(), "doc", "left_semi").dropDuplicates(["doc"]), "texts")
    tested = written(buckets.where("doc > pivot").select(F.col("pivot").alias("a"), F.col("doc").alias("b")).distinct(), "pairs")
    links = written(verified_links(tested, texts, width, num, den), "links")
    labels, before = components(links), None
    members = open_members(buckets, labels)
    while (now := members.where(F.col("size") > BLOCK).count()) and (before is None or 2 * now <= before):
        hubs = hub_pairs(members.where(F.col("size") > BLOCK)).select("a", "b", F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"))
        hubs = written(hubs.join(tested.toDF("x", "y"), ["x", "y"], "left_anti"), "pairs")
        found, before = written(verified_links(hubs.select("a", "b"), texts, width, num, den), "links"), now
        tested = tested.unionByName(hubs.select(F.col("x").alias("a"), F.col("y").alias("b")))
        if found.isEmpty():
            break
        links = links.unionByName(found)
        labels = components(links)
        members = open_members(buckets, labels)
    if not members.isEmpty():
        fresh = written(pairs_across(members, signed, texts, width, num, den).join(tested, ["a", "b"], "left_anti"), "pairs")
        found = written(verified_links(fresh, texts, width, num, den), "links")
        if not found.isEmpty():
            labels = components(links.unionByName(found))
    nodes = classes.join(labels, classes.rep == labels.id, "left").select("d1", "d2", F.coalesce("label", "rep").alias("label"))
    result = signed.select("doc", "n", "d1", "d2").join(nodes, ["d1", "d2"], "left")
    component = F.when(F.col("doc").isNotNull(), F.coalesce("label", "doc"))
    return result.select("doc", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("doc"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, threshold: tuple[int, int] = (4, 5)) -> DataFrame:
    """The documents with all their columns, one of each group: the one with the smallest id.

    Equal rows stay or go together; of different texts of one id each is judged by itself. Documents without words or id all stay.
    """
    key = free_name(docs)
    keyed, _ = with_keys(docs, id_col, text_col, key)
    gone = _judged(keyed, key, text_col, width, *threshold).where("not kept").select(F.col("doc").alias(key + "gone"))
    return keyed.join(gone, F.col(key) == F.col(key + "gone"), "left_anti").drop(key)
