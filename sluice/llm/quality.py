"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A rating has one of several ordered grades. A document has one latent score, the sum of the weights of
its hashed text features; the chance of a grade above k is logistic(score - threshold k), with the
same weights for all k and ordered thresholds. Features are folded words, the first five bytes of longer
words, and bands of shape measures (capitals, symbols, digits, repeated words, word length).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.decontaminate import _FOLD
from sluice.llm.hashing import BASE, BYTE, INVERSE, mix, powers

#: Features are hashed to 2 ** BITS weights.
BITS = 20
#: Labelled rows that a fit takes at most, chosen by a seeded hash of their id.
MAX_ROWS = 12_000
#: A document is kept from this chance of the highest grade.
KEEP_FROM = 0.5

_TABLE = np.frombuffer(_FOLD, np.uint8)
_UPPER = np.array([65 <= b <= 90 for b in range(256)])
_LETTER = np.array([65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])
_DIGIT = np.array([48 <= b <= 57 for b in range(256)])
_SYMBOL = np.array([33 <= b <= 47 and b not in b",.'-()/" or b in b":;<=>?@[]^_`{|}~\\" for b in range(256)])
_MASK = np.uint64(64 - BITS)


def document_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, feature) of the texts, in order."""
    sizes = np.array([len(t) + 1 for t in texts])
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    begin = np.cumsum(sizes) - sizes
    folded = _TABLE[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], folded != 32]).astype(np.int8)))
    starts, stops = edges[::2], edges[1::2]
    sums = np.concatenate([[np.uint64(0)], np.cumsum(BYTE[folded] * powers(BASE, len(data)), dtype=np.uint64)])
    down = powers(INVERSE, len(data))[starts]
    words = mix((sums[stops] - sums[starts]) * down)
    doc = np.searchsorted(begin, starts, "right") - 1
    long = stops - starts > 5
    heads = mix((sums[starts[long] + 5] - sums[starts[long]]) * down[long] + np.uint64(5))
    count = lambda mask: np.add.reduceat(mask, begin, dtype=np.int64)
    letters, total = count(_LETTER[data]), np.bincount(doc, minlength=len(texts))
    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
    order = np.lexsort((words, doc))
    new = np.ones(len(order), bool)
    new[1:] = (words[order][1:] != words[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    distinct = np.bincount(doc[order][new], minlength=len(texts))
    share = lambda a, b: a / np.maximum(b, 1)
    measures = [
        share(count(_UPPER[data]), letters), share(count(_SYMBOL[data]), sizes), share(count(_DIGIT[data]), sizes),
        share(np.bincount(doc[again], minlength=len(texts)), total), share(total - distinct, total) * (total > 60), share(letters, sizes * 1.0), share(letters, total) / 40,
    ]
    bands = [mix(np.minimum(24, np.floor(24 * m ** 0.5)).astype(np.uint64) + np.uint64(1000 * (k + 1))) for k, m in enumerate(measures)]
    every = np.arange(len(texts))
    feature = np.concatenate([words[order][new], heads, *bands]) >> _MASK
    owner = np.concatenate([doc[order][new], doc[long], *[every] * len(bands)])
    pair = np.unique(owner.astype(np.int64) << 32 | feature.astype(np.int64))
    return pair >> 32, pair & 0xFFFFFFFF


class OrdinalModel:
    """Weights of the hashed features and the ordered thresholds."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def score(self, n: int, doc: np.ndarray, feature: np.ndarray) -> np.ndarray:
        return np.bincount(doc, self.weights[feature], minlength=n)

    def tails(self, score: np.ndarray) -> np.ndarray:
        """Chance of a grade above k, one column for each threshold k."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -40, 40)))

    @classmethod
    def fit(cls, n: int, doc: np.ndarray, feature: np.ndarray, grade: np.ndarray, grades: int, least: int = 3, sparsity: float = 0.1, steps: int = 80) -> OrdinalModel:
        """Proximal adaptive gradient steps on the mean log loss of the cumulative links.

        Features of fewer than ``least`` rows get no weight, and small weights are drawn to 0, the more
        the fewer rows there are (by sparsity / sqrt(n)).
        """
        sparsity /= max(1, n) ** 0.5
        used = np.bincount(feature, minlength=1 << BITS)
        known = used[feature] >= least
        doc, feature = doc[known], feature[known]
        names, at = np.unique(feature, return_inverse=True)
        w, speed = np.zeros(len(names)), np.full(len(names), 1e-8)
        above = (grade[:, None] > np.arange(grades - 1)[None, :]).astype(float)
        share = np.clip(above.mean(0) if n else np.full(grades - 1, 0.5), 1e-3, 1 - 1e-3)
        theta = np.sort(-np.log(share / (1 - share)))
        theta_speed = np.full(grades - 1, 1e-8)
        for _ in range(steps if n else 0):
            p = cls(w, theta).tails(np.bincount(doc, w[at], minlength=n))
            error = (p - above) / n
            g = np.bincount(at, error.sum(1)[doc], minlength=len(names))
            speed += g * g
            rate = 0.5 / np.sqrt(speed)
            w = w - rate * g
            w = np.sign(w) * np.maximum(np.abs(w) - rate * sparsity, 0)
            gt = -error.sum(0)
            theta_speed += gt * gt
            theta = np.sort(theta - 0.3 * gt / np.sqrt(theta_speed))
        weights = np.zeros(1 << BITS)
        weights[names] = w
        return cls(weights, theta)


def rating(quality: Column, toxic: Column) -> Column:
    """Grades of the labels: 0 toxic, 1 of low quality, 2 good; null if either is null."""
    return F.when(quality.isNull() | toxic.isNull(), None).when(toxic > 0, 0).when(quality > 0, 2).otherwise(1)


def labelled_features(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, max_rows: int, seed: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Features and grades of at most max_rows labelled documents; labels has id and grade."""
    chosen = labels.where(F.col("grade").isNotNull() & F.col(id_col).isNotNull()).orderBy(F.xxhash64(F.lit(seed), id_col), id_col, "grade").limit(max_rows).select(F.col(id_col).alias("_id"), "grade")
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.encode(F.col(text_col), "UTF-8"), F.lit(b"")).alias("t")).join(F.broadcast(chosen), "_id").select("_id", "grade", "t")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 300):
                part = batch.slice(k, 300)
                doc, feature = document_features(part.column(2).to_pylist())
                lists = np.split(feature.astype(np.int32), np.searchsorted(doc, np.arange(1, part.num_rows)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([x.tobytes() for x in lists], pa.binary())], names=["_id", "grade", "f"])

    kind = docs.schema[id_col].dataType.simpleString()
    got = rows.mapInArrow(read, f"_id {kind}, grade int, f binary").toPandas().sort_values(["_id", "grade"]).head(max_rows)
    lists = [np.frombuffer(x, np.int32) for x in got["f"]]
    doc = np.repeat(np.arange(len(lists)), [len(x) for x in lists]) if lists else np.zeros(0, np.int64)
    return len(lists), doc, np.concatenate(lists) if lists else np.zeros(0, np.int32), got["grade"].to_numpy(int)


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", grades: int = 3, max_rows: int = MAX_ROWS, seed: int = 11) -> OrdinalModel:
    """A model from labels (id, grade int); rows without grade, id or document are passed over.

    The broadcast sample has max_rows rows at most; texts turn into features where they are stored and
    only those reach the driver. Without any labelled row all weights are 0 and every grade is as
    likely.
    """
    return OrdinalModel.fit(*labelled_features(docs, labels, id_col, text_col, max_rows, seed), grades)


def score_quality(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text", keep_from: float = KEEP_FROM) -> DataFrame:
    """One row for each document: (id, score, expected_grade, tail_probability, kept).

    tail_probability is the chance of the highest grade; a document is kept from ``keep_from``. One pass,
    no shuffle; the weights have a fixed size. Null and empty texts have shape features alone; repeated
    rows and null ids stay rows. Other columns aren't read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 300):
                part = batch.slice(k, 300)
                s = sent.value.score(part.num_rows, *document_features([x or b"" for x in part.column(1).to_pylist()]))
                p = sent.value.tails(s)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(s), pa.array(p.sum(1)), pa.array(p[:, -1]), pa.array(p[:, -1] >= keep_from)], names=[id_col, "score", "expected_grade", "tail_probability", "kept"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.encode(F.col(text_col), "UTF-8").alias("t")).mapInArrow(score, f"`{id_col}` {kind}, score double, expected_grade double, tail_probability double, kept boolean")


def keep_good(docs: DataFrame, model: OrdinalModel, text_col: str = "text", keep_from: float = KEEP_FROM) -> DataFrame:
    """The documents with all their columns whose chance of the highest grade reaches keep_from."""
    sent, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 300):
                part = batch.slice(k, 300)
                texts = [(x or "").encode() for x in part.column(at).to_pylist()]
                score = sent.value.score(part.num_rows, *document_features(texts))
                yield part.filter(pa.array(sent.value.tails(score)[:, -1] >= keep_from))

    return docs.mapInArrow(keep, docs.schema)
