"""Document likelihood over all segmentations of its words.

The lattice of a word has the pieces of an existing subword vocabulary, as byte strings (a leading space
marks the start of a word; single bytes are pieces too, so every word has a segmentation), and, for a word of
the training texts, one edge over the whole word. The vocabulary's own scores weight the pieces: they are ranks, and
rank r has weight 1 / (r + 10). A text's probability is the sum over the classes of texts, such as languages, whatever
its own is, of the product over its words and its end; a word's is the sum over its segmentations, by the
forward recursion in log space.

Three things are learned from the training rows: how often each piece is expected in the distinct training words under
the vocabulary's weights, which is added to these weights as to a prior; the relative frequency of each
whole-word edge in each class; and the chance of a new word in each class (words seen once among all tokens), which
is the share of the pieces.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.storage import written

#: The end token among the words; no word holds a newline.
END = b"\n"
#: Words whose counts and likelihoods each executor keeps; the others are joined.
COMMON_WORDS = 300_000
#: Occurrences that the vocabulary's own scores count for, in all, beside the expected ones.
PRIOR = 5_000.0
#: Bytes of a word whose edges are held at once on the way back.
_STRETCH = 1 << 14
_NONE = -1e300


def read_vocabulary(model_file: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces as bytes and their first weights, from the vocabulary's scores."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    weights: dict[bytes, float] = {bytes([b]): 1e-6 for b in range(256)}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or "▁" in piece[1:]:
            continue
        as_bytes = piece.replace("▁", " ").encode()
        weights[as_bytes] = max(weights.get(as_bytes, 0.0), 1.0 / (10.0 + max(0.0, -model.get_score(i))))
    pieces = sorted(weights)
    return pieces, np.array([weights[p] for p in pieces])


class Lattice:
    """Forward and backward recursions over all segmentations of a word, position by position, in log space.

    An Aho-Corasick automaton of the pieces gives the edges that end at each byte, so a word costs as much as it has
    edges, and memory for one number a byte, however long it is.
    """

    def __init__(self, pieces: list[bytes], log_p: np.ndarray):
        self.n, self._longest, self._edges = len(pieces), max(map(len, pieces)), ahocorasick.Automaton()
        for k, (piece, weight) in enumerate(zip(pieces, np.asarray(log_p, float).tolist())):
            self._edges.add_word(piece.decode("latin-1"), (len(piece), weight, k))  # one character a byte
        self._edges.make_automaton()

    def _forward(self, text: str) -> list[float]:
        """Log probability of each prefix."""
        alpha = [0.0] + [_NONE] * len(text)
        for at, (size, weight, _) in self._edges.iter(text):
            alpha[at + 1] = _add(alpha[at + 1], alpha[at + 1 - size] + weight)
        return alpha

    def log_likelihood(self, words: list[bytes]) -> np.ndarray:
        """Natural log of each word's probability, all segmentations together."""
        return np.array([self._forward(" " + w.decode("latin-1"))[-1] for w in words], float)

    def expected_counts(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """How often each piece is expected in the words, counted as often as given."""
        out = [0.0] * self.n
        for word, count in zip(words, counts.tolist()):
            text = " " + word.decode("latin-1")
            alpha, beta = self._forward(text), [_NONE] * len(text) + [0.0]
            for lo in range((len(text) - 1) // _STRETCH * _STRETCH, -1, -_STRETCH):
                for at, (size, weight, k) in reversed(self._ends_within(text, lo)):
                    rest = beta[at + 1] + weight
                    out[k] += count * math.exp(min(0.0, alpha[at + 1 - size] + rest - alpha[-1]))
                    beta[at + 1 - size] = _add(beta[at + 1 - size], rest)
        return np.array(out)

    def _ends_within(self, text: str, lo: int) -> list[tuple[int, tuple[int, float, int]]]:
        """Edges that end in a stretch of the text, so that a long word's edges are never all held."""
        if len(text) <= _STRETCH:
            return list(self._edges.iter(text))
        begin = max(0, lo - self._longest)
        return [(begin + at, edge) for at, edge in self._edges.iter(text[begin : lo + _STRETCH]) if begin + at >= lo]


def _add(a: float, b: float) -> float:
    """log(exp(a) + exp(b))."""
    if a < b:
        a, b = b, a
    return a + math.log1p(math.exp(b - a)) if b - a > -40.0 else a


def _words(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[int, Counter] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for k, found in counts.items():
            yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()), pa.array(np.full(len(found), k), pa.int32()), pa.array(found.values(), pa.int64())], names=["word", "k", "c"])

    for batch in batches:
        for lo in range(0, batch.num_rows, 500):
            part = batch.slice(lo, 500)
            for k, text in zip(*(c.to_pylist() for c in part.columns)):
                found = counts.setdefault(k, Counter())
                found.update(_words(text))
                found[END] += 1
            if sum(map(len, counts.values())) > 400_000:
                yield from out()
                counts.clear()
    yield from out()


def word_counts(texts: DataFrame, n_classes: int = 1) -> DataFrame:
    """(word binary, c, c0 ..) over all rows of (k, text): counts in all and in each class; a row adds one END."""
    rows = texts.select("k", F.encode("text", "UTF-8").alias("t")).mapInArrow(_count, "word binary, k int, c bigint")
    each = [F.coalesce(F.sum(F.when(F.col("k") == k, F.col("c"))), F.lit(0)).alias(f"c{k}") for k in range(n_classes)]
    return rows.groupBy("word").agg(F.sum("c").alias("c"), *each)


def train(counts: DataFrame, pieces: list[bytes], weights: np.ndarray) -> tuple[np.ndarray, float]:
    """Natural-log probabilities of the pieces (first pieces of a word; further ones) and of a word's end.

    The vocabulary's weights are a prior of PRIOR occurrences; the pieces expected under them in all distinct words are
    added. Words are dealt out over all tasks; what reaches the driver is one number a piece.
    """
    spark, prior = counts.sparkSession, weights / weights.sum()
    start = spark.sparkContext.broadcast((pieces, np.log(prior)))

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, total, n = Lattice(*start.value), np.zeros(len(start.value[0])), 0
        for batch in batches:
            words = batch.column(0).to_pylist()
            total += lattice.expected_counts(words, np.ones(len(words)))
            n += len(words)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *some.tolist()], pa.int64()), pa.array([float(n), *total[some].tolist()])], names=["piece", "n"])

    words = counts.where(F.col("word") != F.lit(END)).select("word").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    sums = words.mapInArrow(expect, "piece bigint, n double").groupBy("piece").agg(F.sum("n").alias("n")).toPandas().set_index("piece")["n"]
    n_words = float(sums.pop(-1)) if -1 in sums.index else 0.0
    expected = PRIOR * prior
    expected[sums.index.to_numpy(int)] += sums.to_numpy(float)
    first = np.array([p[:1] == b" " for p in pieces])
    rest = expected[~first].sum() + n_words + 1
    return np.log(np.where(first, expected / expected[first].sum(), expected / rest)), math.log((n_words + 1) / rest)


class Mixture:
    """Log10 probabilities of words in each class, from counts and the pieces' likelihood."""

    def __init__(self, tokens: np.ndarray, once: np.ndarray, texts: np.ndarray):
        self.tokens = np.maximum(tokens, 1)
        self.new = np.where(tokens > 0, np.clip(once / self.tokens, 1e-4, 0.5), 1.0)
        self.prior = (texts + 1) / (texts.sum() + len(texts))

    def log10(self, counts: np.ndarray, pieces: np.ndarray) -> np.ndarray:
        """Rows of counts by class, natural log of the words' likelihood by pieces (-inf for the end)."""
        with np.errstate(divide="ignore"):
            whole = np.log(counts * (1 - self.new) / self.tokens)
        return np.logaddexp(whole, np.log(self.new) + pieces[:, None]) / math.log(10)


def score_documents(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", class_col: str | None = "lang", modulus: int = 7, fold: int = 2, common_words: int = COMMON_WORDS) -> DataFrame:
    """One row for each document: (id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Tokens are lower-cased (A-Z) words and one end. Rows whose crc32(id as text) mod modulus is ``fold``
    are held out of training; a null id isn't. Null text has the end alone. ``score`` is the model's log10
    probability of the text, ``base_score`` that of add-one smoothed word counts. ``class_col`` (null: a class
    of its own; None: one class for all) is read for training alone; each of its values is a class, one row of which
    reaches the driver and each of which takes one number a row, so it is meant for columns such as a language.
    Without training rows counts are 0 and the pieces keep the vocabulary's weights alone. Repeated rows stay rows
    and count each time.

    Words up to a count that ``common_words`` of them reach go with the code to every executor (a bounded
    table with exact counts); rarer ones meet their counts in a join, where each is scored once.
    """
    spark = docs.sparkSession
    held = F.coalesce(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % modulus == fold, F.lit(False))
    label = F.coalesce(F.col(class_col).cast("string"), F.lit("")) if class_col else F.lit("")
    names = sorted(r["label"] for r in docs.where(~held).select(label.alias("label")).distinct().collect()) or [""]
    k = F.array_position(F.array(*map(F.lit, names)), label).cast("int") - 1
    each = [f"c{i}" for i in range(len(names))]
    counts = written(word_counts(docs.where(~held).select(k.alias("k"), F.col(text_col).alias("text")), len(each)), "words")
    sums = counts.agg(F.sum("c").alias("n"), F.count("c").alias("v"), *[F.sum(c).alias(f"n{c}") for c in each], *[F.count(F.when(F.col(c) == 1, 1)).alias(f"o{c}") for c in each], *[F.sum(F.when(F.col("word") == F.lit(END), F.col(c))).alias(f"d{c}") for c in each]).first().asDict()
    total = lambda kind: np.array([float(sums[f"{kind}{c}"] or 0) for c in each])
    n_train, mixture = sums["n"] or 0, Mixture(total("n"), total("o"), total("d"))
    pieces, weights = read_vocabulary(model_file)
    log_p, log_stop = train(counts, pieces, weights)
    shift, least, reached = math.log10(max(1, n_train + sums["v"] + 1)), 1, 0
    for row in counts.groupBy("c").count().orderBy(F.desc("c")).toLocalIterator():
        reached += row["count"]
        if reached > common_words:
            least = row["c"] + 1
            break
    model = spark.sparkContext.broadcast((pieces, log_p, log_stop, mixture))

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(*model.value[:2])
        for batch in batches:
            words = batch.column(0).to_pylist()
            yield batch.append_column("spelled", pa.array(np.where([w == END for w in words], -np.inf, lattice.log_likelihood(words) + log_stop) if words else [], pa.float64()))

    some = counts.where(F.col("c") >= least)
    frequent = some.mapInArrow(spelled, f"word binary, c bigint, {', '.join(f'{c} bigint' for c in each)}, spelled double").toPandas()
    words = [bytes(w) for w in frequent["word"]]
    likely = mixture.log10(frequent[each].to_numpy(float), frequent["spelled"].to_numpy(float))
    common = spark.sparkContext.broadcast((words, np.log10(frequent["c"].to_numpy(float) + 1), likely))
    no_end = mixture.log10(np.zeros((1, len(each))), np.zeros(1))[0]  # an end that training hasn't seen

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, base, like = common.value
        place = dict(zip(known, range(len(known))))
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part, sums, rare, times = batch.slice(at, 500), [], [], []
                for text in part.column(3).to_pylist():
                    found = Counter(_words(text))
                    found[END] = 1
                    keys = list(found)
                    ids = np.fromiter(map(place.get, keys, repeat(-1)), np.int64, len(keys))
                    n = np.fromiter(found.values(), np.int64, len(keys))
                    new = np.flatnonzero(ids < 0).tolist()
                    rest = [keys[k] for k in new if keys[k] != END]
                    at_known = ids >= 0
                    m, ids = n[at_known], ids[at_known]
                    sums.append((n.sum(), m.sum(), base[ids] @ m, m @ like[ids] + (0.0 if END in place else no_end)))
                    rare.append(rest)
                    times.append([found[w] for w in rest])
                total, hit, b, likes = zip(*sums)
                cols = [pa.array(total, pa.int64()), pa.array(hit, pa.int64()), pa.array(b, pa.float64()), *[pa.array(c) for c in np.array(likes).T.copy()]]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], *cols, pa.array(rare, pa.list_(pa.binary())), pa.array(times, pa.list_(pa.int32()))], names=columns)

    likes = [f"l{i}" for i in range(len(each))]
    columns = ["row", "doc", "held_out", "n_tokens", "n_known", "base", *likes, "rare", "times"]
    doubles = ", ".join(f"{c} double" for c in likes)
    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc"), held.alias("held_out"), F.encode(F.col(text_col), "UTF-8").alias("t"))
    first = written(source.mapInArrow(local, f"row bigint, doc {kind}, held_out boolean, n_tokens bigint, n_known bigint, base double, {doubles}, rare array<binary>, times array<int>"), "scores")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, (_, _, stop, mix), spelled = Lattice(*model.value[:2]), model.value, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            found = batch.column(0).to_pylist()
            if len(spelled) > 200_000:  # after a sorted join, equal words come one after another
                spelled = {}
            fresh = [w for w in dict.fromkeys(found) if w not in spelled]
            spelled.update(zip(fresh, lattice.log_likelihood(fresh).tolist()))
            pieces = np.fromiter(map(spelled.__getitem__, found), float, len(found)) + stop
            n, c = batch.column(2).to_numpy(), batch.column(3).fill_null(0).to_numpy().astype(float)
            by_class = np.stack([batch.column(4 + i).fill_null(0).to_numpy() for i in range(len(each))], 1).astype(float)
            like = mix.log10(by_class, pieces) * n[:, None]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(n * (c > 0), pa.int64()), pa.array(np.log10(c + 1) * n), *[pa.array(x) for x in like.T.copy()]], names=["row", "k", "b", *likes])

    rare = first.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select(F.col("w.rare").alias("word"), "row", F.col("w.times").cast("bigint").alias("n"))
    met = rare.join(counts.where(F.col("c") < least), "word", "left").select("word", "row", "n", "c", *each)
    more = met.mapInArrow(finish, f"row bigint, k bigint, b double, {doubles}").groupBy("row").agg(F.sum("k").alias("k"), F.sum("b").alias("b"), *[F.sum(c).alias(f"more_{c}") for c in likes])
    zero = lambda c: F.coalesce(c, F.lit(0))
    joined = first.drop("rare", "times").join(more, "row", "left")
    terms = [F.col(c) + zero(F.col(f"more_{c}")) + F.lit(math.log10(p)) for c, p in zip(likes, mixture.prior)]
    joined = joined.withColumn("top", F.greatest(*terms) if len(terms) > 1 else terms[0])
    score = F.col("top") + F.log10(sum([F.pow(F.lit(10.0), t - F.col("top")) for t in terms[1:]], F.pow(F.lit(10.0), terms[0] - F.col("top"))))
    return joined.select(
        F.col("doc").alias(id_col), "held_out", "n_tokens", (F.col("n_known") + zero(F.col("k"))).alias("n_known"), F.lit(n_train).cast("bigint").alias("train_tokens"),
        (F.col("base") + zero(F.col("b")) - F.col("n_tokens") * F.lit(shift)).alias("base_score"), score.alias("score"),
    )
