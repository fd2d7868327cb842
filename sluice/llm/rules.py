"""Quality rules: distribution divergence from language references, in DataFrame functions alone.

Every document gets plain measures, a histogram of character classes and one of its language's common
words. The references are the summed histograms of all documents of a language. A document is judged
by the Jensen-Shannon distance (base 2, square root) of each histogram from its language's reference, where
it is long enough for the histogram to mean something.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.storage import written

#: Common words of each language, the bins of its word histogram (the rest is one more bin).
COMMON_WORDS = {
    "de": "der die das und in zu den von ist mit sich auf für nicht ein eine".split(),
    "en": "the of and to in a is that for it with as was on be by".split(),
    "es": "de la que el en y los del se las por un para con no una".split(),
    "fr": "de la le et les des en un une du que est pour qui dans par".split(),
}
#: Bins of the character histogram, as patterns of one character; other characters are one more bin.
CHARACTER_CLASSES = ("[a-z]", "[A-Z]", "[0-9]", "[ \\t-\\r]", "[.,;:?'\"()\\-]", "[!#$%&*+/<=>@\\[\\]\\\\^_`{|}~]", "[\\u00C0-\\u024F]")
#: Distances from which a document is rejected, and the least length at which each is looked at. That of words is a share of the distance
#: at which a text without any common word lies from its language's reference.
MAX_CHARACTER_DISTANCE, LEAST_CHARACTERS = 0.3, 200
WORD_SHARE, LEAST_WORDS = 0.75, 100
WINDOW = 8

_SPACE = "[ \\t-\\r]+"


def _repeat_positions(ordered: Column) -> Column:
    """Positions of hashes that occur twice or more, from (hash, position) in order."""
    near = lambda e, k: F.coalesce(e["h"] == F.get(ordered, k)["h"], F.lit(False))
    return F.array_sort(F.array_compact(F.transform(ordered, lambda e, k: F.when(near(e, k - 1) | near(e, k + 1), e["i"]))))


def _covered(positions: Column) -> Column:
    """Words in the windows at these positions."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-WINDOW).alias("last"))
    step = lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last"))
    return F.aggregate(positions, start, step, lambda a: a["n"])


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, language, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, characters, words).

    ``characters`` and ``words`` are histograms (arrays of counts). Null text has no words.
    """
    text, language = F.coalesce(F.col(text_col), F.lit("")), F.coalesce(F.col(lang_col), F.lit(""))
    lists = F.lit(None).cast("array<string>")
    for name, words in COMMON_WORDS.items():
        lists = F.when(F.col("language") == name, F.array(*map(F.lit, words))).otherwise(lists)
    lists = F.coalesce(lists, F.array().cast("array<string>"))
    lines = lambda c: F.filter(F.split(c, "\n"), lambda x: x.rlike("[^ \\t-\\r]"))
    without = lambda pattern: F.char_length(F.regexp_replace("text", pattern, ""))
    size = F.char_length("text")
    classes = [size - without(c + "+") for c in CHARACTER_CLASSES]
    step1 = docs.select(F.col(id_col).alias("doc"), language.alias("language"), text.alias("text"), F.array_remove(F.split(text, _SPACE), "").alias("w"))
    step2 = step1.select(
        "doc", "language", F.size("w").cast("bigint").alias("n_words"), F.char_length(F.array_join("w", "")).cast("bigint").alias("word_chars"),
        (size - without("[#*$%&|<>]+")).cast("bigint").alias("n_symbols"), lines(F.col("text")).alias("lines"),
        F.array(*classes, size).alias("characters"), F.transform("w", lambda x: F.xxhash64(x)).alias("hashes"),
        F.filter(F.transform("w", lambda x: F.array_position(lists, F.lower(x)).cast("int")), lambda k: k > 0).alias("common"), lists.alias("bins"),
    )
    windows = F.when(F.col("n_words") >= WINDOW, F.transform(F.sequence(F.lit(1), F.col("n_words").cast("int") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("hashes", i, WINDOW)))).otherwise(F.array().cast("array<bigint>"))
    step3 = step2.select(
        "doc", "language", "n_words", "word_chars", "n_symbols", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.concat(F.slice("characters", 1, len(classes)), F.array(F.element_at("characters", -1) - reduce(lambda a, b: a + b, [F.get("characters", F.lit(k)) for k in range(len(classes))]))).alias("characters"),
        F.when(F.size("bins") > 0, F.concat(F.transform(F.sequence(F.lit(1), F.size("bins")), lambda k: F.size(F.filter("common", lambda x: x == k))), F.array(F.col("n_words").cast("int") - F.size("common")))).otherwise(F.array(F.col("n_words").cast("int"))).alias("words"),
        windows.alias("windows"),
    )
    found = F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    step4 = step3.withColumn("ordered", found).drop("windows")
    repeat = F.when(F.col("ordered").isNull(), F.lit(0).cast("bigint")).otherwise(_covered(_repeat_positions(F.col("ordered"))))
    return step4.withColumn("n_repeat_words", repeat).drop("ordered")


def jensen_shannon(a: Column, b: Column) -> Column:
    """Distance of two histograms of equal bins, from 0 to 1; 0 if either is empty."""
    total = lambda h: F.aggregate(h, F.lit(0.0), lambda s, x: s + x)
    shares = lambda h: F.transform(h, lambda x: x / total(h))
    term = lambda p, m: F.when(p > 0, p * F.log2(p / m)).otherwise(F.lit(0.0))
    pairs = F.zip_with(shares(a), shares(b), lambda p, q: (term(p, (p + q) / 2) + term(q, (p + q) / 2)) / 2)
    return F.when((total(a) > 0) & (total(b) > 0), F.sqrt(F.greatest(F.lit(0.0), total(pairs)))).otherwise(F.lit(0.0))


def apply_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", word_share: float = WORD_SHARE) -> DataFrame:
    """One row for each document: measures, base_failed, kept, character_distance, word_distance.

    base_failed: fewer than 20 words, or more than 30 of 100 words in repeated 8-word windows. kept: not
    base_failed and no distance over its limit where the text reaches the distance's least length. A null
    language is one language of its own; a language without a list of common words has one bin, at distance
    0. Texts are read once; the measures are written, as the references need all of them first. References
    are one row a language and meet the documents in a join. Repeated rows and null ids stay rows and count
    each time. Other columns aren't read. References are summed over the rows that pass the base rules, so that junk doesn't set the
    measure; a language without such rows has no reference, and all its rows fail. The limit of the word distance is ``word_share`` of
    the distance that a text without any common word has from its language's reference.
    """
    measured = written(measures(docs, id_col, text_col, lang_col), "measures")
    wide = max(map(len, COMMON_WORDS.values())) + 1
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    sums = lambda c, n: F.array(*[F.coalesce(F.sum(F.when(~failed, F.get(c, F.lit(k)).cast("double"))), F.lit(0.0)) for k in range(n)])
    references = measured.groupBy("language").agg(sums("characters", len(CHARACTER_CLASSES) + 1).alias("r_characters"), sums("words", wide).alias("r_words"), F.max(F.size("words")).alias("bins"))
    bare = F.concat(F.array_repeat(F.lit(0.0), F.col("bins") - 1), F.array(F.lit(1.0)))
    references = references.withColumn("word_limit", word_share * jensen_shannon(bare, F.slice("r_words", F.lit(1), F.col("bins"))))
    n = F.size("words")
    joined = measured.join(references, "language").withColumn("r_words", F.slice("r_words", F.lit(1), n))
    as_double = lambda c: F.transform(c, lambda x: x.cast("double"))
    judged = joined.withColumn("character_distance", F.round(jensen_shannon(as_double("characters"), F.col("r_characters")), 6)).withColumn("word_distance", F.round(jensen_shannon(as_double("words"), F.col("r_words")), 6))
    odd = ((F.col("word_chars") >= LEAST_CHARACTERS) & (F.col("character_distance") > MAX_CHARACTER_DISTANCE)) | ((F.col("n_words") >= LEAST_WORDS) & (F.col("word_distance") > F.col("word_limit")))
    return judged.select(F.col("doc").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & ~odd).alias("kept"), "character_distance", "word_distance")
