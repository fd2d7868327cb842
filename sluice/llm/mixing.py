"""Mixing sources to target weights: whole copies of documents by pivotal dependent rounding, in DataFrame functions alone.

Every source gets a target of words, so each of its documents is due the same number of copies, target over size, which isn't whole. The
whole part is taken; the fractions are rounded together. Two documents meet, and words move from one to the other, in a random
direction with chances that leave both expectations as they are, until one of the two fractions is 0 or 1. Words are conserved in
each meeting, so a source ends within one document of its target.

Documents meet in a reduction tree: a bucket of about BUCKET documents is rounded by one group and leaves at most one open fraction, these meet in
groups of BUCKET, and so on. Inside a group the largest come first, so what stays open at the end is small where it can be; for the same
reason one bucket of documents of every source waits for the last round, in which it meets what the others have left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.storage import written

#: Documents, or open fractions, that meet in one group.
BUCKET = 512
#: Weights of sources in order, repeating.
WEIGHTS = (5, 2, 1)
#: A fraction so near to 0 or 1 is whole.
CLOSE = 1e-9
#: Equal rows that are made in one step.
RUN = 100_000


def word_count(text: Column) -> Column:
    """Number of runs of characters other than white space; 0 of null."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), "[ \\t-\\r]+"), "")).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: int = 150, cap: int = 2) -> DataFrame:
    """(source, place, source_size, target) from (source, source_size), one row a source.

    ``share`` percent of all sizes are dealt out by weight, but no source gets more than ``cap`` times its size; the rest goes to the
    others by weight. In order of size by weight the level (words for each unit of weight) is the largest of those that come out
    if all sources before are at their cap. Sources are in order of code points, null last. The table of sources is what the mix is
    configured by; it is ordered in one task.
    """
    by_name, by_level = Window.orderBy(F.asc_nulls_last("source")), Window.orderBy("ratio", "place").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    rows = sizes.withColumn("place", F.row_number().over(by_name) - 1)
    rows = rows.withColumn("weight", F.get(F.array(*map(F.lit, weights)), F.col("place") % len(weights))).withColumn("most", cap * F.col("source_size"))
    rows = rows.withColumn("ratio", F.col("most") / F.col("weight")).withColumn("total", F.sum("source_size").over(every) * share / 100)
    before = lambda c: F.coalesce(F.sum(c).over(by_level), F.lit(0))
    rows = rows.withColumn("level", (F.col("total") - before("most")) / (F.sum("weight").over(every) - before("weight")))
    target = F.least(F.col("most").cast("double"), F.max("level").over(every) * F.col("weight"))
    return rows.select("source", "place", "source_size", target.alias("target"))


def _chance(h: Column, seed: int, level: int) -> Column:
    """A number from 0 to 1 that depends on the hash, the seed and the level."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(level), h), 11) / float(1 << 53)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _meet(held: Column, x: Column, seed: int, level: int) -> Column:
    """Both with their fractions after the meeting."""
    words = lambda e: (-e["less"]).cast("double")
    whole = lambda f: F.when(f < CLOSE, F.lit(0.0)).when(f > 1 - CLOSE, F.lit(1.0)).otherwise(f)

    def moved(m: Column) -> Column:
        rises = _chance(x["h"], seed, level) < m["down"] / (m["up"] + m["down"])
        return F.array(
            held.withField("f", whole(held["f"] + F.when(rises, m["up"]).otherwise(-m["down"]) / words(held))),
            x.withField("f", whole(x["f"] - F.when(rises, m["up"]).otherwise(-m["down"]) / words(x))),
        )

    up = F.least(words(held) * (1 - held["f"]), words(x) * x["f"])  # words that may go to the one held
    down = F.least(words(held) * held["f"], words(x) * (1 - x["f"]))
    return _let(F.struct(up.alias("up"), down.alias("down")), moved)


def _reduced(rows: DataFrame, keys: list[str], seed: int, level: int) -> DataFrame:
    """(keys, held, done): the documents of each group after all have met, and at most one that is still open."""
    kind = rows.schema["e"].dataType.simpleString()
    is_open = lambda e: (e["f"] > 0) & (e["f"] < 1)
    state = lambda held, done: F.struct(held.alias("held"), done.alias("done"))

    def step(s: Column, x: Column) -> Column:
        after = lambda pair: state(F.get(F.filter(pair, is_open), 0), F.concat(s["done"], F.filter(pair, lambda e: ~is_open(e))))
        return F.when(s["held"].isNull(), state(x, s["done"])).otherwise(_let(_meet(s["held"], x, seed, level), after))

    start = state(F.lit(None).cast(kind), F.array().cast(f"array<{kind}>"))
    met = rows.groupBy(*keys).agg(F.aggregate(F.sort_array(F.collect_list("e")), start, step).alias("s"))
    return met.select(*keys, "s.held", "s.done")


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, share: int = 150, cap: int = 2, seed: int = 1,
) -> DataFrame:
    """(id, source, size, source_size, target, copies, taken), one row for each document.

    ``size`` is the number of words, ``copies`` whole, ``taken`` their product. A source's ``taken`` words differ from its target by less than
    one of its documents; copies are at most ``cap``, and on average over seeds a document's copies are target over source_size. Rows depend
    on id, source, size and seed alone, so reruns agree. Null text has no words, a null source is one of its own and the last, equal
    rows share their copies as evenly as whole copies allow; a document without words gets copies as others do, of nothing. Other columns aren't
    read. An empty table gives an empty one.
    """
    given = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source"), word_count(F.col(f"`{text_col}`")).alias("size"))
    units = written(given.groupBy("id", "source", "size").agg(F.count(F.lit(1)).alias("rows")), "sizes")
    totals = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count(F.lit(1)).alias("units"))
    named = written(source_targets(totals.select("source", "source_size"), weights, share, cap).join(totals.select(F.col("source").alias("_source"), "units"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source"), "targets")
    due = F.col("rows") * F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    placed = units.join(named.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    placed = placed.withColumn("due", due).withColumn("least", F.floor(F.col("due") + CLOSE)).withColumn("f", F.col("due") - F.col("least"))
    h = F.xxhash64(F.lit(seed), F.col("id"), F.col("size"))
    element = F.struct((-F.col("size")).alias("less"), h.alias("h"), "id", "rows", "least", "f")
    buckets = F.ceil(F.col("units") / BUCKET)
    placed = placed.select("place", element.alias("e"), F.pmod(F.xxhash64(F.lit(seed), F.lit("bucket"), h), buckets).alias("bucket"), ((F.col("f") > CLOSE) & (F.col("size") > 0)).alias("open"))
    most = named.agg(F.max(buckets)).first()[0] or 0

    done = [placed.where(~F.col("open")).select("place", "e")]
    waiting = placed.where(F.col("open") & (F.col("bucket") == 0)).select("place", "e")
    rest, level = placed.where(F.col("open") & (F.col("bucket") > 0)).select("place", "bucket", "e"), 0
    while most > 1:
        met = written(_reduced(rest, ["place", "bucket"], seed, level), "met")
        done.append(met.select("place", F.explode("done").alias("e")))
        rest = met.where("held IS NOT NULL").select("place", F.expr(f"bucket DIV {BUCKET}").alias("bucket"), F.col("held").alias("e"))
        most, level = most // BUCKET, level + 1
    last = _reduced(waiting.unionByName(rest.select("place", "e")) if level else waiting, ["place"], seed, level)
    held = F.array_compact(F.array("held"))
    chosen = F.transform(held, lambda e: e.withField("f", F.when(_chance(e["h"], seed, level + 1) < e["f"], F.lit(1.0)).otherwise(F.lit(0.0))))
    done.append(last.select("place", F.explode(F.concat("done", chosen)).alias("e")))

    rounded = done[0]
    for more in done[1:]:
        rounded = rounded.unionByName(more)
    rounded = rounded.select("place", "e.id", (-F.col("e.less")).alias("size"), "e.rows", (F.col("e.least") + F.when(F.col("e.f") > 0.5, 1).otherwise(0)).alias("all"))
    runs = rounded.withColumn("run", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(rows - 1) DIV {RUN}"))))
    each = runs.withColumn("j", F.explode(F.sequence(F.col("run") * RUN, F.least(F.col("rows"), (F.col("run") + 1) * RUN) - 1)))
    copies = F.expr("all DIV rows") + F.when(F.col("j") < F.col("all") % F.col("rows"), 1).otherwise(0)
    out = each.select("place", "id", "size", copies.cast("bigint").alias("copies")).join(named.drop("units"), "place")
    return out.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
