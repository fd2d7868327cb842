"""Repair of conversations' structure: the cheapest edits that make roles alternate, by a grammar-compressed dynamic programme.

Rows become symbols (role and fault), conversations sequences of them. Edits move an automaton of the role grammar ``(s?(ua)+)?``
with four states, so a symbol is a min-plus matrix of 4 x 4 entries: least cost and, of equal costs, the least audit. Matrices multiply,
and frequent sequences recur in all conversations, so they are compressed: Re-Pair replaces frequent neighbours by rules, every
rule's matrix is made once, bottom-up, with its audits as ropes over those of its parts, and a conversation multiplies few matrices.

A conversation is never held whole. Rows are sorted by range, so one conversation may lie in many partitions; each task cuts its rows
into segments of at most SEGMENT rows. Segments' matrices are chained for a conversation (costs and ranks of audits alone), each
segment then builds its own audit and text between the states given to it, and the digest streams over them in order.

Audits are comparable part by part as insertions belong to the row that follows them: every audit of a segment then ends with a
row's edit and has as many of those as the segment has rows, so none is a proper prefix of another.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache, partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.storage import written

#: Rows and bytes of a segment, beyond which another one begins.
SEGMENT, SEGMENT_BYTES = 256, 1 << 20
#: Rounds of Re-Pair and rules made in a round: the grammar's size is at most their product.
ROUNDS, RULES = 4, 12
#: Costs of the edits, and of a row that stays truncated.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: A cost that stands for "can't be reached".
NEVER = 1 << 40
#: Role of the next row by state: nothing yet, after the system row, after a user row, after an assistant row.
NEXT_ROLE = ("user", "user", "assistant", "user")
_NEXT, _FINAL = (2, 2, 3, 2), {0: "", 1: "II", 2: "I", 3: ""}
#: Symbols: a row of a role (system, user, assistant, other), the same truncated, and a row that must go.
SYMBOLS = "suaoSUAOx"

Rope = str | tuple
Matrix = list[tuple[int, Rope]]


def flat(rope: Rope) -> str:
    """The rope's text."""
    out, todo = [], [rope]
    while todo:
        part = todo.pop()
        if isinstance(part, str):
            out.append(part)
        else:
            todo += (part[1], part[0])
    return "".join(out)


def symbol_matrix(symbol: str) -> Matrix:
    """Entry 4 * q + k: least cost, then least audit, of insertions and one edit that lead from state q to state k."""
    best: Matrix = [(NEVER, "")] * 16
    role, extra = symbol.lower(), TRUNCATED if symbol.isupper() else 0
    for q in range(4):
        at, cost, audit = q, 0, ""
        for _ in range(3):  # more than two insertions in a row only go round
            ways = [(at, DELETE, "D")]
            if symbol != "x":
                ways.append((_NEXT[at], REROLE + extra, "R"))
                if role == "s" and at == 0:
                    ways.append((1, extra, "K"))
                if role == NEXT_ROLE[at][0]:
                    ways.append((_NEXT[at], extra, "K"))
            for k, c, edit in ways:
                best[4 * q + k] = min(best[4 * q + k], (cost + c, audit + edit))
            at, cost, audit = _NEXT[at], cost + INSERT, audit + "I"
    return best


def times(x: Matrix, y: Matrix) -> Matrix:
    """Min-plus product, of equal costs the least audit; audits are ropes over those of the factors."""
    out: Matrix = []
    for q in range(4):
        for k in range(4):
            cost, ropes = NEVER, []
            for m in range(4):
                c = x[4 * q + m][0] + y[4 * m + k][0]
                if c > cost or c >= NEVER:
                    continue
                if c < cost:
                    cost, ropes = c, []
                ropes.append((x[4 * q + m][1], y[4 * m + k][1]))
            out.append((cost, ropes[0] if len(ropes) == 1 else min(ropes, key=flat, default="")))
    return out


def compress(symbols: Iterable, rules: list[tuple]) -> list:
    """The sequence with each rule's pair replaced by the rule, left to right, rule after rule."""
    seq = list(symbols)
    for number, pair in enumerate(rules):
        out, k = [], 0
        while k < len(seq):
            if k + 1 < len(seq) and (seq[k], seq[k + 1]) == pair:
                out.append(number)
                k += 2
            else:
                out.append(seq[k])
                k += 1
        seq = out
    return seq


def _token(x: int | str) -> str:
    return str(x)


def _named(x: str) -> int | str:
    return int(x) if x.isdigit() else x


def grammar(segments: DataFrame) -> list[tuple]:
    """Re-Pair rules, in the order in which they apply: pairs of symbols or of numbers of earlier rules.

    Each round counts neighbours in all distinct sequences, weighted by how often these occur, and makes rules of the most frequent
    pairs that can't overlap one another. There are at most as many different pairs as symbols and rules squared.
    """
    distinct = written(segments.groupBy("symbols").count(), "sequences")
    rules: list[tuple] = []
    for _ in range(ROUNDS):

        def neighbours(batches: Iterator[pa.RecordBatch], rules: list[tuple] = tuple(rules)) -> Iterator[pa.RecordBatch]:
            found: Counter = Counter()
            for batch in batches:
                for symbols, n in zip(batch["symbols"].to_pylist(), batch["count"].to_pylist(), strict=True):
                    seq = compress(symbols, rules)
                    for pair in zip(seq, seq[1:]):
                        found[pair] += n
            yield pa.RecordBatch.from_pydict({"a": [_token(p[0]) for p in found], "b": [_token(p[1]) for p in found], "n": list(found.values())}, pa.schema([("a", pa.string()), ("b", pa.string()), ("n", pa.int64())]))

        pairs = distinct.mapInArrow(neighbours, "a string, b string, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n")).where("n > 1")
        lefts, rights = set(), set()
        for r in pairs.orderBy(F.desc("n"), "a", "b").limit(4 * RULES).collect():
            pair = _named(r["a"]), _named(r["b"])
            if len(lefts) < RULES and pair[0] != pair[1] and pair[0] not in rights and pair[1] not in lefts:
                rules.append(pair)
                lefts.add(pair[0])
                rights.add(pair[1])
        if not lefts:
            break
    return rules


class Matrices:
    """Matrices of all symbols and rules, and of whole sequences by way of them."""

    def __init__(self, rules: list[tuple]) -> None:
        self.rules = rules
        self.known: dict = {s: symbol_matrix(s) for s in SYMBOLS}
        for number, (a, b) in enumerate(rules):
            self.known[number] = times(self.known[a], self.known[b])
        self.of = lru_cache(4096)(self._of)

    def _of(self, symbols: str) -> list[tuple[int, str]]:
        seq = compress(symbols, self.rules)
        product = self.known[seq[0]]
        for s in seq[1:]:
            product = times(product, self.known[s])
        return [(cost, flat(rope)) for cost, rope in product]


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text) with faults put in by crc32(``conv:turn``) modulo 20; nulls of role and text become one space.

    0 drops the row, 1 empties its text, 2 removes ``.``, ``!`` and ``?``, 3 repeats the row, 4 makes its role user.
    """
    given = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    fault = F.crc32(F.encode(F.concat(given(conv), F.lit(":"), given(turn)), "UTF-8")) % 20
    rows = rows.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("bigint").alias("turn"), fault.alias("fault"),
        F.when(fault == 4, "user").otherwise(given(role)).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(given(text), "[.!?]", "")).otherwise(given(text)).alias("text"),
    ).where("fault != 0")
    return rows.select("conv", "turn", "role", "text", F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("col")


def _key(*parts: str) -> Column:
    """Digest of values, of which none runs into the next."""
    texts = [F.col(c).cast("string") for c in parts]
    return F.unhex(F.md5(F.encode(F.concat(*[F.coalesce(F.concat(F.char_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), "UTF-8")))


def _units(rows: DataFrame) -> DataFrame:
    """Equal rows as one with their number, and whether the first of them is the first of its role and text in the conversation."""
    keyed = rows.withColumn("row", _key("conv", "turn", "role", "text"))
    equal = keyed.groupBy("row").agg(*[F.any_value(c).alias(c) for c in ("conv", "turn", "role", "text")], F.count(F.lit(1)).alias("n"))
    early = F.struct(F.col("turn").isNotNull(), "turn")
    seen = keyed.select("turn", "row", _key("conv", "role", "text").alias("same")).groupBy("same").agg(F.min_by("row", early).alias("row"))
    last = F.regexp_extract("text", "([^ \\t-\\r])[ \\t-\\r]*\\z", 1)
    return equal.join(seen.select("row", F.lit(True).alias("first")), "row", "left").select(
        "conv", "turn", "role", F.unhex(F.md5(F.encode("text", "UTF-8"))).alias("digest"), "text", "n", F.col("first").isNotNull().alias("first"),
        (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("truncated"),
    )


_SEGMENT = "part int, seq bigint, whole boolean, symbols string, roles array<string>, texts array<string>, blank bigint, duplicate bigint, truncated bigint, illegal bigint, head string, tail string, turns bigint, first_turn bigint, last_turn bigint"
_ARROW = pa.schema([
    ("part", pa.int32()), ("seq", pa.int64()), ("whole", pa.bool_()), ("symbols", pa.string()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), *[(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal")],
    ("head", pa.string()), ("tail", pa.string()), *[(c, pa.int64()) for c in ("turns", "first_turn", "last_turn")],
])
_LEGAL = {"su", "ua", "au"}


class _Segment:
    """Rows of one conversation, one after the other."""

    def __init__(self, conv: object, begins: bool) -> None:
        self.begins = begins  # the conversation begins with it, for sure
        self.conv, self.symbols, self.roles, self.texts, self.size = conv, [], [], [], 0
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
        self.head = self.tail = self.first_turn = self.last_turn = None

    def add(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
        if self.tail is None:
            self.head = initial
        elif self.tail + initial not in _LEGAL:
            self.counts["illegal"] += 1
        self.tail = initial
        if turn is not None and turn != self.last_turn:
            self.counts["turns"] += 1
            self.first_turn, self.last_turn = turn if self.first_turn is None else self.first_turn, turn
        if fault:
            self.counts[fault] += 1
        if fault in ("blank", "duplicate"):
            self.symbols.append("x")
        else:
            self.symbols.append(initial.upper() if fault else initial)
            self.roles.append(role)
            self.texts.append(text)
            self.size += len(text)

    def full(self, rows: int) -> bool:
        return len(self.symbols) >= rows or self.size >= SEGMENT_BYTES

    def row(self, part: int, seq: int, ends: bool) -> dict:
        return {"part": part, "seq": seq, "whole": self.begins and ends, "symbols": "".join(self.symbols), "roles": self.roles, "texts": self.texts, "head": self.head, "tail": self.tail, "first_turn": self.first_turn, "last_turn": self.last_turn, **self.counts}


def _batch(rows: list[tuple[object, dict]], kind: pa.DataType) -> pa.RecordBatch:
    columns = [pa.array([conv for conv, _ in rows], kind)] + [pa.array([r[f.name] for _, r in rows], f.type) for f in _ARROW]
    return pa.RecordBatch.from_arrays(columns, names=["conv", *_ARROW.names])


def _cut(rows: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows to segments of at most so many rows. A conversation at the edge of a partition may go on in the next one."""
    part, seq, ready, size, open_, kind = TaskContext.get().partitionId(), 0, [], 0, None, None
    for batch in batches:
        kind = batch.schema.field("conv").type
        for conv, turn, role, text, n, first, blank, truncated in zip(*[batch[c].to_pylist() for c in ("conv", "turn", "role", "text", "n", "first", "blank", "truncated")], strict=True):
            for k in range(n):
                fault = "blank" if blank else "duplicate" if k or not first else "truncated" if truncated else None
                other = open_ is not None and open_.conv != conv
                if open_ is not None and (other or open_.full(rows)):
                    ready.append((open_.conv, open_.row(part, seq, other)))
                    seq, size, open_ = seq + 1, size + open_.size, None
                    if size > SEGMENT_BYTES or len(ready) > 500:
                        yield _batch(ready, kind)
                        ready, size = [], 0
                if open_ is None:
                    open_ = _Segment(conv, other)
                open_.add(turn, role, text, fault)
    if open_ is not None:
        ready.append((open_.conv, open_.row(part, seq, False)))
    if ready:
        yield _batch(ready, kind)


def segments(rows: DataFrame, segment_rows: int = SEGMENT) -> DataFrame:
    """Segments of (conv, turn, role, text) rows, ordered by turn (nulls first), then role, then digest of the text."""
    spark, order = rows.sparkSession, [F.asc_nulls_first(c) for c in ("conv", "turn", "role", "digest")]
    units = _units(rows).repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    return written(units.mapInArrow(partial(_cut, segment_rows), f"conv {rows.schema['conv'].dataType.simpleString()}, {_SEGMENT}"), "segments")


def _chain(found: list[dict]) -> tuple[list[tuple[int, int]], int]:
    """States before and after each segment on the cheapest way, and its cost: costs to go from the end, then the least audits from the start."""
    togo = [[INSERT * len(_FINAL[k]) for k in range(4)]]
    for s in reversed(found):
        togo.append([min(s["costs"][4 * q + k] + togo[-1][k] for k in range(4)) for q in range(4)])
    togo.reverse()
    at, out = 0, []
    for s, here, after in zip(found, togo, togo[1:], strict=False):
        k = min((k for k in range(4) if s["costs"][4 * at + k] + after[k] == here[at]), key=lambda k: s["ranks"][4 * at + k])  # noqa: B023
        out.append((at, k))
        at = k
    return out, togo[0][0]


_FACTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_STATS = ("blank", "duplicate", "truncated", "illegal", "head", "tail", "turns", "first_turn", "last_turn")
_STATES = ("q", "k", "at", "of", "closing", *_FACTS)
_STATE_TYPES = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * len(_FACTS))


def _weighed(matrix: list[tuple[int, str]]) -> tuple[list[int], list[int]]:
    """Costs, and the ranks of the audits from each state."""
    return [c for c, _ in matrix], [sorted(a for _, a in matrix[j - j % 4 : j - j % 4 + 4]).index(matrix[j][1]) for j in range(16)]


def _solved(found: list[dict]) -> list[tuple]:
    """What _STATES names, for each segment of a conversation in order."""
    ways, cost = _chain(found)
    total = lambda c: sum(s[c] for s in found)
    turns = [s for s in found if s["turns"]]
    shared = sum(a["last_turn"] == b["first_turn"] for a, b in zip(turns, turns[1:]))
    gaps = turns[-1]["last_turn"] - turns[0]["first_turn"] + 1 - (total("turns") - shared) if turns else 0
    seams = sum(a["tail"] + b["head"] not in _LEGAL for a, b in zip(found, found[1:]))
    facts = (gaps, total("blank"), total("duplicate"), total("truncated"), total("illegal") + seams, cost)
    return [(q, k, at, len(found), _FINAL[k] if at + 1 == len(found) else "", *facts) for at, (q, k) in enumerate(ways)]


def _states(cut: DataFrame, rules: list[tuple]) -> DataFrame:
    """(part, seq) and _STATES of each segment."""
    kinds = {"head": "string", "tail": "string"}

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrices = Matrices(rules)
        for batch in batches:
            weights = [_weighed(matrices.of(symbols)) for symbols in batch["symbols"].to_pylist()]
            kept = [batch[c] for c in ("conv", "part", "seq", *_STATS)]
            yield pa.RecordBatch.from_arrays([*kept, *[pa.array([w[k] for w in weights], pa.list_(pa.int64())) for k in (0, 1)]], names=["conv", "part", "seq", *_STATS, "costs", "ranks"])

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(s["part"], s["seq"], *states) for found in batch["found"].to_pylist() for s, states in zip(found, _solved(found), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], t) for j, t in enumerate((pa.int32(), pa.int64(), *_STATE_TYPES))], names=["part", "seq", *_STATES])

    schema = f"conv {cut.schema['conv'].dataType.simpleString()}, part int, seq bigint, {', '.join(f'{c} {kinds.get(c, 'bigint')}' for c in _STATS)}, costs array<bigint>, ranks array<bigint>"
    weighed = cut.select("conv", "part", "seq", "symbols", *_STATS).mapInArrow(weigh, schema)
    lists = weighed.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("part", "seq", "costs", "ranks", *_STATS))).alias("found")).select("found")
    return lists.mapInArrow(chain, "part int, seq bigint, q int, k int, at bigint, of bigint, closing string, " + ", ".join(f"{c} bigint" for c in _FACTS))


def _lines(audit: str, q: int, symbols: str, roles: list[str], texts: list[str]) -> list[tuple[str, str]]:
    """Rows (role, text) that the edits leave, from state q on."""
    at, out, row, kept = q, [], 0, 0
    for edit in audit:
        if edit == "I":
            out.append((NEXT_ROLE[at], ""))
            at = _NEXT[at]
            continue
        has = symbols[row] != "x"
        if edit != "D":
            out.append((roles[kept] if edit == "K" else NEXT_ROLE[at], texts[kept]))
            at = 1 if edit == "K" and symbols[row] in "sS" else _NEXT[at]
        row, kept = row + 1, kept + has
    return out


def repaired_segments(rows: DataFrame, segment_rows: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """(conv, at, of, audit, lines, facts): for each segment of a conversation, in order by ``at``, its edits and what they leave.

    ``lines`` are (role, text) rows. The facts, equal in all ``of`` segments of a conversation: gaps, blank, duplicate, truncated, illegal, cost.
    Two tables: of conversations that lie whole in one segment, which are solved where they are, and of all others, whose segments are chained first.
    """
    cut = segments(rows, segment_rows)
    rules = grammar(cut)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrices = Matrices(rules)
        for batch in batches:
            symbols = batch["symbols"].to_pylist()
            if "q" in batch.schema.names:
                states = list(zip(*[batch[c].to_pylist() for c in _STATES], strict=True))
            else:
                states = []
                for s, *stats in zip(symbols, *[batch[c].to_pylist() for c in _STATS], strict=True):
                    costs, ranks = _weighed(matrices.of(s))
                    states += _solved([{"costs": costs, "ranks": ranks, **dict(zip(_STATS, stats, strict=True))}])
            audits = [matrices.of(s)[4 * state[0] + state[1]][1] + state[4] for s, state in zip(symbols, states, strict=True)]
            lines = [[{"role": r, "text": t} for r, t in _lines(audit, state[0], s, roles, texts)] for audit, state, s, roles, texts in zip(audits, states, symbols, batch["roles"].to_pylist(), batch["texts"].to_pylist(), strict=True)]
            kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
            given = {c: pa.array([state[j] for state in states], _STATE_TYPES[j]) for j, c in enumerate(_STATES)}
            yield pa.RecordBatch.from_arrays([batch["conv"], given["at"], given["of"], pa.array(audits, pa.string()), pa.array(lines, kind), *[given[c] for c in _FACTS]], names=["conv", "at", "of", "audit", "lines", *_FACTS])

    schema = f"conv {rows.schema['conv'].dataType.simpleString()}, at bigint, of bigint, audit string, lines array<struct<role: string, text: string>>, " + ", ".join(f"{c} bigint" for c in _FACTS)
    parts = cut.where("NOT whole")
    chained = parts.select("conv", "part", "seq", "symbols", "roles", "texts").join(_states(parts, rules), ["part", "seq"]).drop("part", "seq")
    return cut.where("whole").select("conv", "symbols", "roles", "texts", *_STATS).mapInArrow(build, schema), chained.mapInArrow(build, schema)


def repair(rows: DataFrame) -> DataFrame:
    """Repaired rows of (conv, turn, role, text) rows: (conv, at, place, role, text), ordered by ``at`` and ``place`` within a conversation."""
    whole, chained = repaired_segments(rows)
    return whole.unionByName(chained).select("conv", "at", F.posexplode("lines").alias("place", "line")).select("conv", "at", "place", "line.role", "line.text")


def digest_repairs(rows: DataFrame, segment_rows: int = SEGMENT) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), one row for each conversation with rows.

    ``rows`` are (conv, turn, role, text) without null roles and texts; conv and turn may be null (a null conversation is one of its
    own, a null turn comes first). Rows of one turn go by role, then by the text's digest; equal rows are duplicates of one another.
    An audit is as long as its conversation, so it and a digest are made by one task, which reads segments in order and holds the audit alone.
    """
    line = F.transform("lines", lambda x: F.concat(x["role"], F.lit(":"), x["text"]))
    facts = [F.col(c) for c in _FACTS]
    whole, chained = repaired_segments(rows, segment_rows)
    joined = lambda df: df.withColumn("chunk", F.array_join(line, "\n")).withColumn("some", F.size("lines") > 0)
    chained = joined(written(chained, "repaired"))
    alone = joined(whole).unionByName(chained.where("of = 1")).select("conv", *facts, "audit", F.sha2("chunk", 256).alias("repaired_sha256"))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, audit, lines = hashlib.sha256(), [], False
        for batch in batches:
            done = []
            for at, of, part, chunk, some, j in zip(*[batch[c].to_pylist() for c in ("at", "of", "audit", "chunk", "some")], range(batch.num_rows), strict=True):
                if at == 0:
                    digest, audit, lines = hashlib.sha256(), [], False
                audit.append(part)
                if some:
                    digest.update((("\n" if lines else "") + chunk).encode())
                    lines = True
                if at + 1 == of:
                    done.append((j, "".join(audit), digest.hexdigest()))
            take = pa.array([d[0] for d in done], pa.int64())
            yield pa.RecordBatch.from_arrays([batch[c].take(take) for c in ("conv", *_FACTS)] + [pa.array([d[k] for d in done], pa.string()) for k in (1, 2)], names=["conv", *_FACTS, "audit", "repaired_sha256"])

    parts = chained.where("of > 1").repartition("conv").sortWithinPartitions("conv", "at")
    return alone.unionByName(parts.select("conv", "at", "of", "audit", "chunk", "some", *facts).mapInArrow(stream, alone.schema))


def repair_damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", segment_rows: int = SEGMENT) -> DataFrame:
    """Every conversation of the given rows: damaged, judged and repaired.

    Columns: conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. A conversation without rows after damage
    has zeros, an empty audit and the digest of the empty string; so has a null conversation, which is one of its own. Null roles and texts
    are one space. Other columns aren't read.
    """
    done = digest_repairs(damage(rows, conv, turn, role, text), segment_rows).withColumnRenamed("conv", "_conv")
    every = rows.select(F.col(f"`{conv}`").alias("conv")).distinct()
    out = every.join(done, F.col("conv").eqNullSafe(F.col("_conv")), "left")
    or_else: dict[str, Column] = {c: F.coalesce(c, F.lit(0).cast("bigint")) for c in _FACTS} | {"audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest()))}
    return out.select(F.col("conv").alias(conv), *[c.alias(n) for n, c in or_else.items()])
