"""Operator 13 against a plain version."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from sluice.llm import conversations as c
from sluice.llm import queries as q
from tests.llm.test_tokens import rows

COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
FILLED = re.compile(r"[^\x20\x09-\x0D]")


def best_edits(facts):
    """(cost, audit) of rows (role, must go, truncated), trying every edit at every row from the first on."""

    @lru_cache(None)
    def best(i, state, inserted):
        expected = {0: "u", 1: "u", 2: "a", 3: "u"}[state]
        after = {0: 2, 1: 2, 2: 3, 3: 2}[state]
        ways = []
        if i == len(facts) and state in (0, 3):
            ways.append((0, ""))
        if inserted < 4:
            cost, audit = best(i, after, inserted + 1)
            ways.append((cost + 3, "I" + audit))
        if i < len(facts):
            role, must, cut = facts[i]
            cost, audit = best(i + 1, state, 0)
            ways.append((cost + 4, "D" + audit))
            if not must:
                extra = 3 if cut else 0
                cost, audit = best(i + 1, after, 0)
                ways.append((cost + 3 + extra, "R" + audit))
                if role[:1] == expected:
                    ways.append((cost + extra, "K" + audit))
                if role[:1] == "s" and state == 0:
                    cost, audit = best(i + 1, 1, 0)
                    ways.append((cost + extra, "K" + audit))
        return min(ways, default=(10**9, ""))

    return best(0, 0, 0)


def repaired(kept, audit):
    out, state, i = [], 0, 0
    for edit in audit:
        role = "assistant" if state == 2 else "user"
        if edit == "I":
            out.append((role, ""))
        elif edit == "D":
            i += 1
            continue
        else:
            out.append((kept[i][0] if edit == "K" else role, kept[i][1]))
            i += 1
        state = 1 if out[-1][0][:1] == "s" else 3 if state == 2 else 2
    return out


def judged(kept):
    """Facts of one conversation's rows (turn, role, text) in order."""
    seen, facts, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    for _, role, text in kept:
        letters = FILLED.findall(text)
        fault = "blank" if not letters else "duplicate" if (role, text) in seen else "truncated" if letters[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        facts.append((role, fault in ("blank", "duplicate"), fault == "truncated"))
    turns = [t for t, _, _ in kept if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
    cost, audit = best_edits(tuple(facts))
    text = "\n".join(f"{r}:{t}" for r, t in repaired([(r, t) for _, r, t in kept], audit))
    return gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()


def damaged(given):
    out = {}
    for conv, turn, role, text in given:
        kept = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        kept.extend([(turn, role, text)] * {0: 0, 3: 2}.get(fault, 1))
    return out


def plain_version(given):
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest())
    return {conv: judged(sorted(kept, key=order)) for conv, kept in damaged(given).items()}


def test_tables(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        given = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
        made = [tuple(r[k] for k in ("conv_id", *COLUMNS)) for r in q.op13_conversation_repair(spark, sf).collect()]
        assert {m[0]: m[1:] for m in made} == plain_version(given) and len(made) == len({g[0] for g in given})


def fuzzed(seed, convs, longest):
    rng, given = random.Random(seed), []
    for conv in [None, *range(convs)]:
        for turn in range(rng.randint(0, longest)):
            t = rng.choice([None, turn, turn, turn, turn * 3, 5, -2])
            given.append((conv, t, rng.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"]), rng.choice(["Yes.", "no", "", " \n", None, "What?", f"t{turn}.", f"t{turn}", "late. \n", "漢!"])))
    return given + given[:7]


@pytest.mark.parametrize("seed, convs, longest, segment", [(1, 150, 9, 256), (2, 60, 14, 2), (3, 3, 300, 4), (4, 2, 120, 1)])
def test_odd_rows(spark, seed, convs, longest, segment):
    given = fuzzed(seed, convs, longest)
    table = spark.createDataFrame([(*g, "x", 1) for g in given], "conv_id bigint, turn int, role string, text string, conv string, at int")
    made = [tuple(r[k] for k in ("conv_id", *COLUMNS)) for r in c.repair_damaged(table, segment_rows=segment).collect()]
    want = plain_version(given)
    assert len(made) == len(want) and {m[0]: m[1:] for m in made} == want


def test_rows_and_empty(spark):
    kept = [(0, "system", "Be kind."), (1, "assistant", "Hello."), (2, "user", "cut off"), (3, "user", " ")]
    rows_in = spark.createDataFrame([("c", *k) for k in kept], "conv string, turn bigint, role string, text string")
    out = c.repair(rows_in).orderBy("at", "place").collect()
    cost, audit = best_edits((("system", False, False), ("assistant", False, False), ("user", False, True), ("user", True, False)))
    assert [(r["role"], r["text"]) for r in out] == repaired([k[1:] for k in kept], audit)
    assert c.digest_repairs(rows_in.limit(0)).count() == 0
    one = c.digest_repairs(rows_in).collect()[0]
    assert (one["cost"], one["audit"]) == (cost, audit)


def test_grammar_is_shared(spark):
    """Rules multiply to the same matrices as single symbols."""
    table = spark.createDataFrame([("uauauaUAx" * 3, i) for i in range(5)] + [("suaua", 9)], "symbols string, i int")
    rules = c.grammar(table)
    assert rules
    by_rules, plain = c.Matrices(rules), c.Matrices([])
    for symbols in ("uauauaUAx" * 3, "suaua", "oxoUsA"):
        assert by_rules.of(symbols) == plain.of(symbols)
        assert len(c.compress(symbols, rules)) <= len(symbols)
