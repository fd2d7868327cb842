"""Operator 3 against a plain version."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

from sluice.llm import queries as q
from sluice.llm import rules as m
from tests.llm import brute
from tests.llm.test_tokens import rows

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SF = "/root/testdata/sf0.01"


def plain(docs):
    """doc id: measures, base_failed, kept and the two distances; docs are (id, text, lang)."""
    found, sums = {}, defaultdict(lambda: [Counter(), Counter()])
    for i, text, lang in docs:
        text, lang = text or "", lang or ""
        words = brute.WORDS.findall(text)
        lines = [x for x in text.split("\n") if brute.WORDS.search(x)]
        windows = defaultdict(list)
        for k in range(len(words) - 7):
            windows[tuple(words[k : k + 8])].append(k)
        hit = {w for at in windows.values() if len(at) > 1 for k in at for w in range(k, k + 8)}
        chars = Counter(next((n for n, c in enumerate(m.CHARACTER_CLASSES) if re.match(c, x)), 99) for x in text)
        common = m.COMMON_WORDS.get(lang, [])
        bins = Counter(common.index(w.lower()) if w.lower() in common else 99 for w in words)
        found[i] = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)), chars, bins, lang
        if len(words) >= 20 and 100 * len(hit) <= 30 * len(words):  # references come from rows that pass the base rules
            sums[lang][0].update(chars)
            sums[lang][1].update(bins)

    def distance(a, b):
        total, n, n2 = 0.0, sum(a.values()), sum(b.values())
        if not n or not n2:
            return 0.0
        for k in b:
            p, r = a[k] / n, b[k] / n2
            total += sum(x * math.log2(x / ((p + r) / 2)) for x in (p, r) if x) / 2
        return math.sqrt(max(0.0, total))

    out = {}
    for i, (base, chars, bins, lang) in found.items():
        cd, wd = distance(chars, sums[lang][0]), distance(bins, sums[lang][1])
        limit = m.WORD_SHARE * distance(Counter({99: 1}), sums[lang][1])
        failed = base[0] < 20 or 100 * base[4] > 30 * base[0]
        odd = base[1] >= m.LEAST_CHARACTERS and cd > m.MAX_CHARACTER_DISTANCE or base[0] >= m.LEAST_WORDS and round(wd, 6) > limit
        out[i] = (*base, failed, not failed and not odd, round(cd, 5), round(wd, 5))
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for i, w in want.items():
        g = got[i]
        assert g[:7] == w[:7] and abs(g[7] - w[7]) < 2e-5 and abs(g[8] - w[8]) < 2e-5, (i, g, w)


def test_small_tables(spark):
    docs = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    same(rows(q.op3_divergence_rules(spark, SF), *BASE, "base_failed", "kept", "character_distance", "word_distance"), plain(docs))


def test_odd_documents(spark):
    unit = " ".join(f"w{k}" for k in range(8))
    docs = [
        (1, None, "en"), (2, "", None), (3, unit, "en"), (4, f"{unit} x {unit}", "en"), (5, f"{unit} {unit} {unit}", "xx"), (6, "a " * 500, "en"), (7, "\n\nx\nx\n \n y \n y \n", "de"),
        (8, "#*$%&|<> é 1 A \u000b z  z", "fr"), (9, "der die DAS und ñ " * 40, "de"), (10, "the of a in word other " * 30000, "en"), (11, unit + "\u001f" + unit, "en"), (12, "!!! ### " * 60, "en"),
    ]
    df = spark.createDataFrame([(*d, "a", 1) for d in docs], "doc_id bigint, text string, lang string, words string, kept int")
    same(rows(m.apply_rules(df), *BASE, "base_failed", "kept", "character_distance", "word_distance"), plain(docs))
    assert m.apply_rules(df.limit(0)).count() == 0
    assert m.apply_rules(df.union(df)).count() == 24


def test_keyword_list_is_rejected(spark):
    word = lambda k: f"word{chr(97 + k % 26)}{chr(97 + k // 26)}"
    plain_text, keywords = " ".join(f"the of {word(k)} in a {word(k + 1)}" for k in range(50)), " ".join(word(k) for k in range(150))
    docs = [*[(k, plain_text, "en") for k in range(20)], (20, keywords, "en"), (21, keywords, "xx"), (22, None, "en")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    got = rows(m.apply_rules(df), "n_words", "base_failed", "kept", "character_distance", "word_distance")
    assert not got[20][1] and not got[20][2] and got[20][3] <= m.MAX_CHARACTER_DISTANCE and got[20][4] > 0.5
    assert all(got[k][2] for k in range(20)) and got[21][2] and got[21][4] == 0.0


def test_no_python_in_the_plan(spark):
    plan = m.measures(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_sql_gives_the_same_rows(spark):
    from sluice.llm.oracle import oracle_sql
    from tests.oracle import connect, difference

    small = "/root/testdata/sf0.001"
    assert difference(q.op3_divergence_rules(spark, small), oracle_sql()["op3_divergence_rules"], connect(small)) == ""
