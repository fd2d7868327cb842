"""SQL with the same rows, for the operators that SQL can express at whole-table size."""

from __future__ import annotations

from sluice.llm.conversations import DELETE, INSERT, REROLE, TRUNCATED
from sluice.llm.middle import MARKS, PLAIN, SUFFIX_FIRST
from sluice.llm.rules import CHARACTER_CLASSES, COMMON_WORDS, LEAST_CHARACTERS, LEAST_WORDS, MAX_CHARACTER_DISTANCE, WORD_SHARE


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _distance(a: str, b: str) -> str:
    """Jensen-Shannon distance of two count lists of equal length."""
    share = lambda h: f"list_transform({h}, lambda v: v / list_sum({h}))"
    term = lambda p, q: f"(CASE WHEN {p} > 0 THEN {p} * log2({p} / (({p} + {q}) / 2)) ELSE 0 END)"
    pairs = f"list_zip({share(a)}, {share(b)})"
    total = f"list_sum(list_transform({pairs}, lambda z: ({term('z[1]', 'z[2]')} + {term('z[2]', 'z[1]')}) / 2))"
    return f"CASE WHEN list_sum({a}) > 0 AND list_sum({b}) > 0 THEN sqrt(greatest(0.0, {total})) ELSE 0.0 END"


def divergence_rules() -> str:
    """Operator 3."""
    pattern = lambda c: _quoted(c.replace("\\u00C0", "À").replace("\\u024F", "ɏ").replace("\\t-\\r", "\\t\\n\\x0B\\f\\r"))
    counts = [f"length(t) - length(regexp_replace(t, {pattern(c)}, '', 'g'))" for c in CHARACTER_CLASSES]
    cases = " ".join(f"WHEN {_quoted(k)} THEN [{', '.join(map(_quoted, v))}]" for k, v in COMMON_WORDS.items())
    wide, chars = max(map(len, COMMON_WORDS.values())) + 1, len(CHARACTER_CLASSES) + 1
    sums = lambda c, n: "[" + ", ".join(f"coalesce(sum({c}[{k}]) FILTER (NOT base_failed), 0)::DOUBLE" for k in range(1, n + 1)) + "]"
    space = "'[ \\t\\n\\x0B\\f\\r]+'"
    return f"""WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, {space}), lambda x: x <> '') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \\t\\n\\x0B\\f\\r]')) AS l, coalesce(CASE lang {cases} END, []) AS bins FROM d),
g AS (SELECT row, i, array_to_string(w[i : i + 7], ' ') AS win FROM w, unnest(range(1, len(w) - 6)) x(i) WHERE len(w) >= 8),
r AS (SELECT row, i, lag(i) OVER (PARTITION BY row ORDER BY i) AS before FROM (SELECT row, i, count(*) OVER (PARTITION BY row, win) AS n FROM g) WHERE n > 1),
rep AS (SELECT row, sum(least(8, i - coalesce(before, -8)))::BIGINT AS n FROM r GROUP BY row),
c AS (SELECT w.row, doc_id, lang, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
  len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, [{', '.join(counts)}, length(t)] AS ch0, bins,
  list_transform(w, lambda x: list_position(bins, lower(x))) AS pos FROM w LEFT JOIN rep ON rep.row = w.row),
m AS (SELECT *, list_concat(ch0[1:{chars - 1}], [ch0[{chars}] - list_sum(ch0[1:{chars - 1}])]) AS ch, CASE WHEN len(bins) > 0 THEN
  list_concat(list_transform(range(1, len(bins) + 1), lambda k: len(list_filter(pos, lambda x: x = k))), [n_words - len(list_filter(pos, lambda x: x > 0))]) ELSE [n_words] END AS wd, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM c),
ref0 AS (SELECT lang, {sums('ch', chars)} AS rch, {sums('wd', wide)} AS rwd, list_concat(list_transform(range(max(len(wd)) - 1), lambda i: 0.0::DOUBLE), [1.0::DOUBLE]) AS bare FROM m GROUP BY lang),
ref AS (SELECT *, {WORD_SHARE} * {_distance('bare', 'rwd[1:len(bare)]')} AS word_limit FROM ref0),
j AS (SELECT m.*, round({_distance('ch', 'rch')}, 6) AS character_distance, round({_distance('wd', 'rwd[1:len(wd)]')}, 6) AS word_distance, word_limit FROM m JOIN ref USING (lang))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT ((word_chars >= {LEAST_CHARACTERS} AND character_distance > {MAX_CHARACTER_DISTANCE}) OR (n_words >= {LEAST_WORDS} AND word_distance > word_limit)) AS kept, character_distance, word_distance FROM j"""


def fill_in_middle() -> str:
    """Operator 11. The restored text is the text itself: that is what the operator's round trip must give."""
    group = lambda k: f"CAST('0x' || substr(h, {8 * k + 1}, 8) AS BIGINT)"
    marked = " OR ".join(f"contains(t, {_quoted(m)})" for m in MARKS)
    p, s, m = map(_quoted, MARKS)
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
c AS (SELECT *, length(t) AS n, {group(0)} % (length(t) + 1) AS c1, {group(1)} % (length(t) + 1) AS c2,
  CASE WHEN t = '' OR {marked} OR {group(2)} % 100 >= {100 - PLAIN} THEN 'plain' WHEN {group(3)} % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b FROM c),
o AS (SELECT *, substr(t, 1, a) AS x, substr(t, a + 1, b - a) AS y, substr(t, b + 1) AS z FROM p)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN {p} || x || {s} || z || {m} || y ELSE {s} || z || {p} || x || {m} || y END) AS output_sha256, sha256(t) AS restored_sha256 FROM o"""


def conversation_repair() -> str:
    """Operator 13: costs to go by recursion from the last row to the first, then the edits one by one."""
    after, never = (2, 2, 3, 2), 1 << 40
    table = "list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i::BIGINT))"
    crc = "xor(list_reduce(list_transform(range(1, length(k) + 1), lambda i: ascii(k[i])::BIGINT), lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295)"
    way = lambda ok, cost, edit, k: f"{{'c': CASE WHEN {ok} THEN {cost} + g[{k + 1}].c ELSE {never} END, 'a': '{edit}' || g[{k + 1}].a}}"
    edits = lambda q: "list_sort([" + ", ".join([way("true", DELETE, "D", q), way("NOT must", f"{REROLE} + extra", "R", after[q]), way(f"NOT must AND r = '{'a' if q == 2 else 'u'}'", "extra", "K", after[q]), *([way("NOT must AND r = 's'", "extra", "K", 1)] if q == 0 else [])]) + "])[1]"
    more = lambda b, q, n: f"{{'c': {n * INSERT} + {b}[{q + 1}].c, 'a': '{'I' * n}' || {b}[{q + 1}].a}}"
    closed = lambda b: "[" + ", ".join(f"list_sort([{more(b, q, 0)}, {more(b, after[q], 1)}, {more(b, after[after[q]], 2)}])[1]" for q in range(4)) + "]"
    end = "[" + ", ".join(f"{{'c': {c}::BIGINT, 'a': ''}}" for c in (0, never, never, 0)) + "]"
    inner = "[^ \\t\\n\\x0B\\f\\r]"
    return f"""WITH RECURSIVE crc AS (SELECT {table} AS crc),
k AS (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
f AS (SELECT conv_id, turn, {crc} % 20 AS fault, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text FROM k, crc),
d AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role, CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN fault = 3 THEN [1, 2] ELSE [1] END) AS copy FROM f WHERE fault <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i, regexp_replace(text, '[ \\t\\n\\x0B\\f\\r]', '', 'g') AS dense, CASE WHEN role[1] IN ('s', 'u', 'a') THEN role[1] ELSE 'o' END AS r FROM d),
s AS (SELECT *, CASE WHEN dense = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN dense[-1] NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
  lag(r) OVER (PARTITION BY conv_id ORDER BY i) || r AS pair FROM n),
y AS (SELECT *, fault IN ('blank', 'duplicate') AS must, CASE WHEN fault = 'truncated' THEN {TRUNCATED} ELSE 0 END AS extra FROM s),
c AS (SELECT conv_id, count(*) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM y GROUP BY conv_id),
t AS (SELECT conv_id, rows AS i, {closed(end)} AS g FROM c UNION ALL
  SELECT conv_id, i, {closed('b')} AS g FROM (SELECT t.conv_id, t.i - 1 AS i, [{', '.join(map(edits, range(4)))}] AS b FROM t JOIN y ON y.conv_id IS NOT DISTINCT FROM t.conv_id AND y.i = t.i)),
a AS (SELECT conv_id, g[1].c AS cost, g[1].a AS audit FROM t WHERE i = 0),
w AS (SELECT conv_id, audit, 1 AS place, 0 AS state, 0 AS i, []::VARCHAR[] AS lines FROM a UNION ALL
  SELECT w.conv_id, audit, place + 1, CASE WHEN e = 'D' THEN state WHEN e = 'K' AND r = 's' THEN 1 WHEN state = 2 THEN 3 ELSE 2 END, CASE WHEN e = 'I' THEN w.i ELSE w.i + 1 END,
  CASE WHEN e = 'D' THEN lines ELSE list_append(lines, CASE WHEN e = 'K' THEN role WHEN state = 2 THEN 'assistant' ELSE 'user' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END) END
  FROM (SELECT *, audit[place] AS e FROM w WHERE place <= length(audit)) w LEFT JOIN y ON y.conv_id IS NOT DISTINCT FROM w.conv_id AND y.i = w.i + 1),
l AS (SELECT conv_id, coalesce(array_to_string(lines, chr(10)), '') AS whole FROM w WHERE place = length(audit) + 1)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN a ON a.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN l ON l.conv_id IS NOT DISTINCT FROM o.conv_id"""


def oracle_sql() -> dict[str, str]:
    return {"op3_divergence_rules": divergence_rules(), "op11_fill_in_middle": fill_in_middle(), "op13_conversation_repair": conversation_repair()}
