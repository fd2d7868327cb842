"""Fill-in-middle: texts cut into prefix, middle and suffix, put together with the middle last.

Cuts and forms come from a digest of the id, so a row's output depends on nothing but its id and text. The pieces are cut a batch at a
time with Arrow functions: texts become lists of code points, the lists one flat array with the row and the ordinal of each code
point, a filter by role (before, between, after the cuts) leaves the code points of a piece, and these are made lists and joined.
Code points of at most SLICE are flat at a time: a longer text goes through in slices, whose pieces are joined at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Code points that are flat at a time.
SLICE = 1 << 20
#: Marks of prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
#: Rows in a hundred that stay plain, and of the others those whose suffix comes first.
PLAIN, SUFFIX_FIRST = 10, 20

_COLUMNS = ("n", "form", "prefix_chars", "middle_chars", "output", "restored")


def _starts(counts: pa.Array) -> pa.Array:
    """Offsets of lists with so many values."""
    return pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(counts.cast(pa.int64()))])


def code_points(texts: pa.Array) -> pa.Array:
    """Lists of the code points of each text (large strings without nulls); the bytes aren't copied."""
    _, offsets, data = texts.buffers()
    ends = pa.Array.from_buffers(pa.int64(), len(texts) + 1, [None, offsets], offset=texts.offset)
    first, n_bytes = ends[0].as_py(), ends[-1].as_py() - ends[0].as_py()
    if n_bytes == 0:
        return pa.LargeListArray.from_arrays(pa.array([0] * (len(texts) + 1), pa.int64()), pa.array([], pa.large_string()))
    raw = pa.Array.from_buffers(pa.uint8(), n_bytes, [None, data], offset=first)
    heads = pc.indices_nonzero(pc.not_equal(pc.bit_wise_and(raw, pa.scalar(0xC0, pa.uint8())), pa.scalar(0x80, pa.uint8()))).cast(pa.int64())
    at = pa.concat_arrays([pc.add(heads, first), pa.array([first + n_bytes], pa.int64())])
    flat = pa.LargeStringArray.from_buffers(len(heads), at.buffers()[1], data)
    return pa.LargeListArray.from_arrays(_starts(pc.utf8_length(texts)), flat)


def cut(texts: pa.Array, a: pa.Array, b: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """The code points before a, from a to b, and from b on of each text (large strings without nulls, 0 <= a <= b <= length)."""
    units = code_points(texts)
    starts, n = units.offsets, pc.subtract(units.offsets[1:], units.offsets[:-1])
    flat, parents = pc.list_flatten(units), pc.list_parent_indices(units)
    ordinals = pc.subtract(pa.array(range(0), pa.int64()) if not len(flat) else pc.cumulative_sum(pa.repeat(pa.scalar(1, pa.int64()), len(flat))), pc.add(pc.take(starts[:-1], parents), 1))
    before, after = pc.less(ordinals, pc.take(a, parents)), pc.greater_equal(ordinals, pc.take(b, parents))
    roles = ((before, a), (pc.and_not(pc.invert(before), after), pc.subtract(b, a)), (after, pc.subtract(n, b)))
    return tuple(pc.binary_join(pa.LargeListArray.from_arrays(_starts(count), pc.filter(flat, role)), pa.scalar("", pa.large_string())) for role, count in roles)


def _slices(n: list[int]) -> Iterator[list[tuple[int, int]]]:
    """Groups of (row, first code point), each of at most SLICE code points."""
    group, size = [], 0
    for row, length in enumerate(n):
        for start in range(0, max(length, 1), SLICE):
            here = min(SLICE, length - start)
            if group and size + here > SLICE:
                yield group
                group, size = [], 0
            group.append((row, start))
            size += here
    if group:
        yield group


def pieces(texts: pa.Array, a: pa.Array, b: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """As cut, for texts of any length: at most SLICE code points are flat at a time."""
    n = pc.utf8_length(texts).to_pylist()
    found, rows = [], []
    for group in _slices(n):
        index = pa.array([row for row, _ in group], pa.int64())
        if any(n[row] > SLICE for row, _ in group):
            part = pa.array([pc.utf8_slice_codeunits(texts[row], start, start + SLICE).as_py() for row, start in group], pa.large_string())
        else:
            part = texts.slice(group[0][0], len(group))
        start, length = pa.array([s for _, s in group], pa.int64()), pc.utf8_length(part).cast(pa.int64())
        inside = lambda c: pc.min_element_wise(pc.max_element_wise(pc.subtract(pc.take(c, index), start), 0), length)  # noqa: E731, B023
        found.append(cut(part, inside(a), inside(b)))
        rows.extend(row for row, _ in group)
    if len(rows) == len(n):
        return tuple(pa.concat_arrays(p) for p in zip(*found, strict=True))
    counts = [0] * len(n)
    for row in rows:
        counts[row] += 1
    lists = lambda p: pa.LargeListArray.from_arrays(_starts(pa.array(counts, pa.int64())), pa.concat_arrays(p))
    return tuple(pc.binary_join(lists(p), pa.scalar("", pa.large_string())) for p in zip(*found, strict=True))


def _joined(*parts: pa.Array | str) -> pa.Array:
    return pc.binary_join_element_wise(*[pa.scalar(p, pa.large_string()) if isinstance(p, str) else p for p in parts], pa.scalar("", pa.large_string()))


def arrange(form: pa.Array, texts: pa.Array, prefix: pa.Array, middle: pa.Array, suffix: pa.Array, marks: tuple[str, str, str]) -> pa.Array:
    """The output of each row: the text, or its pieces in the order of the form."""
    p, s, m = marks
    return pc.if_else(pc.equal(form, "plain"), texts, pc.if_else(pc.equal(form, "psm"), _joined(p, prefix, s, suffix, m, middle), _joined(s, suffix, p, prefix, m, middle)))


def _halves(texts: pa.Array, mark: str) -> tuple[pa.Array, pa.Array]:
    """What stands before and after the first mark; nothing after where there is none."""
    lists = pc.split_pattern(texts, mark, max_splits=1)
    has = pc.greater(pc.list_value_length(lists), 1)
    second = pc.take(pc.list_flatten(lists), pc.if_else(has, pc.add(pc.subtract(lists.offsets[:-1], lists.offsets[0]), 1), 0))
    return pc.list_element(lists, 0), pc.if_else(has, second, pa.scalar("", pa.large_string()))


def rebuild(output: pa.Array, form: pa.Array, marks: tuple[str, str, str]) -> pa.Array:
    """The text from an output and its form alone."""
    p, s, m = marks
    plain, first = pc.equal(form, "plain"), pc.equal(form, "psm")
    body = pc.if_else(plain, pa.scalar("", pa.large_string()), pc.if_else(first, pc.utf8_slice_codeunits(output, len(p)), pc.utf8_slice_codeunits(output, len(s))))
    prefix1, rest1 = _halves(body, s)  # psm: prefix, suffix, middle
    suffix1, middle1 = _halves(rest1, m)
    suffix2, rest2 = _halves(body, p)  # spm: suffix, prefix, middle
    prefix2, middle2 = _halves(rest2, m)
    return pc.if_else(plain, output, pc.if_else(first, _joined(prefix1, middle1, suffix1), _joined(prefix2, middle2, suffix2)))


def _check(marks: tuple[str, str, str]) -> None:
    for x in marks:
        for y in marks:
            if any(x[-k:] == y[:k] for k in range(1, min(len(x), len(y)) + (x != y))):
                raise ValueError(f"marks {x!r} and {y!r} overlap: an output couldn't be taken apart again")


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = "1", marks: tuple[str, str, str] = MARKS, plain: int = PLAIN, suffix_first: int = SUFFIX_FIRST,
) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output, restored), one row for each document.

    The four first eight-digit groups of the digest of ``seed:id`` give two cuts among the n + 1 places and the form: ``plain`` if the
    text is empty, holds a mark, or by chance (``plain`` in a hundred); else ``spm`` (``suffix_first`` in a hundred) or ``psm``. ``output`` is
    prefix, suffix, middle, each after its mark (spm: suffix first), or the text; ``restored`` is rebuilt from output and form alone.
    prefix_chars and middle_chars are code points, null if plain. A null text is an empty one, a null id the empty string in the digest;
    repeated rows give equal rows. Other columns aren't read. Nothing is shuffled. Marks that overlap raise ValueError.
    """
    _check(marks)
    if id_col in _COLUMNS:
        raise ValueError(f"the id can't be named {id_col}")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))), 256)
    group: list[Column] = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    marked = F.lit(False)
    for mark in marks:
        marked |= text.contains(mark)
    n = F.char_length(text).cast("bigint")
    form = F.when((n == 0) | marked | (group[2] % 100 >= 100 - plain), "plain").when(group[3] % 100 < suffix_first, "spm").otherwise("psm")
    cuts = [group[0] % (n + 1), group[1] % (n + 1)]
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), n.alias("n"), form.alias("form"), F.least(*cuts).alias("a"), F.greatest(*cuts).alias("b"), text.alias("text"))

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts, kind, a, b = batch["text"].cast(pa.large_string()), batch["form"], batch["a"], batch["b"]
            output = arrange(kind, texts, *pieces(texts, a, b), marks)
            none = pa.scalar(None, pa.int64())
            is_plain = pc.equal(kind, "plain")
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["n"], kind, pc.if_else(is_plain, none, a), pc.if_else(is_plain, none, pc.subtract(b, a)), output.cast(pa.string()), rebuild(output, kind, marks).cast(pa.string())],
                names=["id", *_COLUMNS],
            )

    kind_of_id = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(transform, f"id {kind_of_id}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string, restored string").withColumnRenamed("id", id_col)
