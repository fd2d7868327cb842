"""Cutting text at single spaces and newlines, where byte-level pre-tokenisers always cut too.

The pattern of byte-level vocabularies lets a word take one leading space and keeps every other run of
white space apart. So a space between two non-space characters always starts a piece, and a newline
between two non-space characters is a piece of its own. Text cut there is encoded chunk by chunk with
the same ids, and chunks repeat so often that a bounded cache answers most of them.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def chunked(texts: list[str]) -> pa.ListArray:
    """Chunks of each text, whose concatenation is the text; texts mustn't hold the character U+0000."""
    marked = pc.replace_substring(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", "\x00\n\x00"), " ", "\x00 ")
    return pc.split_pattern(marked, "\x00")


def grouped(texts: list[str], size: int = 1 << 23) -> Iterator[list[str]]:
    """The texts in order, in groups of about ``size`` characters."""
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    cuts = (np.flatnonzero(np.diff(ends // size)) + 1).tolist()
    for lo, hi in zip([0, *cuts], [*cuts, len(texts)]):
        yield texts[lo:hi]


#: Fixed value: ASCII punctuation. A run of it after a letter is a piece of its own.
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Characters from which a chunk isn't kept.
_LONG = 200
#: A chunk of Latin or Cyrillic letters, which is one piece, and the marks after it, which are another.
_LETTERS = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ɏЀ-ҁҊ-ԯ]+)([" + re.escape(_MARKS) + "]*)")


def safe(chunk: str) -> bool:
    """Whether no white space stands at the chunk's edges but its one separator."""
    rest = chunk[1:] if chunk[:1] == " " else chunk
    return chunk == "\n" or bool(rest) and not rest[0].isspace() and not rest[-1].isspace()


class ChunkCache:
    """Encodes texts by chunk.

    ``encode_letters`` maps a list of short chunks that are one piece each to a list of bytes, ``encode_safe`` any short
    safe chunks, ``encode_whole`` any text. A text with a long chunk or one that isn't safe is encoded as one. The
    cache holds at most ``limit`` chunks and starts anew beyond. A new chunk that ends in marks after a letter is
    put together from two.
    """

    def __init__(self, encode_letters: Callable[[list[str]], list[bytes]], encode_safe: Callable[[list[str]], list[bytes]], encode_whole: Callable[[str], bytes], limit: int = 800_000):
        self._letters, self._safe, self._whole, self._limit, self._known = encode_letters, encode_safe, encode_whole, limit, {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Bytes of each text's ids, in order."""
        return [x for some in grouped(texts) for x in self._group(some)]

    def _group(self, texts: list[str]) -> list[bytes]:
        """The same for a few texts: their chunks are numbered, and bytes are looked up once for each different chunk."""
        if len(self._known) > self._limit:
            self._known = {}
        cut = chunked(["" if "\x00" in x else x for x in texts])
        coded = cut.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self._known.get, words))
        new = [k for k, x in enumerate(found) if x is None]
        self._learn([words[k] for k in new])
        for k in new:
            found[k] = self._known.get(words[k])
        taken = pa.array(found, pa.large_binary()).take(coded.indices)
        first = cut.offsets.to_numpy()
        _, ends, data = taken.buffers()
        ends, data = np.frombuffer(ends, np.int64)[first].tolist(), memoryview(data or b"")
        lacks = np.concatenate([[0], np.cumsum(taken.is_null().to_numpy(zero_copy_only=False))])[first]
        out = [bytes(data[a:b]) for a, b in zip(ends, ends[1:])]
        for k in np.flatnonzero(np.diff(lacks)).tolist():  # a long chunk, or one that isn't safe
            out[k] = self._whole(texts[k]) if texts[k] else b""
        return out

    def _learn(self, missing: list[str]) -> None:
        """Adds the missing chunks that are short and safe."""
        known, split, letters, alone, is_plain = self._known, [], [], [], _LETTERS.fullmatch
        for x in missing:
            if len(x) >= _LONG:
                continue
            if plain := is_plain(x):
                stem, marks = plain.groups()
                letters.append(stem)
            elif not safe(x):
                continue
            else:
                stem = x.rstrip(_MARKS)
                if not stem[-1:].isalpha():
                    stem = x
                marks = x[len(stem) :]
                alone.append(stem)
            if marks:
                split.append((x, stem, marks))
                alone.append(marks)
        for chunks, encode in ((letters, self._letters), (alone, self._safe)):
            new = list(set(chunks).difference(known))
            known.update(zip(new, encode(new)))
        known.update([(x, known[y] + known[z]) for x, y, z in split])
