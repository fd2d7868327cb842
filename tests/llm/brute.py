"""Plain versions of the operators, straight from their contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
FOLDED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(data):
    return hashlib.sha256(data).hexdigest()


def token_shards(docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out, start = {}, 0
    for i, text in sorted(docs):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        out[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    return out


def contamination(docs, items, window=13):
    item_words = [(i, FOLDED.findall(lower(t))) for i, t in items]
    grams = {}
    for i, w in item_words:
        if w:
            n = min(window, len(w))
            for k in range(len(w) - n + 1):
                grams.setdefault(tuple(w[k : k + n]), set()).add(i)
    sizes, out = {len(g) for g in grams}, {}
    for i, text in docs:
        w = FOLDED.findall(lower(text))
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (g := tuple(w[k : k + n])) in grams:
                    hit.update(range(k, k + n))
                    found |= grams[g]
        out[i] = (len(w), len(hit), len(found), sha(",".join(sorted(map(str, found))).encode()), len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


def byte_bpe(docs, pattern):
    import tiktoken

    from sluice.llm.bpe import read_ranks

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=read_ranks(f.read()), special_tokens={})
    out = {}
    for i, text in docs:
        ids = enc.encode_ordinary(text or "")
        out[i] = (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(enc.decode_bytes(ids)))
    return out


def repeated_spans(docs, length=100):
    first = {}
    for i, text in sorted(docs):
        b = (text or "").encode()
        for p in range(len(b) - length + 1):
            first.setdefault(b[p : p + length], (i, p))
    out = {}
    for i, text in docs:
        b = (text or "").encode()
        gone = np.zeros(len(b) + 2, bool)
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < (i, p):
                gone[p + 1 : p + length + 1] = True
        runs = int((gone[1:] & ~gone[:-1]).sum())
        out[i] = (len(b), int(gone.sum()), runs, sha(bytes(c for c, g in zip(b, gone[1:]) if not g)))
    return out


def shingles(text, n=5):
    w = WORDS.findall(lower(text))
    return {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()


def near_groups(docs, num=85, den=100):
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    where = {}
    for i, s in sets.items():
        for g in s:
            where.setdefault(g, []).append(i)
    pairs = {}
    for ids in where.values():
        for a in range(len(ids)):
            for b in range(a):
                key = (min(ids[a], ids[b]), max(ids[a], ids[b]))
                pairs[key] = pairs.get(key, 0) + 1
    for (a, b), n in pairs.items():
        if den * n >= num * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def word_counts(docs):
    from collections import Counter

    c = Counter()
    for i, text in docs:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            c.update([*WORDS.findall(lower(text)), "\n"])
    return c


def _edges(word, weights, longest):
    return [(i, j, word[i:j]) for i in range(len(word)) for j in range(i + 1, min(len(word), i + longest) + 1) if word[i:j] in weights]


def _prefixes(word, weights, longest):
    """Chance of each prefix over its segmentations, in exact order of its ends."""
    chance = [1.0] + [0.0] * len(word)
    for i, j, piece in sorted(_edges(word, weights, longest), key=lambda e: (e[1], e[0])):
        chance[j] += chance[i] * weights[piece]
    return chance


def lattice_scores(docs, labels, pieces, prior, occurrences):
    """log10 probability of every text by the lattice model, trained on the rows that aren't held out.

    docs: (id, text); labels: class of each id; prior: the vocabulary's weights, which sum to 1.
    """
    import math
    from collections import Counter

    weights, longest = dict(zip(pieces, prior)), max(map(len, pieces))
    turned = {p[::-1]: x for p, x in weights.items()}
    words = lambda t: [w.encode() for w in WORDS.findall(lower(t))]
    train = [(labels[i], words(t)) for i, t in docs if zlib.crc32(str(i).encode()) % 7 != 2]
    expected = {p: occurrences * w for p, w in weights.items()}
    distinct = {w for _, ws in train for w in ws}
    for w in distinct:
        text = b" " + w
        ahead, back = _prefixes(text, weights, longest), _prefixes(text[::-1], turned, longest)
        for i, j, piece in _edges(text, weights, longest):
            expected[piece] += ahead[i] * weights[piece] * back[len(text) - j] / ahead[-1]
    first = sum(x for p, x in expected.items() if p[:1] == b" ")
    rest = sum(x for p, x in expected.items() if p[:1] != b" ") + len(distinct) + 1
    model, stop = {p: x / (first if p[:1] == b" " else rest) for p, x in expected.items()}, (len(distinct) + 1) / rest
    counts, texts = {}, Counter()
    for k, ws in train:
        counts.setdefault(k, Counter()).update([*ws, "end"])
        texts[k] += 1
    out, spelled = {}, {}
    for i, t in docs:
        chances = []
        for k, c in counts.items():
            n = sum(c.values())
            new = min(0.5, max(1e-4, sum(x == 1 for x in c.values()) / n))
            log = math.log10((texts[k] + 1) / (len(train) + len(texts))) + math.log10((1 - new) * c["end"] / n)
            for w in words(t):
                if w not in spelled:
                    spelled[w] = _prefixes(b" " + w, model, longest)[-1] * stop
                log += math.log10((1 - new) * c[w] / n + new * spelled[w])
            chances.append(log)
        top = max(chances)
        out[i] = top + math.log10(sum(10 ** (x - top) for x in chances))
    return out
