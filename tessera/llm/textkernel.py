"""Vectorised word and shingle hashes of UTF-8 text (numpy, inside tasks).

A word is a maximal run of bytes that a 256-entry table maps to a value above
0; the table also folds A-Z.  Multi-byte characters are never separators here,
so a byte rule equals the rule on code points.

A word is hashed in blocks of eight bytes.  A block's sum takes a random value
per (place in the block, byte); the sum and the block's number go through a
nonlinear mix before the blocks of a word are added up, so no arrangement of
the same bytes over a long word cancels out.  Given words collide by chance
only, at about 2^-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_RNG = np.random.default_rng(20240229)
_VALUE = _RNG.integers(1, 1 << 63, size=8 * 257, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SHINGLE = _RNG.integers(1, 1 << 63, size=64, dtype=np.uint64) | np.uint64(1)
#: Bytes handled at once; a word is never cut.
BLOCK = 1 << 18


def word_table(is_word) -> np.ndarray:
    """256 entries: 0 for a separator, else 1 + the byte, A-Z folded."""
    t = np.zeros(256, np.uint16)
    for b in range(256):
        low = b + 32 if 65 <= b <= 90 else b
        t[b] = low + 1 if is_word(low) else 0
    return t


#: words `[^\x20\x09-\x0D]+`, A-Z folded
SPACED = word_table(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of A-Z folded text
ALNUM = word_table(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A)


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


def word_hashes(buf: np.ndarray, offsets: np.ndarray, table: np.ndarray,
                prefixes: tuple[int, ...] = (), spans: bool = False) -> tuple:
    """(hash of every word, words before each text [n+1 offsets]) of the texts
    ``buf[offsets[i]:offsets[i+1]]``; with ``prefixes`` also, per prefix
    length in bytes (8 at most), the hash of each word's start (0 where it is
    no longer); with ``spans`` also (start of each word in ``buf``, its bytes)."""
    assert all(k <= 8 for k in prefixes)
    n = len(offsets) - 1
    hashes, starts_at, sizes, pre = [], [], [], [[] for _ in prefixes]
    lo, hi = int(offsets[0]), int(offsets[-1])
    edges = offsets[:-1][np.diff(offsets) > 0]
    cut = np.unique(edges)
    for a, b in _cut_blocks(buf, lo, hi, table, cut):
        norm = table[buf[a:b]]
        on = norm != 0
        first = on.copy()
        first[1:] &= ~on[:-1]
        inside = cut[np.searchsorted(cut, a):np.searchsorted(cut, b)] - a
        first[inside] = on[inside]
        at = np.flatnonzero(on)
        if not len(at):
            continue
        starts = np.flatnonzero(first)
        wid = np.cumsum(first[at]) - 1
        place = at - starts[wid]
        value = _VALUE[(place & 7) * 257 + norm[at]]
        begin = np.flatnonzero(first[at])
        block = np.flatnonzero((place & 7) == 0)
        number = (place[block] >> 3).astype(np.uint64)
        mixed = mix(np.add.reduceat(value, block) + number * _STEP)
        hashes.append(mix(np.add.reduceat(mixed, np.searchsorted(block, begin))))
        starts_at.append(starts + a)
        length = np.diff(np.append(begin, len(at)))
        sizes.append(length)
        if prefixes:
            for k, out in zip(prefixes, pre, strict=True):
                h = np.zeros(len(begin), np.uint64)
                long = length > k
                at_k = begin[long]
                s = np.zeros(len(at_k), np.uint64)
                for j in range(k):
                    s += value[at_k + j]
                h[long] = mix(s + np.uint64(k))
                out.append(h)
    words = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    where = np.concatenate(starts_at) if starts_at else np.zeros(0, np.int64)
    counts = np.searchsorted(where, offsets)
    assert len(counts) == n + 1
    if spans:
        return words, counts, where, np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
    if prefixes:
        return words, counts, [np.concatenate(p) if p else np.zeros(0, np.uint64) for p in pre]
    return words, counts


def _cut_blocks(buf, lo, hi, table, cut) -> Iterator[tuple[int, int]]:
    """Blocks that end between words: at a separator or at the start of a text."""
    a = lo
    while a < hi:
        e = min(a + BLOCK, hi)
        k = int(np.searchsorted(cut, e))
        nxt = int(cut[k]) if k < len(cut) else hi
        while e < hi and e < nxt and table[buf[e]] and table[buf[e - 1]]:
            e += 1
        yield a, e
        a = e


def hash_words(words: list[str], table: np.ndarray) -> np.ndarray:
    """Hashes of given strings (each holding exactly one word)."""
    raw = [w.encode() for w in words]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    return word_hashes(np.frombuffer(b"".join(raw), np.uint8), offsets, table)[0]


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` consecutive words of one text; a text of
    fewer words, but not none, is one run (of its own length)."""
    if not len(h):
        return h
    w = min(k, len(h))
    m = len(h) - w + 1
    s = np.full(m, w, np.uint64)
    for j in range(w):
        s += h[j:j + m] * _SHINGLE[j]
    return mix(s)
