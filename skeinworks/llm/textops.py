"""Batch text helpers: word arrays with document bounds, and stable 64-bit hashes, in numpy."""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

WORDS = re.compile(r"[^\W_]+")  # letters or digits, no underscore
LATIN_WORDS = re.compile(r"[a-z0-9]+")
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def word_lists(texts: list[str | None], pattern: re.Pattern = WORDS) -> list[list[str]]:
    return [pattern.findall(t.lower()) if t else [] for t in texts]


def hash_strings(strings: list[str]) -> np.ndarray:
    """The same 64-bit hash for a string in every process; never 0 or 1."""
    if not strings:
        return np.zeros(0, np.uint64)
    codes, uniques = pd.factorize(np.array(strings, dtype=object))
    h = pd.util.hash_array(np.asarray(uniques, dtype=object), categorize=False).astype(np.uint64)
    return np.maximum(h, np.uint64(2))[codes]


def hash_word_lists(lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """All words' hashes in one array, and the offsets of each list in it."""
    offsets = np.zeros(len(lists) + 1, np.int64)
    np.cumsum([len(x) for x in lists], out=offsets[1:])
    return hash_strings(list(chain.from_iterable(lists))), offsets


def run_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """The hash of each run of k consecutive values of h, bounds between documents not regarded."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * _BASE + h[i : i + n]
    return mix(out)


def owners(offsets: np.ndarray) -> np.ndarray:
    """The list number of each position."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


_LATIN = np.zeros(256, np.uint8)  # 0: between words; else the lower-case byte
for _c in b"abcdefghijklmnopqrstuvwxyz0123456789":
    _LATIN[_c] = _c
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _LATIN[_c] = _c + 32
_P = 0x100000001B3F2D5B | 1
_P_INV = pow(_P, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    if n > 1:
        out[1:] = np.uint64(base & (2**64 - 1))
        np.multiply.accumulate(out, out=out)
    return out


_POW, _POW_INV = _powers(_P, 1 << 20), _powers(_P_INV, 1 << 20)


def hash_latin_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the maximal runs of a-z and 0-9 in the lower-cased texts, and each text's offsets; nulls have none.

    Works on the UTF-8 bytes of the whole batch: a byte outside the 36 ends a word, so the bytes of other
    scripts need no decoding. Only two other characters have a lower case within a-z (the Kelvin sign, the
    dotted capital I); a batch that holds one goes through Python's lower().
    """
    texts = texts.cast(pa.large_string())
    raw = texts.to_pylist() if pc.any(pc.match_substring_regex(texts, "K|İ")).as_py() else None
    if raw is not None:
        texts = pa.array([None if t is None else t.lower() for t in raw], pa.large_string())
    texts = texts.fill_null("")
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[off[0] : off[-1]] if len(texts) else np.zeros(0, np.uint8)
    off = off - off[0] if len(off) else np.zeros(1, np.int64)
    hashes, counts, start = [], np.zeros(len(off) - 1, np.int64), 0
    while start < len(off) - 1:  # about a megabyte of text at a time, at least one text
        end = max(start + 1, int(np.searchsorted(off, off[start] + (1 << 20), "right")) - 1)
        h, n = _latin_chunk(data[off[start] : off[end]], off[start : end + 1] - off[start])
        hashes.append(h)
        counts[start:end] = n
        start = end
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), np.r_[0, np.cumsum(counts)]


def _latin_chunk(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = _LATIN[data]
    n = len(low)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(off) - 1, np.int64)
    word = low != 0
    starts = word.copy()
    starts[1:] &= ~word[:-1]
    bound = off[1:-1]
    bound = bound[bound < n]
    starts[bound] = word[bound]  # a text's first byte starts a word even if the last text ended in one
    ends = word.copy()
    ends[:-1] &= ~word[1:] | starts[1:]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    up, down = (_POW, _POW_INV) if n < len(_POW) else (_powers(_P, n + 1), _powers(_P_INV, n + 1))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(low.astype(np.uint64) * up[:n], out=total[1:])
    h = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64) * _BASE)
    return np.maximum(h, np.uint64(2)), np.diff(np.searchsorted(s, off))


def shingle_sets(h: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The set of k-word runs of each text as sorted 50-bit values, and each set's offsets. At most 16384 texts."""
    grams = run_hashes(h, k)
    own = owners(offsets)
    if len(grams):
        inside = own[: len(grams)] == own[k - 1 :]
        grams, own = grams[inside], own[: len(inside)][inside]
    else:
        own = own[:0]
    return value_sets(grams, own, len(offsets) - 1)


SET_BITS = 50


def value_sets(values: np.ndarray, own: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 50-bit values of each owner (fewer than 16384), and offsets."""
    if n > 1 << (64 - SET_BITS):
        raise ValueError("too many texts at a time")
    key = own.astype(np.uint64) << np.uint64(SET_BITS) | values >> np.uint64(64 - SET_BITS)
    key.sort()  # plain sorting is far faster here than np.unique's hash table
    key = key[np.r_[True, key[1:] != key[:-1]]] if len(key) else key
    return key & np.uint64(2**SET_BITS - 1), np.searchsorted(key >> np.uint64(SET_BITS), np.arange(n + 1))
