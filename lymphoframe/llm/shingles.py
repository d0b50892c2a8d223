"""Word shingles of whole texts as arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np

_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit (array arithmetic wraps)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts' UTF-8 bytes (a line feed behind each), every word's first byte and length, words per text."""
    bodies = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b"\n".join([*bodies, b"\0" * 8]), np.uint8)  # eight more: words are read eight bytes at a time
    end = len(raw) - 8
    inside = ~_SPACES[raw[:end]]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edges = np.append(0, edges)
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    bounds = np.cumsum([len(b) + 1 for b in bodies])
    counts = np.diff(np.append(0, np.searchsorted(starts, bounds)))
    return raw, starts, lengths, counts


def hash_words(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, eight at a time."""
    eights = np.lib.stride_tricks.as_strided(raw, (len(raw) - 7, 8), (1, 1))
    out = lengths.astype(np.uint64) * _ODD
    left = np.arange(len(starts))
    at = 0
    while len(left):
        room = lengths[left] - at
        part = eights[starts[left] + at].copy().view("<u8").ravel()
        part &= _MASKS[np.minimum(room, 8)]
        out[left] = mix(out[left] ^ part)
        left = left[room > 8]
        at += 8
    return out


def word_hashes(texts: list[str | None], fold: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of every text, in order, and the number of words per text. ``fold`` lowers A-Z."""
    raw, starts, lengths, counts = words_of(texts)
    return hash_words(_FOLD[raw] if fold else raw, starts, lengths), counts


def shingle_sets(texts: list[str | None], size: int = 5) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its ``size``-word shingles (A-Z lowered); a text with
    fewer words has its whole sequence as the one shingle, a text without words none."""
    words, counts = word_hashes(texts, fold=True)
    out, at = [], 0
    for n in counts.tolist():
        mine, at = words[at : at + n], at + n
        width = min(n, size)
        if not width:
            out.append(np.empty(0, np.uint64))
            continue
        grams = np.zeros(n - width + 1, np.uint64)
        for k in range(width):
            grams = mix(grams * _ODD + mine[k : n - width + 1 + k])
        out.append(np.unique(grams))
    return out
