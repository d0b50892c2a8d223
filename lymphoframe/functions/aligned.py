"""Aligned regions in Arrow columns: letters, codons and sums of a whole batch at once, with numpy.

What ``functions/codons.py`` says letter by letter as Column expressions is said here for all rows of a
batch: their letters are one array of bytes, three of which are a codon. Any lengths, nulls and letters
are allowed; nothing is padded, so a batch takes a few times its own size.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lymphoframe.functions.codons import AMBIGUOUS, BASES, codon_table
from lymphoframe.schema import POSITIONS, REGIONS

_SYMBOLS = BASES + "".join(AMBIGUOUS)
_GAP, _OTHER = len(_SYMBOLS), len(_SYMBOLS) + 1
_BASE = _OTHER + 1


def text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The letters of all rows as bytes, and where each row begins (and the last one ends). A letter beyond ASCII
    is one ``?``, or what its upper case is in ASCII; null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    data, at = _bytes(column)
    if (data > 127).any():
        column = pc.replace_substring(column, "ſ", "S")  # the only one whose upper case is a base's letter
        data, at = _bytes(pc.replace_substring_regex(column, "[^\\x00-\\x7F]", "?"))
    return data, at


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def codons(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole codons of all rows (a row of three bytes each), and how many each row has."""
    size = np.diff(at)
    left = size % 3
    if left.any():
        keep = np.ones(len(data), bool)
        keep[at[1:][left > 0] - 1] = False
        keep[at[1:][left > 1] - 2] = False
        data = data[keep]
    return data.reshape(-1, 3), size // 3


def gaps(data: np.ndarray) -> np.ndarray:
    return (data == ord(".")) | (data == ord("-"))


def _all_gaps(found: np.ndarray) -> np.ndarray:
    a, b, c = gaps(found).T
    return a & b & c


def _by_row(flags: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How many flags of each row are set."""
    if len(counts) and (counts == counts[0]).all():
        return np.count_nonzero(flags.reshape(len(counts), -1), axis=1)
    ends = np.cumsum(counts)
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[ends] - total[ends - counts]


def texts(letters: np.ndarray, valid: pa.Array | None = None) -> pa.Array:
    """Rows of as many letters each (ASCII) as a column of texts; null where ``valid`` is given and false."""
    ends = np.arange(len(letters) + 1, dtype=np.int64) * letters.shape[1]
    found = pa.LargeStringArray.from_buffers(len(letters), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(letters)))
    return found if valid is None else pc.if_else(valid, found, pa.scalar(None, pa.large_string()))


def letters(column: pa.Array, width: int) -> np.ndarray:
    """Texts of ``width`` ASCII letters each as rows of bytes; zeros for null."""
    return _bytes(column.fill_null("\0" * width).cast(pa.large_string()))[0].reshape(len(column), width)


def mapped(letters: np.ndarray, table: bytes) -> np.ndarray:
    """Bytes by a table of 256; several times as fast as numpy's indexing."""
    return np.frombuffer(letters.tobytes().translate(table), np.uint8).reshape(letters.shape)


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Symbols by byte, amino letters by three symbols."""
    symbol = np.full(256, _OTHER, np.int16)
    for i, c in enumerate(_SYMBOLS):
        symbol[[ord(c), ord(c.lower())]] = i
    symbol[[ord("."), ord("-")]] = _GAP
    letter = np.full((_BASE, _BASE, _BASE), ord("X"), np.uint8)
    for codon, amino in codon_table().items():
        places = [[_SYMBOLS.index(c), _GAP] if c == "N" else [_SYMBOLS.index(c)] for c in codon]
        letter[np.ix_(*places)] = ord(amino)
    letter[_GAP, _GAP, _GAP] = ord(".")
    return symbol, letter.ravel()


def translated(column: pa.Array) -> pa.Array:
    """As ``codons.translate``: a letter per codon."""
    symbol, letter = _tables()
    found, counts = codons(*text(column))
    x = symbol[found]
    letters = letter[(x[:, 0] * _BASE + x[:, 1]) * _BASE + x[:, 2]]
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(column), pa.py_buffer(ends), pa.py_buffer(letters))


def lengths(column: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Letters that are no gap (null for null), and whole codons that are not all gaps."""
    data, at = text(column)
    found, counts = codons(data, at)
    letters = _by_row(~gaps(data), np.diff(at)).astype(np.int32)
    return pa.array(letters, mask=np.asarray(column.is_null())), pa.array(_by_row(~_all_gaps(found), counts).astype(np.int32))


def mutable(regions: list[pa.Array]) -> np.ndarray:
    """Rows by positions: whether the regions (in order) have a codon there that is no gap; the rest of a codon
    at the end counts as one."""
    out = np.zeros((len(regions[0]), POSITIONS), bool)
    for column, (first, last) in zip(regions, REGIONS.values(), strict=True):
        n, (data, at) = last - first + 1, text(column)
        found, counts = codons(data, at)
        full, part = ~_all_gaps(found), out[:, first - 1 : last]
        if (counts == n).all():
            part[:] = full.reshape(-1, n)
            continue
        row = np.repeat(np.arange(len(counts)), counts)
        place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        part[row[place < n], place[place < n]] = full[place < n]
        rest = np.flatnonzero((np.diff(at) % 3 > 0) & (counts < n))
        part[rest, counts[rest]] = True
    return out


def packed(values: np.ndarray) -> pa.Array:
    """Rows of numbers as bytes."""
    width = values.shape[1] * values.itemsize
    ends = np.arange(len(values) + 1, dtype=np.int64) * width
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(values), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def unpacked(column: pa.Array, kind: str) -> np.ndarray:
    return _bytes(column.cast(pa.large_binary()))[0].view(kind).reshape(len(column), POSITIONS)


def numbers(column: pa.Array) -> np.ndarray:
    """A column of lists with a number (null: 0) per position, as rows of numbers."""
    return np.asarray(column.flatten().fill_null(0)).reshape(len(column), POSITIONS)


def groups(columns: list[pa.Array], n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first row of each distinct key, and every row's key: texts, numbers or lists of them, nulls alike."""
    key, first = np.zeros(n, np.int64), np.zeros(min(n, 1), np.int64)
    for column in columns:
        codes = np.asarray(_coded(column))
        _, first, key = np.unique(key * (int(codes.max(initial=0)) + 1) + codes, return_index=True, return_inverse=True)
    return first, key


def _coded(column: pa.Array) -> pa.Array:
    if pa.types.is_list(column.type):
        flat, size = np.asarray(_coded(column.flatten()), np.int32).tobytes(), np.asarray(pc.list_value_length(column).fill_null(-1))
        ends = np.cumsum(np.maximum(size, 0)) * 4
        column = pa.array([None if k < 0 else flat[end - 4 * k : end] for k, end in zip(size.tolist(), ends.tolist(), strict=True)], pa.binary())
    return column.dictionary_encode(null_encoding="encode").indices
