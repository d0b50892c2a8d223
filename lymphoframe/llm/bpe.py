"""Byte-level BPE encoding and decoding as Spark jobs over Arrow batches.

Texts are split by the tokenizer's pattern; each distinct pre-token is merged once a worker and
kept in a bounded cache. Merging works on a linked list of byte spans. A queue over merge ranks
picks the next merge: every rank has a bucket of list positions (leftmost first), and a bitmap of
256-bit words, with a bitmap over its words, marks the ranks whose buckets hold entries.
Find-first-set on both levels leads to the lowest rank. A merge changes its neighbours' pairs; their
old entries stay in the buckets and are skipped when they come up. A pre-token of n bytes takes
O(n log n) steps, so one run of letters as long as a book is no problem.

Defined results: null text counts as empty and has no ids; ids of repeated rows are equal; other
columns pass through, older ``ids`` and ``decoded`` are replaced; an id outside the vocabulary makes ``decode`` fail.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lymphoframe.llm.common import small_batches, table

#: Cached pre-tokens a worker in each of two generations, and the longest that is cached.
CACHED, LONGEST = 400_000, 64
#: A bitmap word has 2**BITS bits.
BITS = 8
MASK = (1 << BITS) - 1
BIT = [1 << k for k in range(1 << BITS)]


class Encoder(dict):
    """Pre-token (str) -> tuple of ids, made when first asked for. Two generations: when the young
    one is full it becomes the old one, from which pre-tokens still in use come back."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks, self.old = ranks, {}
        # the rank queue, empty between pre-tokens: list positions by rank, and the bitmap of ranks in use
        self.buckets: dict[int, list[int]] = {}
        self.words = [0] * ((max(ranks.values()) >> BITS) + 1)

    def __missing__(self, piece: str) -> tuple[int, ...]:
        if len(piece) > LONGEST:
            return tuple(self.merge(piece.encode("utf-8", "surrogatepass")))
        if len(self) >= CACHED:
            self.old = dict(self)
            self.clear()
        ids = self.old.get(piece)
        if ids is None:
            ids = tuple(self.merge(piece.encode("utf-8", "surrogatepass")))
        self[piece] = ids
        return ids

    def merge(self, piece: bytes) -> list[int]:
        get, n = self.ranks.get, len(piece)
        if (whole := get(piece)) is not None:
            return [whole]
        buckets, words, top = self.buckets, self.words, 0  # top: which words have bits
        after = list(range(1, n + 1))  # where the span that begins here ends
        before = list(range(-1, n - 1))  # where the span before it begins
        waiting = [get(piece[i : i + 2]) for i in range(n - 1)]  # the rank now valid for the pair that begins here
        waiting.append(None)
        fresh = [(r, i) for i, r in enumerate(waiting) if r is not None]
        while True:
            for r, i in fresh:
                if r in buckets:
                    heapq.heappush(buckets[r], i)
                else:
                    buckets[r] = [i]
                    words[r >> BITS] |= BIT[r & MASK]
                    top |= BIT[r >> BITS]
            fresh = []
            if not top:
                break
            # find first set: the word with the lowest ranks, the lowest rank in it
            w = (top & -top).bit_length() - 1
            word = words[w]
            bit = word & -word
            r = w << BITS | bit.bit_length() - 1
            bucket = buckets[r]
            if len(bucket) > 1:
                i = heapq.heappop(bucket)
            else:
                i = bucket[0]
                del buckets[r]
                words[w] = word = word ^ bit
                if not word:
                    top ^= BIT[w]
            if waiting[i] != r:
                continue  # stale
            mid = after[i]
            end = after[i] = after[mid]
            waiting[mid] = waiting[i] = None
            if end < n:
                before[end] = i
                if (new := get(piece[i : after[end]])) is not None:
                    waiting[i] = new
                    fresh.append((new, i))
            if (left := before[i]) >= 0:
                waiting[left] = new = get(piece[left:end])
                if new is not None:
                    fresh.append((new, left))
        ids, i = [], 0
        while i < n:
            ids.append(get(piece[i : after[i]]))
            i = after[i]
        return ids


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> tuple[Encoder, regex.Pattern]:
    return Encoder(load_ranks(path)), regex.compile(pattern)


@lru_cache(maxsize=2)
def _pieces(path: str) -> tuple[np.ndarray, np.ndarray]:
    """All tokens' bytes laid end to end, and where each id's begin."""
    ranks = load_ranks(path)
    by_id = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        by_id[rank] = token
    return np.frombuffer(b"".join(by_id), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in by_id])])


def encode(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """Adds ``ids``: array<int>. ``path``: a rank file that every executor can read."""
    df = df.drop("ids")
    schema = T.StructType([*df.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType(), False))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, splitter = _encoder(path, pattern)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            lists = [np.fromiter(chain.from_iterable(map(encoder.__getitem__, splitter.findall(x))), np.int32) if x else np.empty(0, np.int32) for x in texts]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.empty(0, np.int32), *lists])))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=schema.fieldNames())

    small_batches(df.sparkSession)
    return df.mapInArrow(work, schema)


def decode(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """Adds ``decoded``: the ids' bytes (binary, since ids may cut a character)."""
    df = df.drop("decoded")
    schema = T.StructType([*df.schema.fields, T.StructField("decoded", T.BinaryType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        body, starts = _pieces(path)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            if len(flat) and (flat.min() < 0 or flat.max() + 1 >= len(starts)):
                raise ValueError("id outside the vocabulary")
            sizes = starts[flat + 1] - starts[flat]
            ends = np.concatenate([[0], np.cumsum(sizes)])
            # every byte's place in the table: its token's start plus its distance from the token's first byte
            places = np.arange(ends[-1]) + np.repeat(starts[flat] - ends[:-1], sizes)
            offsets = np.concatenate([[0], np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
            out = pa.Array.from_buffers(pa.binary(), len(column), [None, pa.py_buffer(ends[offsets].astype(np.int32).tobytes()), pa.py_buffer(body[places].tobytes())])
            yield pa.RecordBatch.from_arrays([*batch.columns, out], names=schema.fieldNames())

    small_batches(df.sparkSession)
    return df.mapInArrow(work, schema)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode(docs, path, public_tokenizers.PATTERN).select("doc_id", "ids")
    back = decode(coded, path)
    return back.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
