"""Packing by lexical retrieval: BM25 picks the documents that share a window.

Pass 1 (no shuffle) turns each document into token ids, with a 0 behind them. Its full windows are
sequences of their own; what is left goes on with a lexical key: two weighted min-hashes of its ids,
so that documents with the same telling ids sort together. Ids seen in each task are counted, and
the counts summed, to one number per id of the vocabulary (the only thing broadcast, bounded by it).

Pass 2 deals the remainders to key ranges (ties by doc_id, so no key is too large for a task) and
indexes them in shards of ``SHARD`` documents: an inverted index with BM25 weights, document
frequencies and the mean length from the whole corpus. A window starts with a seed, takes the unused
documents that the index returns for it, best first, and cuts the last one; its rest seeds the next
window. Where the index returns too few, the next unused ones in key order follow. The open window
carries over from shard to shard; what is open at the end of a task is cut at powers of two, which
need no padding.

A query is every id of the seed: no entry of the index is left out, so that the order is that of BM25 over all unused
documents of the shard. Ids that many of them have are kept as rows of weights (``ROWS`` at most), which are added
whole; the lists of the others are short. Which neighbours a seed can get is bounded by its shard: README
gives the share of true best neighbours.

Defined results: null text counts as empty and is one 0; repeated rows are packed once each, told
apart by nothing but their place; every id lies in exactly one piece; columns other than doc_id and
text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lymphoframe.llm.common import cut, partitions, small_batches, table

WINDOW = 1024
SHARD = 4096
#: Ids with more entries in a shard are kept as rows of weights, the ``ROWS`` most frequent of them (32 MB).
POSTINGS = 64
ROWS = 1024
#: Documents that are ranked first; the others only if these don't fill the window.
FIRST = 32
K1, B = 1.2, 0.75
END = 0

_PASS1 = "doc_id long, kind int, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, key1 long, key2 long, ids binary"
_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


@lru_cache(maxsize=1)
def _tokenizer(path: str):
    """The vocabulary of a byte-level BPE file of the ``tokenizers`` library, run by ``tiktoken``
    (equal ids, several times the speed), and the size of the vocabulary."""
    import json

    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    # byte-level vocabularies write bytes as letters: printable ones as they are, the rest from U+0100 on
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(x for x in range(256) if x not in set(plain))}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special), max([*ranks.values(), *special.values()]) + 1


def _ids(tokenizer, text: str | None) -> np.ndarray:
    special = text and any(s in text for s in tokenizer.special_tokens_set)
    found = tokenizer.encode_to_numpy(text or "", allowed_special="all" if special else set(), disallowed_special=())
    return np.append(found, np.uint32(END))


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x.astype(np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=4)
def _draws(vocabulary: int, seed: int) -> np.ndarray:
    """Every id's number in a draw weighted by rarity (late merges are rarer): a document's key is its id
    with the smallest; the same set, the same winner."""
    terms = np.arange(vocabulary)
    u = (_mix(terms, seed) >> np.uint64(11)).astype(np.float64) / 2**53 + 1e-18
    return (-np.log(u) / np.log(2.0 + terms)).astype(np.float32)


def _columns(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def tokenized(docs: DataFrame, path: str) -> DataFrame:
    """Pass 1. Rows of kind 0: full windows; 1: remainders with ids and keys; 2: a task's counts of documents per id."""
    schema = pa.schema([("doc_id", pa.int64()), ("kind", pa.int32()), *[(c, pa.int64()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "key1", "key2")], ("ids", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, vocabulary = _tokenizer(path)
        one, two = _draws(vocabulary, 1), _draws(vocabulary, 2)
        counts, n_docs, n_rest, left, made, rows = np.zeros(vocabulary, np.int64), 0, 0, 0, 0, []
        base = TaskContext.get().partitionId() << 32
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = _ids(tokenizer, text)
                terms = np.unique(ids)
                n, n_docs = len(ids), n_docs + 1
                counts[terms] += 1
                full = n // WINDOW * WINDOW
                for start in range(0, full, WINDOW):
                    rows.append((doc_id, 0, start, WINDOW, zlib.crc32(ids[start : start + WINDOW].tobytes()), n, (base | made) * 2, 0, 0, None))
                    made += 1
                if full < n:
                    rest = ids[full:]
                    terms = np.unique(rest) if full else terms
                    rows.append((doc_id, 1, full, n - full, 0, n, 0, int(terms[one[terms].argmin()]), int(terms[two[terms].argmin()]), rest.astype("<u4").tobytes()))
                    n_rest, left = n_rest + 1, left + n - full
            if rows:
                yield _columns(rows, schema)
                rows = []
        yield _columns([(None, 2, n_rest, n_docs, left, 0, 0, 0, 0, counts.astype("<i8").tobytes())], schema)

    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(work, _PASS1)


def corpus_counts(pass1: DataFrame, vocabulary: int) -> tuple[np.ndarray, int, float]:
    """Documents per id, documents in all, and the remainders' mean length: the tasks' counts, summed in
    groups and then here."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums = np.zeros(vocabulary, np.int64), np.zeros(3, np.int64)
        for batch in batches:
            for body, *numbers in zip(*[batch.column(k).to_pylist() for k in range(4)], strict=True):
                total += np.frombuffer(body, "<i8")
                sums += numbers
        yield pa.RecordBatch.from_pydict({"ids": [total.astype("<i8").tobytes()], "docs": sums[:1], "rests": sums[1:2], "left": sums[2:]})

    parts = pass1.where("kind = 2").select("ids", F.col("length").alias("docs"), F.col("start").alias("rests"), F.col("ids_crc32").alias("left"))
    for n in (16, 1):  # few tasks: each sum is as long as the vocabulary
        parts = parts.repartition(n).mapInArrow(added, "ids binary, docs long, rests long, left long")
    row = parts.collect()[0]
    return np.frombuffer(row["ids"], "<i8"), row["docs"], max(1.0, row["left"] / max(row["rests"], 1))


class _Shard:
    """An inverted index of neighbours in key order: per id the documents that have it and their weights."""

    def __init__(self, docs: list[tuple], idf: np.ndarray, mean: float):
        self.idf, self.n = idf, len(docs)
        size = np.array([len(d[3]) for d in docs])
        pairs = np.sort(np.concatenate([d[3] for d in docs]).astype(np.int64) * SHARD + np.repeat(np.arange(self.n), size))
        first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
        tf = np.diff(np.append(first, len(pairs))).astype(np.float64)
        term, self.doc = pairs[first] // SHARD, pairs[first] % SHARD
        self.weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[self.doc] / mean))
        self.first = np.flatnonzero(np.append(True, term[1:] != term[:-1]))
        self.vocabulary, self.sizes = term[self.first], np.diff(np.append(self.first, len(term)))
        slot = np.repeat(np.arange(len(self.first)), self.sizes)
        by_doc = np.argsort(self.doc, kind="stable")
        self.slots, self.bounds = slot[by_doc], np.searchsorted(self.doc[by_doc], np.arange(self.n + 1))
        self.unused, self.next = np.ones(self.n, bool), 0
        frequent = np.argsort(-self.sizes, kind="stable")[:ROWS]
        frequent = frequent[self.sizes[frequent] > POSTINGS]
        self.row = np.full(len(self.sizes), -1)
        self.row[frequent] = np.arange(len(frequent))
        self.rows = np.zeros((len(frequent), self.n))
        row = self.row[slot]
        self.rows[row[row >= 0], self.doc[row >= 0]] = self.weight[row >= 0]

    def query(self, ids: np.ndarray) -> np.ndarray:
        """The slots of ids from elsewhere."""
        ids = np.unique(ids)
        at = np.minimum(np.searchsorted(self.vocabulary, ids), len(self.vocabulary) - 1)
        return at[self.vocabulary[at] == ids]

    def own(self, doc: int) -> np.ndarray:
        return self.slots[self.bounds[doc] : self.bounds[doc + 1]]

    def scores(self, slots: np.ndarray) -> np.ndarray:
        """BM25 of every unused document, 0 for a used one."""
        row = self.row[slots]
        scores, slots = np.zeros(self.n), slots[row < 0]
        for k in row[row >= 0].tolist():
            scores += self.rows[k]
        sizes = self.sizes[slots]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.first[slots] - ends + sizes, sizes)
        return (scores + np.bincount(self.doc[places], self.weight[places], self.n)) * self.unused

    def ranked(self, slots: np.ndarray) -> np.ndarray:
        """Unused documents with a score, best first (ties in their order)."""
        return self._sorted(self.scores(slots), 0)

    @staticmethod
    def _sorted(scores: np.ndarray, above: float) -> np.ndarray:
        left = np.flatnonzero(scores > above)
        return left[np.argsort(-scores[left], kind="stable")]

    def in_turn(self, slots: np.ndarray) -> Iterator[int]:
        """As ``ranked``, one by one: most windows take a few."""
        scores = self.scores(slots)
        above = float(np.partition(scores, -FIRST)[-FIRST]) if self.n > FIRST else 0.0
        yield from self._sorted(scores, above).tolist()
        if above > 0:
            yield from self._sorted(np.where(scores > above, 0, scores), 0).tolist()

    def following(self) -> Iterator[int]:
        """Unused documents in key order."""
        while True:
            while self.next < self.n and not self.unused[self.next]:
                self.next += 1
            if self.next == self.n:
                return
            yield self.next


def packed(pass1: DataFrame, frequencies: np.ndarray, n_docs: int, mean: float) -> DataFrame:
    """Pass 2: pieces of the remainders."""
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])
    spark = pass1.sparkSession
    idf = spark.sparkContext.broadcast(np.log1p((n_docs - frequencies + 0.5) / (frequencies + 0.5)).astype(np.float64))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, base = idf.value, TaskContext.get().partitionId() << 32
        made, window, room, seed = 0, [], WINDOW, None  # window: (doc_id, start, doc_tokens, ids)
        out: list[tuple] = []

        def emit(pieces: list[tuple]) -> None:
            nonlocal made
            offset = 0
            for doc_id, start, total, ids in pieces:
                out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), total, (base | made) * 2 + 1, offset))
                offset += len(ids)
            made += 1

        def put(doc: tuple) -> None:
            """Fill the open window; windows that get full go out."""
            nonlocal window, room, seed
            doc_id, start, total, ids = doc
            while len(ids) >= room:
                window.append((doc_id, start, total, ids[:room]))
                emit(window)
                start, ids, window, room = start + room, ids[room:], [], WINDOW
            if len(ids):
                window.append((doc_id, start, total, ids))
                room -= len(ids)

        def pack(docs: list[tuple]) -> None:
            nonlocal seed
            shard = _Shard(docs, weights, mean)
            slots = shard.query(seed) if window else None
            for start in shard.following():
                if not window:  # nothing open: the first unused document is the seed
                    slots = shard.own(start)
                    shard.unused[start] = False
                    seed = docs[start][3]
                    put(docs[start])
                    continue
                before = made
                for k in chain(shard.in_turn(slots), shard.following()):
                    shard.unused[k] = False
                    put(docs[k])
                    if made > before:  # what is left of the last one seeds the next window
                        slots, seed = shard.own(k), docs[k][3]
                        break

        shard: list[tuple] = []
        for batch in batches:
            for doc_id, start, total, ids in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                shard.append((doc_id, start, total, np.frombuffer(ids, "<u4")))
                if len(shard) == SHARD:
                    pack(shard)
                    shard = []
            if out:
                yield _columns(out, schema)
                out.clear()
        if shard:
            pack(shard)
        while window:  # the open window, cut at powers of two
            most, first, rest = 1 << (WINDOW - room).bit_length() - 1, [], []
            for doc_id, start, total, ids in window:
                took = min(len(ids), most)
                most -= took
                if took:
                    first.append((doc_id, start, total, ids[:took]))
                if took < len(ids):
                    rest.append((doc_id, start + took, total, ids[took:]))
            emit(first)
            window, room = rest, room + sum(len(x[3]) for x in first)
        if out:
            yield _columns(out, schema)

    small_batches(spark)
    rest = pass1.where("kind = 1").select("doc_id", "start", "doc_tokens", "ids", "key1", "key2")
    order = ["key1", "key2", "doc_id", "start"]
    dealt = rest.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    return dealt.select("doc_id", "start", "doc_tokens", "ids").mapInArrow(work, _PIECE)


def pack(docs: DataFrame, path: str) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    pass1 = cut(tokenized(docs, path), "packing")
    found, n_docs, mean = corpus_counts(pass1, _tokenizer(path)[1])
    full = pass1.where("kind = 0").select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.lit(0).cast("long").alias("offset"))
    return full.unionByName(packed(pass1, found, n_docs, mean))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
