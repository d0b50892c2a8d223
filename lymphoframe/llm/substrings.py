"""Substring dedup: words in passages that occur more than once, by suffix automata over reference shards.

One automaton of the whole corpus fits no machine, and streaming every document through every shard of
it takes work that grows with the square of the corpus. So shards are cut by content: a window of
``WINDOW`` words belongs to its anchor, the ``GRAM``-word sequence in it with the smallest hash
(leftmost of equals). Equal windows have equal anchors, hence meet in one shard; neighbouring windows
mostly share their anchor, and make one segment of at most ``2 * WINDOW - GRAM`` words.

1. One pass over the texts lists each document's segments (anchor hash, segment hash, bytes). Anchors
   that occur once are done: their windows occur once.
2. Equal segments are told once, with their number. An anchor with one such segment needs no
   automaton: all its windows are repeated. Where an anchor has several, their texts are fetched
   (each from one document) and dealt by anchor.
3. A shard's automaton is built over its segments, end positions weighted by their numbers; each
   segment is streamed through it for matching statistics, cut back to ``WINDOW`` words, and a window
   is repeated where its state occurs twice or more. An anchor with more than ``HOT`` segments (a
   common passage at its edges, where every document goes on differently) is not gathered in a
   task: its windows are counted one by one by their 128-bit hashes, spread over all tasks.
4. The windows' bits go back to the documents, and covered words are removed from whole texts.

Windows are judged on the input. Defined results: null and empty texts have no words; a text
shorter than a window loses none; rows that repeat doc_id and text count as occurrences of their own;
columns but doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lymphoframe.llm.common import cut, partitions, small_batches, table
from lymphoframe.llm.graph import whole_groups
from lymphoframe.llm.shingles import hash_words, mix, words_of

WINDOW = 35
GRAM = 12
HOT = 512
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPAN = WINDOW - GRAM + 1  # grams in a window, and at most as many windows to an anchor
_PLACE = np.uint64((1 << 24) - 1)


def _rolled(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words, by doubling: a run is made of two shorter ones."""
    done, out, length = None, words, 1
    covered = 0
    while width:
        if width & 1:
            part = out[covered:] if covered else out
            if done is None:
                done = part
            else:
                n = min(len(done), len(part))
                done = mix(done[:n] * _ODD + part[:n])
            covered += length
        width >>= 1
        if width:
            out = mix(out[:-length] * _ODD + out[length:]) if len(out) > length else out[:0]
            length *= 2
    return done


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` keys."""
    out, length = keys, 1
    while 2 * length <= width:
        out = np.minimum(out[:-length], out[length:])
        length *= 2
    rest = width - length
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def segments(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of a batch: document, anchor hash, segment hash, first word, number of windows, first and end byte."""
    words = hash_words(raw, starts, lengths)
    n = len(words)
    if n < WINDOW:
        return tuple(np.empty(0, np.int64) for _ in range(7))
    doc = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    grams = _rolled(words, GRAM)
    place = (np.arange(len(grams)) - first[doc[: len(grams)]]).astype(np.uint64) & _PLACE
    least = _least((grams & ~_PLACE) | place, _SPAN)[: n - WINDOW + 1]
    # the anchor's place in the window, from its low bits
    begins = np.arange(n - WINDOW + 1)
    inside = begins - first[doc[begins]]
    anchor = begins + (((least & _PLACE).astype(np.int64) - inside) & int(_PLACE))
    whole = doc[begins] == doc[begins + WINDOW - 1]
    begins, anchor = begins[whole], anchor[whole]
    if not len(begins):
        return tuple(np.empty(0, np.int64) for _ in range(7))
    new = np.ones(len(begins), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (begins[1:] != begins[:-1] + 1)
    at = np.flatnonzero(new)
    number = np.diff(np.append(at, len(begins)))
    s0 = begins[at]
    last = s0 + number + WINDOW - 2
    # a segment's hash: its windows' hashes summed with their order, and where the anchor stands
    order = np.arange(len(begins)) - np.repeat(at, number)
    windows = _rolled(words, WINDOW)[begins]
    total = np.add.reduceat(mix(windows + order.astype(np.uint64) * _ODD), at)
    body = mix(total ^ mix((number + ((anchor[at] - s0) << 8)).astype(np.uint64)))
    return doc[s0], grams[anchor[at]].view(np.int64), body.view(np.int64), s0 - first[doc[s0]], number, starts[s0], starts[last] + lengths[last]


def listed(docs: DataFrame) -> DataFrame:
    """Step 1: (doc_id, t, h, g, s0, number, b0, size): a row per segment; b0 counts bytes of the text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            with np.errstate(over="ignore"):
                raw, starts, lengths, counts = words_of(texts)
                doc, h, g, s0, number, b0, b1 = segments(raw, starts, lengths, counts)
            sizes = np.array([len((x or "").encode("utf-8", "surrogatepass")) + 1 for x in texts], np.int64)
            base = np.cumsum(sizes) - sizes
            take = pa.array(doc)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(h, pa.int64()), pa.array(g, pa.int64()), pa.array(s0, pa.int32()), pa.array(number, pa.int32()),
                                              pa.array(b0 - base[doc] if len(doc) else b0, pa.int32()), pa.array(b1 - b0, pa.int32())], names=["doc_id", "t", "h", "g", "s0", "number", "b0", "size"])

    small_batches(docs.sparkSession)
    return docs.select("doc_id", "t", "text").mapInArrow(work, "doc_id long, t int, h long, g long, s0 int, number int, b0 int, size int")


class Automaton:
    """Suffix automaton of several word sequences; states know how often their strings occur."""

    def __init__(self):
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def add(self, sequence: list[int], weight: int) -> None:
        step, link, length, count = self.step, self.link, self.length, self.count
        last = 0
        for c in sequence:
            if c in step[last]:  # the string is known: go there, splitting its state if it stands for longer ones too
                q = step[last][c]
                last = q if length[q] == length[last] + 1 else self._split(last, q, c)
            else:
                new = len(step)
                step.append({})
                link.append(0)
                length.append(length[last] + 1)
                count.append(0)
                p, last = last, new
                while p != -1 and c not in step[p]:
                    step[p][c] = new
                    p = link[p]
                if p != -1:
                    q = step[p][c]
                    link[new] = q if length[q] == length[p] + 1 else self._split(p, q, c)
            count[last] += weight

    def _split(self, p: int, q: int, c: int) -> int:
        step, link = self.step, self.link
        clone = len(step)
        step.append(dict(step[q]))
        link.append(link[q])
        self.length.append(self.length[p] + 1)
        self.count.append(0)
        link[q] = clone
        while p != -1 and step[p].get(c) == q:
            step[p][c] = clone
            p = link[p]
        return clone

    def finish(self) -> None:
        """Hand every state's occurrences on to its suffixes."""
        for s in sorted(range(1, len(self.step)), key=self.length.__getitem__, reverse=True):
            if self.link[s] > 0:
                self.count[self.link[s]] += self.count[s]

    def repeated(self, sequence: list[int], width: int) -> int:
        """Bits of the windows of ``width`` words (by their first word) that occur twice or more."""
        step, link, length, count = self.step, self.link, self.length, self.count
        state = matched = bits = 0
        for i, c in enumerate(sequence):
            while state and c not in step[state]:
                state = link[state]
                matched = length[state]
            if c in step[state]:
                state, matched = step[state][c], matched + 1
            while length[link[state]] >= width:
                state = link[state]
            matched = min(matched, length[state], width) if length[link[state]] < width else width
            if matched >= width and count[state] >= 2:
                bits |= 1 << (i - width + 1)
        return bits


def _shards(texts: DataFrame) -> DataFrame:
    """Step 3, anchors of a few segments: (h, g, bits)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, starts in whole_groups(batches, ["h"]):
            bodies, weights = group.column("body").to_pylist(), group.column("n").to_pylist()
            bits = []
            for first, last in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                ids: dict[bytes, int] = {}
                automaton = Automaton()
                sequences = [[ids.setdefault(w, len(ids)) for w in body.split()] for body in bodies[first:last]]
                for s, n in zip(sequences, weights[first:last], strict=True):
                    automaton.add(s, n)
                automaton.finish()
                bits += [automaton.repeated(s, WINDOW) for s in sequences]
            yield pa.RecordBatch.from_pydict({"h": group.column("h").combine_chunks(), "g": group.column("g").combine_chunks(), "bits": pa.array(bits, pa.int64())})

    sorted_rows = texts.select("h", "g", "n", "body").repartition(partitions(texts.sparkSession), "h").sortWithinPartitions("h", "g")
    return sorted_rows.mapInArrow(work, "h long, g long, bits long")


def _windows(texts: DataFrame) -> DataFrame:
    """Step 3, anchors of many segments: (h, g, bits) from counts of single windows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = [b.decode("utf-8", "surrogatepass") for b in batch.column(3).to_pylist()]
            with np.errstate(over="ignore"):
                raw, starts, lengths, counts = words_of(bodies)
                words = hash_words(raw, starts, lengths)
                one, two = _rolled(words, WINDOW), _rolled(mix(words + _ODD), WINDOW)
            number = counts - WINDOW + 1
            row = np.repeat(np.arange(len(bodies)), number)
            bit = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
            at = np.repeat(np.cumsum(counts) - counts, number) + bit
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), batch.column(2).take(take), pa.array(bit, pa.int32()), pa.array(one[at].view(np.int64)), pa.array(two[at].view(np.int64))], names=["h", "g", "n", "bit", "w1", "w2"])

    rows = cut(texts.select("h", "g", "n", "body").mapInArrow(work, "h long, g long, n long, bit int, w1 long, w2 long"), "substring-windows")
    twice = cut(rows.groupBy("w1", "w2").agg(F.sum("n").alias("total")).where("total > 1").select("w1", "w2"), "substring-twice")
    return rows.join(twice, ["w1", "w2"]).groupBy("h", "g").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(doc_id, t, s0, bits): per segment with repeated windows, its first word and its windows' bits. ``docs``: doc_id, t, text."""
    rows = cut(listed(docs), "substring-segments")
    anchors = cut(rows.groupBy("h").agg(F.count("*").alias("n"), (F.min("g") != F.max("g")).alias("mixed")).where("n > 1").select("h", "mixed"), "substring-anchors")
    met = cut(rows.join(anchors, "h"), "substring-met")
    plain = met.where("not mixed").select("doc_id", "t", "s0", F.expr("shiftleft(1L, number) - 1").alias("bits"))
    kinds = cut(met.where("mixed").groupBy("h", "g").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "t", "b0", "size")).alias("at")), "substring-kinds")
    many = cut(kinds.groupBy("h").agg(F.count("*").alias("kinds")).where(F.col("kinds") > HOT).select("h"), "substring-hot")
    # the texts of the kinds, each from one document: a row per document, then a row per segment
    fetched = kinds.select("h", "g", "n", "at.*").groupBy("doc_id", "t").agg(F.collect_list(F.struct("h", "g", "n", "b0", "size")).alias("kinds"))
    same = (F.col("doc_id").eqNullSafe(F.col("_id"))) & (F.col("t") == F.col("_t"))
    source = docs.select(F.col("doc_id").alias("_id"), F.col("t").alias("_t"), F.col("text").cast("binary").alias("raw"))
    body = fetched.join(source, same).select("raw", F.explode("kinds").alias("k")).select("k.h", "k.g", "k.n", F.expr("substring(raw, k.b0 + 1, k.size)").alias("body"))
    texts = cut(body.dropDuplicates(["h", "g"]), "substring-texts")
    few = texts.join(many, "h", "left_anti")
    found = cut(_shards(few).unionAll(_windows(texts.join(many, "h", "left_semi"))).where("bits <> 0"), "substring-bits")
    return plain.unionAll(met.where("mixed").join(found, ["h", "g"]).select("doc_id", "t", "s0", "bits"))


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words that stay, joined by one space) for every row."""
    docs = docs.select("doc_id", "text").withColumn("t", F.shiftright(F.xxhash64(F.coalesce("text", F.lit(""))), 32).cast("int"))
    marks = repeated_windows(docs).groupBy(F.col("doc_id").alias("_id"), F.col("t").alias("_t")).agg(F.collect_set(F.struct("s0", "bits")).alias("marks"))  # rows that repeat give their marks once
    same = (F.col("doc_id").eqNullSafe(F.col("_id"))) & (F.col("t") == F.col("_t"))
    joined = docs.join(marks, same, "left").select("doc_id", "text", F.col("marks.s0").alias("s0"), F.col("marks.bits").alias("bits"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, s0, bits in zip(*[batch.column(i).to_pylist() for i in (1, 2, 3)], strict=True):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                gone = np.zeros(len(words) + 1, np.int64)
                if s0:
                    bits = np.array(bits, np.int64)[:, None] >> np.arange(_SPAN) & 1
                    at = (np.array(s0)[:, None] + np.arange(_SPAN))[bits == 1]
                    np.add.at(gone, at, 1)
                    np.add.at(gone, at + WINDOW, -1)
                covered = np.cumsum(gone)[: len(words)] > 0
                n_words.append(len(words))
                n_removed.append(int(covered.sum()))
                kept.append(b" ".join([w for w, c in zip(words, covered.tolist(), strict=True) if not c] if s0 else words).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    small_batches(docs.sparkSession)
    return joined.mapInArrow(work, "doc_id long, n_words long, n_removed long, kept string")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
