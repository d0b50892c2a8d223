"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on every document. Expectation-maximisation
over the counts of vote patterns (all documents; at most 3**labellers patterns reach the driver)
estimates each labeller's accuracy and every pattern's posterior. The posteriors are the labels of a
linear scorer over hashed word-shape features, fitted on the ``FIT_ROWS`` documents with the smallest
hash of doc_id (a bounded sample; the bound is a parameter of ``fit``). The scorer then judges every document.

Texts are read whole. Features and votes are array work over Arrow batches; there is one pass for the
votes and one for the scores, and no shuffle but the pattern counts.

Defined results: null text counts as empty; a text without words gets the class prior and is kept
with it; repeated rows get equal scores; other columns pass through ``score``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lymphoframe.llm.common import cut, small_batches, smallest_hashes, table

FIT_ROWS = 8192
BUCKETS = 1 << 13
KEEP_FROM = 0.5
FEW = 3

#: Frequent function words of the corpus's four languages.
FUNCTION_WORDS = ("the of and to in is that for it was on with as be by at are this have from or an "
                  "der die das und von den mit für auf ist nicht ein eine zu im des dem sich als auch "
                  "le la les de des et un une est que dans pour qui sur pas au du "
                  "el los las y en por con para se del no una lo su al").split()

_SPACE, _LOWER, _UPPER, _DIGIT, _STOP, _SIGN, _OTHER = range(7)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[97:123] = _LOWER
_CLASS[65:91] = _UPPER
_CLASS[48:58] = _DIGIT
_CLASS[128:] = _LOWER
_CLASS[[ord(c) for c in ".,;:!?'\"()-"]] = _STOP
_CLASS[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = _SIGN
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _word_hashes(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of each word's bytes: position-weighted sums, so that no loop over words is needed."""
    offset = np.arange(len(raw), dtype=np.uint64) - np.repeat(starts.astype(np.uint64), lengths)
    return _mix(np.add.reduceat(_mix(raw.astype(np.uint64) + np.uint64(1) + (offset << np.uint64(9))), np.append(0, np.cumsum(lengths)[:-1])) * _BASE)


@dataclass
class Measured:
    """Per document: number of words and fractions; and hashed features in coordinate form."""

    words: np.ndarray
    numbers: dict[str, np.ndarray]
    doc: np.ndarray
    feature: np.ndarray
    value: np.ndarray


def measure(texts: list[str | None]) -> Measured:
    bodies = [(t or "").encode("utf-8", "replace") for t in texts]
    with np.errstate(over="ignore"):
        return _measure(np.frombuffer(b"\n".join([*bodies, b""]), np.uint8), np.array([len(b) + 1 for b in bodies], np.int64))


def _measure(raw: np.ndarray, sizes: np.ndarray) -> Measured:
    n_docs = len(sizes)
    kind = _CLASS[raw]
    inside = kind != _SPACE
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    lengths = ends - starts
    doc = np.searchsorted(np.cumsum(sizes), starts, side="right")
    n = np.bincount(doc, minlength=n_docs)
    if not len(starts):
        none = np.zeros(n_docs)
        return Measured(n, {k: none for k in _NUMBERS}, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
    body, kinds = raw[inside], kind[inside]
    first = np.append(0, np.cumsum(lengths)[:-1])
    hashes = _word_hashes(body, first, lengths)
    mask = np.bitwise_or.reduceat(np.left_shift(np.uint8(1), kinds), first)
    last = first + lengths - 1
    tail = kinds[last]
    tail2 = np.where(lengths > 1, kinds[np.maximum(last - 1, 0)], _SPACE)
    same = np.append(False, doc[1:] == doc[:-1])
    repeat = same & np.append(False, hashes[1:] == hashes[:-1])
    grams = hashes.copy()
    for k in (1, 2, 3):
        grams[k:] = grams[k:] * _BASE + hashes[:-k] * np.uint64(2 * k + 1)
    fourth = np.zeros(len(doc), bool)
    fourth[3:] = doc[3:] == doc[:-3]
    keyed = np.where(fourth, _mix(grams ^ (doc.astype(np.uint64) << np.uint64(40))), _mix(np.arange(len(doc), dtype=np.uint64) + np.uint64(1 << 62)))
    order = np.argsort(keyed, kind="stable")
    seen = np.zeros(len(doc), bool)
    seen[order[1:]] = keyed[order[1:]] == keyed[order[:-1]]
    has = lambda k: (mask >> k) & 1 == 1
    signs = has(_SIGN) | has(_OTHER)
    upper = has(_UPPER) & ~has(_LOWER) & (lengths > 1)
    shouted = (tail == _STOP) & (tail2 == _STOP)
    bare = (mask & ((1 << _LOWER) | (1 << _UPPER) | (1 << _DIGIT))) == 0
    share = lambda flag: np.bincount(doc, flag, n_docs) / np.maximum(n, 1)
    stops = np.isin(hashes, _function_hashes())
    numbers = {"signs": share(signs), "upper": share(upper), "shouted": share(shouted), "repeat": share(repeat), "seen": share(seen), "bare": share(bare),
               "ends": share((tail == _STOP) & (tail2 != _STOP)), "function": share(stops), "length": share(lengths.astype(float))}
    # word shapes: classes present, class of the first and last letters, whether it repeats what stood before
    shape = mask.astype(np.int64) * 512 + kinds[first].astype(np.int64) * 64 + tail * 8 + tail2 + (repeat * 2 + seen).astype(np.int64) * 131072
    pair = np.where(same, shape * 1_000_003 + np.append(0, shape[:-1]), shape + 7)
    made = np.concatenate([shape, pair + (1 << 50)])
    slot = (_mix(made.astype(np.uint64) * _BASE) % np.uint64(BUCKETS)).astype(np.int64)
    both = np.concatenate([doc, doc]).astype(np.int64) * BUCKETS + slot
    key, count = np.unique(both, return_counts=True)
    at = key // BUCKETS
    return Measured(n, numbers, at, key % BUCKETS, np.sqrt(count / np.maximum(n[at], 1)))


_NUMBERS = ("signs", "upper", "shouted", "repeat", "seen", "bare", "ends", "function", "length")
_known: list[np.ndarray] = []


def _function_hashes() -> np.ndarray:
    if not _known:
        bodies = [w.encode() for w in FUNCTION_WORDS]
        raw, sizes = np.frombuffer(b"".join(bodies), np.uint8), np.array([len(b) for b in bodies])
        _known.append(np.unique(_word_hashes(raw, np.append(0, np.cumsum(sizes)[:-1]), sizes)))
    return _known[0]


#: Labellers: measure, least words for a vote, good below, bad above (or good above, bad below where the first is the larger).
LABELLERS = (
    ("signs", 3, 0.08, 0.25),
    ("upper", 8, 0.10, 0.40),
    ("shouted", 3, 0.05, 0.20),
    ("repeat", 6, 0.04, 0.15),
    ("seen", 24, 0.10, 0.30),
    ("bare", 3, 0.05, 0.20),
    ("ends", 40, 0.04, 0.01),
    ("function", 40, 0.08, 0.01),
)


def votes(m: Measured) -> np.ndarray:
    """Documents x labellers: 1 good, 0 bad, 2 no vote."""
    out = np.full((len(m.words), len(LABELLERS)), 2, np.int64)
    for k, (name, least, good, bad) in enumerate(LABELLERS):
        x = m.numbers[name]
        ups, downs = (x <= good, x >= bad) if good < bad else (x >= good, x <= bad)
        out[ups, k], out[downs, k] = 1, 0
        out[m.words < least, k] = 2
    return out


def _pattern(v: np.ndarray) -> np.ndarray:
    return v @ (3 ** np.arange(v.shape[1]))


@dataclass
class WeakLabels:
    """Class prior and, per labeller, P(vote | class, it votes); posteriors by pattern."""

    prior: float
    table: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        v = patterns[:, None] // 3 ** np.arange(len(self.table)) % 3
        known = np.concatenate([np.log(self.table), np.zeros((len(self.table), 2, 1))], axis=2)  # no vote says nothing
        logs = np.log(np.array([1 - self.prior, self.prior])) + sum(known[k][:, v[:, k]].T for k in range(len(self.table)))
        top = logs.max(1, keepdims=True)
        odds = np.exp(logs - top)
        return odds[:, 1] / odds.sum(1)

    def accuracies(self) -> np.ndarray:
        """P(right) of each labeller where it votes."""
        return (1 - self.prior) * self.table[:, 0, 0] + self.prior * self.table[:, 1, 1]


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = 50) -> WeakLabels:
    """From the majority vote on: a single bad vote is taken as bad at first (heuristics rarely fire on clean text)."""
    k = len(LABELLERS)
    v = patterns[:, None] // 3 ** np.arange(k) % 3
    good = np.where((v == 0).any(1), 0.1, 0.9)
    model = WeakLabels(0.5, np.full((k, 2, 2), 1 / 2))
    total = max(counts.sum(), 1)
    for _ in range(rounds):
        weight = np.stack([counts * (1 - good), counts * good])
        table = np.stack([[[weight[c][v[:, j] == x].sum() for x in range(2)] for c in range(2)] for j in range(k)]) + 1e-3 * total / 2 + 1e-9
        model = WeakLabels(float(np.clip(weight[1].sum() / total, 0.01, 0.99)), table / table.sum(2, keepdims=True))
        good = model.posterior(patterns)
    return model


@dataclass
class Scorer:
    """A few words say little: the score leans on the class prior by ``FEW / (words + FEW)``."""

    weights: np.ndarray
    bias: float
    prior: float

    def __call__(self, m: Measured) -> np.ndarray:
        z = self.bias + np.bincount(m.doc, m.value * self.weights[m.feature], len(m.words))
        lean = FEW / (m.words + FEW)
        z = z * (1 - lean) + np.log(self.prior / (1 - self.prior)) * lean
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, prior: float, steps: int = 300, l2: float = 1e-4) -> Scorer:
    """Logistic regression on soft labels, classes weighted alike, by full-batch steps with momentum."""
    n = len(rows)
    doc = np.repeat(np.arange(n), [len(f) for f, _ in rows])
    feature = np.concatenate([f for f, _ in rows]) if n else np.empty(0, np.int64)
    value = np.concatenate([x for _, x in rows]) if n else np.empty(0)
    share = float(np.clip(labels.mean(), 0.02, 0.98)) if n else 0.5
    pull = labels * 0.5 / share + (1 - labels) * 0.5 / (1 - share)
    w, b = np.zeros(BUCKETS), 0.0
    mw, mb = np.zeros(BUCKETS), 0.0
    for _ in range(steps):
        z = b + np.bincount(doc, value * w[feature], n)
        g = pull * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - labels) / max(n, 1)
        mw = 0.9 * mw + np.bincount(feature, g[doc] * value, BUCKETS) + l2 * w
        mb = 0.9 * mb + g.sum()
        w, b = w - 2.0 * mw, b - 2.0 * mb
    return Scorer(w, float(b), prior)


def fit(docs: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[WeakLabels, Scorer]:
    schema = "doc_id long, words long, pattern long, features binary, numbers binary"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = measure(batch.column(1).to_pylist())
            cuts = np.searchsorted(m.doc, np.arange(len(m.words) + 1))
            feature, value = m.feature.astype("<u2"), m.value.astype("<f4")
            split = lambda x: [x[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]  # noqa: E731,B023
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(m.words), pa.array(_pattern(votes(m))), pa.array(split(feature)), pa.array(split(value))],
                                             names=["doc_id", "words", "pattern", "features", "numbers"])

    small_batches(docs.sparkSession)
    measured = cut(docs.select("doc_id", "text").mapInArrow(work, schema), "quality-votes")
    counted = measured.groupBy("pattern").count().collect()
    patterns, counts = np.array([r[0] for r in counted], np.int64), np.array([r[1] for r in counted], np.float64)
    model = expectation_maximisation(patterns, counts)
    sample = smallest_hashes(measured.where("words > 0"), "doc_id", fit_rows, int(counts.sum()), "pattern", "features").collect()
    rows = [(np.frombuffer(r["features"], "<u2").astype(np.int64), np.frombuffer(r["numbers"], "<f4").astype(np.float64)) for r in sample]
    labels = model.posterior(np.array([r["pattern"] for r in sample], np.int64)) if sample else np.empty(0)
    return model, train(rows, labels, model.prior)


def score(df: DataFrame, fitted: tuple[WeakLabels, Scorer]) -> DataFrame:
    """Adds ``weak_label`` (posterior of the votes), ``quality`` (the scorer's) and ``kept``."""
    added = [T.StructField("weak_label", T.DoubleType()), T.StructField("quality", T.DoubleType()), T.StructField("kept", T.BooleanType())]
    names = {f.name for f in added}
    keep = [f for f in df.schema.fields if f.name not in names]
    schema = T.StructType([*keep, *added])
    model, scorer = fitted

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index
            m = measure(batch.column(at("text")).to_pylist())
            quality = scorer(m)
            yield pa.RecordBatch.from_arrays([*[batch.column(at(f.name)) for f in keep], pa.array(model.posterior(_pattern(votes(m)))), pa.array(quality), pa.array(quality >= KEEP_FROM)], names=schema.fieldNames())

    small_batches(df.sparkSession)
    return df.mapInArrow(work, schema)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, fit(docs)).select("doc_id", "weak_label", "quality", "kept")
