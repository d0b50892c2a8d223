"""Operators over documents: brute-force versions on the smallest table and on rows with every oddity."""

import collections
import hashlib
import re
import zlib

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lymphoframe.llm import bpe, fingerprints, lines, minhash, packing, quality, secrets, substrings
from lymphoframe.llm.registry import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "lorem ipsum dolor " * 6000 + "x" * 50_000
PASSAGE = " ".join(f"w{k}" for k in range(60))
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, PASSAGE), (6, "intro " + PASSAGE + " outro"), (7, LONG), (7, LONG), (8, "é𝄞 " * 40), (9, PASSAGE), (None, "no id at all"), (10, "A\nB\nC\nD\n" * 9), (11, "x\nA\nB\nC\nD\n" * 9)]


@pytest.fixture(scope="module")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text or "" for r in documents.select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, and columns named like the operators' own."""
    return spark.createDataFrame([(i, t, "k", 1, None) for i, t in ODD], "doc_id long, text string, kept string, n_removed int, fingerprint string")


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# 1 ----------------------------------------------------------------------------------------------


def removed(rows, width=35):
    words = [WORD.findall(t or "") for _, t in rows]
    seen = collections.Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize("hot", [512, 1])
def test_substring_dedup(spark, sf, texts, monkeypatch, hot):
    monkeypatch.setattr(substrings, "HOT", hot)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op1_substring_dedup"](spark, sf).collect()}
    want = {i: (n, k, sha(t)) for (i, _), (n, k, t) in zip(texts.items(), removed(texts.items()), strict=True)}
    assert got == want and sum(v[1] for v in want.values()) > 0


def test_substring_dedup_odd_rows(odd, none):
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed, r.kept) for r in substrings.dedup(odd).collect())
    assert got == sorted((i or 0, *x) for (i, _), x in zip(ODD, removed(ODD), strict=True))
    assert substrings.dedup(none).count() == 0


def test_suffix_automaton_counts_overlaps():
    a = substrings.Automaton()
    sequences = [[1, 2, 1, 2, 1], [3, 1, 2, 1]]
    for s in sequences:
        a.add(s, 1)
    a.finish()
    assert [a.repeated(s, 3) for s in sequences] == [0b101, 0b010] and [a.repeated(s, 4) for s in sequences] == [0, 0]


# 2 ----------------------------------------------------------------------------------------------


def test_byte_bpe_equals_the_library(spark, sf, texts, odd, none):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    for r in QUERIES["op2_byte_bpe"](spark, sf).collect():
        ids = library.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(texts[r.doc_id]))
    for r in bpe.decode(bpe.encode(odd, path, public_tokenizers.PATTERN), path).collect():
        assert r.ids == library.encode_ordinary(r.text or "") and r.decoded == (r.text or "").encode() and r.kept == "k"
    assert bpe.decode(bpe.encode(none, path, public_tokenizers.PATTERN), path).count() == 0
    with pytest.raises(Exception, match="outside the vocabulary"):
        bpe.decode(odd.sparkSession.createDataFrame([([999_999],)], "ids array<int>"), path).collect()


def test_rank_queue_takes_the_leftmost_of_the_lowest_rank():
    ranks = {bytes([b]): b for b in range(256)} | {b"aa": 300, b"aaa": 301, b"ab": 299, b"aab": 900}
    encoder, library = bpe.Encoder(ranks), tiktoken.Encoding("t", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    for text in ("aaaaa", "aabaab", "abaaab", "b" * 9, "a" * 5000 + "b"):
        assert encoder.merge(text.encode()) == library.encode_ordinary(text)
    assert not encoder.buckets and not any(encoder.words)


# 3 ----------------------------------------------------------------------------------------------


def components(rows, percent):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(fold))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


def test_minhash(spark, sf, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in QUERIES["op3_minhash"](spark, sf).collect()}
    assert got == components(texts.items(), 85) and any(not v[2] for v in got.values())


def test_minhash_odd_rows_and_blocks(spark, odd, none, monkeypatch):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(odd, 80).collect() if r.doc_id}
    assert got == components([x for x in ODD if x[0]], 80)
    assert minhash.near_duplicates(none).count() == 0
    twins = spark.createDataFrame([(1, PASSAGE), (None, PASSAGE + " more"), (None, "another text of its own, with words enough")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in minhash.near_duplicates(twins, 85).collect()) == [(0, 0), (0, 1), (1, 1)]
    # every split: keys, rough groups, block pairs
    for name, value in (("HOT", 2), ("BLOCK", 2), ("SET_BLOCK", 2), ("MOST_BLOCKS", 4)):
        monkeypatch.setattr(minhash, name, value)
    base = [f"t{k}" for k in range(120)]
    rows = [(k, " ".join(base[:40 + k] + [f"e{k}"] + base[41 + k :])) for k in range(24)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(frame, 85).collect()} == components(rows, 85)


def test_minhash_keeps_one_row_of_each_component(spark, odd, none):
    v, w = PASSAGE, PASSAGE.upper().replace("W", "v")
    rows = [(1, w), (5, w), (5, v), (7, v + " q"), (9, w), (3, "r s t u v x y z"), (3, "r s t u v x y z"), (None, w), (4, ""), (4, ""), (8, None), (None, "alone without an id"), (None, "alone without an id")]
    frame = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, copy string")
    got = sorted(((r.doc_id or 0, r.text or "", r.copy) for r in minhash.keep_one(frame).collect()))
    assert got == sorted([(1, w, "c"), (5, v, "c"), (3, "r s t u v x y z", "c"), (4, "", "c"), (4, "", "c"), (8, "", "c"), (0, "alone without an id", "c")])
    assert minhash.keep_one(none).count() == 0 and minhash.keep_one(odd).columns == odd.columns


# 4 ----------------------------------------------------------------------------------------------


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scored = QUERIES["op4_quality"](spark, sf).select("doc_id", "kept").join(labels.select("doc_id", F.col("quality").alias("label")), "doc_id").collect()
    assert sum(r.kept == bool(r.label) for r in scored) >= 0.97 * len(scored)


def test_quality_odd_rows(odd, none):
    fitted = quality.fit(odd)
    out = quality.score(odd, fitted).collect()
    assert len(out) == len(ODD) and all(0 <= r.quality <= 1 and r.kept is not None for r in out) and set(out[0].asDict()) >= {"n_removed", "kept", "text"}
    assert quality.score(none, quality.fit(none)).count() == 0


def plain_numbers(text):
    """Shares of words by the definitions of six measures, word by word."""
    stops, signs = set(b".,;:!?'\"()-"), set(b"#$%&*+/<=>@[\\]^_`{|}~")
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode())
    upper = lambda w: any(65 <= c <= 90 for c in w)
    lower = lambda w: any(97 <= c <= 122 or c >= 128 for c in w)
    digit = lambda w: any(48 <= c <= 57 for c in w)
    strange = lambda c: c in signs or c < 128 and c not in stops and not bytes([c]).isalnum()
    tests = {
        "signs": lambda k, w: any(strange(c) for c in w),
        "upper": lambda k, w: len(w) > 1 and upper(w) and not lower(w),
        "shouted": lambda k, w: len(w) > 1 and w[-1] in stops and w[-2] in stops,
        "repeat": lambda k, w: k > 0 and words[k - 1] == w,
        "bare": lambda k, w: not (upper(w) or lower(w) or digit(w)),
        "ends": lambda k, w: w[-1] in stops and not (len(w) > 1 and w[-2] in stops),
        "function": lambda k, w: w.decode() in quality.FUNCTION_WORDS,
    }
    return len(words), {name: sum(map(bool, (f(k, w) for k, w in enumerate(words)))) / max(len(words), 1) for name, f in tests.items()}


def plain_posteriors(rows, rounds=50):
    """Expectation-maximisation document by document, without patterns."""
    n = len(rows)
    good = [0.1 if 0 in v else 0.9 for v in rows]
    for _ in range(rounds):
        prior = min(max(sum(good) / n, 0.01), 0.99)
        table = {}
        for k in range(len(rows[0])):
            for c in (0, 1):
                sums = [sum(g if c else 1 - g for g, v in zip(good, rows, strict=True) if v[k] == x) + 1e-3 * n / 2 + 1e-9 for x in (0, 1)]
                table[k, c] = [x / sum(sums) for x in sums]
        for i, v in enumerate(rows):
            bad_odds, good_odds = 1 - prior, prior
            for k, x in enumerate(v):
                if x < 2:
                    bad_odds, good_odds = bad_odds * table[k, 0][x], good_odds * table[k, 1][x]
            good[i] = good_odds / (bad_odds + good_odds)
    return good, prior, table


def test_quality_equals_a_plain_version(spark, sf, texts):
    """Votes by definition, expectation-maximisation by documents, and a dense scorer on its posteriors."""
    import numpy as np

    ids = sorted(texts)
    m = quality.measure([texts[i] for i in ids])
    for k, i in enumerate(ids):
        n, numbers = plain_numbers(texts[i])
        assert n == m.words[k] and all(abs(m.numbers[name][k] - x) < 1e-12 for name, x in numbers.items()), i
    rows = []
    for k in range(len(ids)):
        mine = []
        for name, least, good, bad in quality.LABELLERS:
            x, sign = m.numbers[name][k], 1 if good < bad else -1
            mine.append(2 if m.words[k] < least else 0 if sign * x >= sign * bad else 1 if sign * x <= sign * good else 2)
        rows.append(mine)
    weak, prior, table = plain_posteriors(rows)
    got = {r.doc_id: r for r in QUERIES["op4_quality"](spark, sf).collect()}
    assert got.keys() == set(ids) and all(abs(got[i].weak_label - w) < 1e-9 for i, w in zip(ids, weak, strict=True))
    used = [k for k in range(len(ids)) if m.words[k] > 0]
    dense = np.zeros((len(ids), quality.BUCKETS))
    np.add.at(dense, (m.doc, m.feature), m.value)
    x, y = dense[used], np.array(weak)[used]
    share = min(max(y.mean(), 0.02), 0.98)
    pull = y * 0.5 / share + (1 - y) * 0.5 / (1 - share)
    w, b, mw, mb = np.zeros(quality.BUCKETS), 0.0, 0.0, 0.0
    for _ in range(300):
        g = pull * (1 / (1 + np.exp(-(x @ w + b))) - y) / len(used)
        mw, mb = 0.9 * mw + x.T @ g + 1e-4 * w, 0.9 * mb + g.sum()
        w, b = w - 2.0 * mw, b - 2.0 * mb
    for k, i in enumerate(ids):
        lean = quality.FEW / (m.words[k] + quality.FEW)
        z = (dense[k] @ w + b) * (1 - lean) + np.log(prior / (1 - prior)) * lean
        assert abs(got[i].quality - 1 / (1 + np.exp(-z))) < 1e-4
    model, _ = quality.fit(spark.read.parquet(f"{sf}/documents.parquet"))
    want = [(1 - prior) * table[k, 0][0] + prior * table[k, 1][1] for k in range(len(quality.LABELLERS))]
    assert np.allclose(model.accuracies(), want, atol=1e-9)


def test_quality_sample_with_ties_and_clashing_columns(spark, texts):
    """Rows of one doc_id tie in the sample: which of them are taken doesn't depend on the layout."""
    rows = [(k % 30, t) for k, t in enumerate(texts[i] for i in sorted(texts)[:300])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    (_, one), (_, two) = (quality.fit(f, 60) for f in (frame.repartition(5), frame.orderBy(F.desc("text")).coalesce(2)))
    assert abs(one.weights - two.weights).max() < 1e-6 and abs(one.bias - two.bias) < 1e-6
    clash = frame.selectExpr("*", "'mine' AS weak_label", "'mine' AS quality", "'mine' AS kept", "1 AS other")
    out = quality.score(clash, quality.fit(clash))
    assert out.columns == ["doc_id", "text", "other", "weak_label", "quality", "kept"] and dict(out.dtypes)["weak_label"] == "double"
    assert out.count() == len(rows)


# 5 ----------------------------------------------------------------------------------------------


def test_line_dedup_takes_repeated_chunks(spark, sf, documents, texts):
    """Later copies of chunks cut by the rolling hash alone are among what goes."""
    cut = {r.doc_id: [(c.n, c.body) for c in r.c] for r in documents.select("doc_id", lines.chunks(F.col("text")).alias("c")).collect()}
    assert all("\n".join(b for _, b in c) == texts[i] for i, c in cut.items())
    count, seen, least = collections.Counter(b for c in cut.values() for n, b in c if n >= 2), set(), {}
    for i in sorted(cut):
        least[i] = 0
        for n, b in cut[i]:
            if n >= 2 and count[b] > 1 and b in seen:
                least[i] += n
            seen |= {b} if n >= 2 else set()
    got = {r.doc_id: r.n_removed for r in QUERIES["op5_line_dedup"](spark, sf).collect()}
    assert all(got[i] >= n for i, n in least.items()) and sum(least.values()) > 0


def test_line_dedup_resynchronises_and_odd_rows(spark, odd, none):
    body = "\n".join(f"line number {k} of the text" for k in range(60))
    pair = spark.createDataFrame([(1, body), (2, "a new first line\nand a second\n" + body)], "doc_id long, text string")
    first, second = (r for r in lines.dedup(pair).orderBy("doc_id").collect())
    assert first.text == body and first.n_removed == 0 and second.n_removed > 40 and second.text.startswith("a new first line")
    out = lines.dedup(odd).collect()
    assert len(out) == len(ODD) and {r.doc_id: r.text for r in out}[1] is None and {r.doc_id: r.text for r in out}[2] == ""
    assert lines.dedup(none).count() == 0


def without_repeated_runs(texts):
    """Brute force: for each pair of places, the longest common run from there; later copies of two lines or more go."""
    cut = {i: t.split("\n") for i, t in texts.items()}
    places = [(i, k) for i in sorted(cut) for k in range(len(cut[i]))]
    at, gone = collections.defaultdict(list), collections.defaultdict(set)
    for i, k in places:
        for j, m in at[cut[i][k]]:
            n = 0
            while k + n < len(cut[i]) and m + n < len(cut[j]) and (j != i or m + n < k) and cut[i][k + n] == cut[j][m + n]:
                n += 1
            if n >= 2:
                gone[i] |= set(range(k, k + n))
        at[cut[i][k]].append((i, k))
    return {i: (len(gone[i]), "\n".join(x for k, x in enumerate(cut[i]) if k not in gone[i])) for i in cut}


def test_line_dedup_takes_every_repeated_run(spark, sf, texts):
    want = without_repeated_runs(texts)
    assert {r.doc_id: (r.n_removed, r.kept_sha256) for r in QUERIES["op5_line_dedup"](spark, sf).collect()} == {i: (n, sha(t)) for i, (n, t) in want.items()}
    alone = {k: f"own {k}\nP{k}\nQ{k}\nnext {k}" for k in range(40)} | {100 + k: f"P{k}\nQ{k}" for k in range(40)} | {200: "A\nA\nA\nA\nB\nA\nB\nA", 201: "only\nP1", 202: "\n\n\n", 203: "x\n\n\ny"}
    want = without_repeated_runs(alone)
    assert all(want[100 + k] == (2, "") for k in range(40)) and want[201] == (0, "only\nP1")
    frame = spark.createDataFrame(list(alone.items()), "doc_id long, text string").repartition(3)
    assert {r.doc_id: (r.n_removed, r.text) for r in lines.dedup(frame).collect()} == want
    shared = spark.createDataFrame([(1, "a\nb\nc\nd"), (2, "p\nq\nr\ns"), (2, "c\nd\nx\ny"), (2, "c\nd\nx\ny")], "doc_id long, text string")
    assert sorted(r.text for r in lines.dedup(shared).collect()) == ["a\nb\nc\nd", "p\nq\nr\ns", "x\ny", "x\ny"]


# 7 ----------------------------------------------------------------------------------------------


def test_fingerprints(spark, sf, texts):
    ids, got = sorted(texts, reverse=True), {r.doc_id: r for r in QUERIES["op7_fingerprints"](spark, sf).collect()}
    for k, i in enumerate(ids):
        a, b = texts[i], texts[ids[(k + 1) % len(ids)]]
        h = len(a) // 2
        assert (got[i].n_chars, got[i].edited_sha256) == (len(a), sha(a[: len(a) - h] + b[:h]))
    assert len({r.fingerprint for r in got.values()}) == len(set(texts.values()))
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got.values())
    assert sum(r.near_edited > r.near_next for r in got.values()) > 0.9 * len(got)


def test_sketches_recover_differences(spark):
    a, b = list(range(1000, 1090)), list(range(1010, 1100))
    frame = spark.createDataFrame([(a, b), (a, a), ([], b), ([], [])], "a array<bigint>, b array<bigint>")
    want = [({(k, 1) for k in a if k not in b} | {(k, -1) for k in b if k not in a}) for a, b in ((a, b), (a, a), ([], b), ([], []))]
    for sizes in ((192,), (12, 192), (12,)):  # enough, a retry, beyond the last size
        got = frame.select(fingerprints.differing(F.col("a"), F.col("b"), sizes).alias("d"))
        assert [{(x.key, x.n) for x in r.d} for r in got.collect()] == want
    assert frame.select(fingerprints.peel(fingerprints.sketch(F.col("b"), 12), 12).alias("p")).first().p is None


def test_likeness_counts_every_digest(spark, sf, texts, monkeypatch):
    def pieces(t):
        return {p for p in re.split(fingerprints.CUT, t) if p}

    def like(a, b):
        return 2 * len(a & b) / (len(a) + len(b)) if a or b else 1.0

    ids, got = sorted(texts, reverse=True), {r.doc_id: r for r in QUERIES["op7_fingerprints"](spark, sf).collect()}
    for k, i in enumerate(ids):
        a, b = texts[i], texts[ids[(k + 1) % len(ids)]]
        h = len(a) // 2
        near = [like(pieces(a), pieces(a[: len(a) - h] + b[:h])), like(pieces(a), pieces(b))]
        assert [got[i].near_edited, got[i].near_next] == pytest.approx(near)
    keys = [list(range(1, 4001)), list(range(2, 4002)), [*range(1, 4000), 9999], list(range(400, 4400)), [*range(1, 100)], []]
    frame = spark.createDataFrame([(n, a, b) for n, (a, b) in enumerate((a, b) for a in keys for b in keys)], "_row int, a array<bigint>, b array<bigint>").repartition("_row")
    wide = fingerprints.compared(frame, ["_row"], ["a"], [("a", "b")], []).join(frame, "_row").collect()
    assert len(wide) == 36 and all(r.near_0 == pytest.approx(like(set(r.a), set(r.b))) and r.left_0 == 0 for r in wide)
    assert {r.near_0 for r in wide if set(r.a) ^ set(r.b) == {4000, 9999}} == {1 - 1 / 4000}
    assert all(r.print_0.split(":")[2] == ("1536" if len(r.a) == 4000 else "48") for r in wide)
    for retries in (4, 0):  # larger sketches on arrays; the sets past the last
        monkeypatch.setattr(fingerprints, "RETRIES", retries)
        assert all(r.x == pytest.approx(like(set(r.a), set(r.b))) for r in frame.where("size(a) < 100 or size(b) < 100 or _row % 7 = 1").select("a", "b", fingerprints.likeness(F.col("a"), F.col("b")).alias("x")).collect())
    # every pair that has something to peel stalls: the second way gives the same table
    monkeypatch.setattr(fingerprints, "RETRIES", 4)
    monkeypatch.setattr(fingerprints, "ROUNDS_OF_ROWS", 0)
    again = {r.doc_id: r for r in QUERIES["op7_fingerprints"](spark, sf).collect()}
    assert again == got


def test_fingerprints_odd_rows(odd, none):
    out = fingerprints.fingerprint(odd).collect()
    by = collections.defaultdict(set)
    for r in out:
        by[r.text or ""].add(r.fingerprint)
    assert all(len(v) == 1 for v in by.values())
    chained = fingerprints.with_next(odd.select("doc_id", "text"), ["text"], "text").collect()
    assert len(chained) == len(ODD) and fingerprints.with_next(none.select("doc_id", "text"), ["text"], "text").count() == 0
    assert {r.doc_id: r.next_text for r in chained}[11] == ODD[11][1]


# 8 ----------------------------------------------------------------------------------------------


def check_pieces(pieces, ids):
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in pieces:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own) and r.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in own[r.start : r.start + r.length]))
    for i, own in ids.items():
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at
            at += r.length
        assert at == len(own)
    padding = 0
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    return padding


def test_packing(spark, sf, texts):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: [*library.encode(t, add_special_tokens=False).ids, 0] for i, t in texts.items()}
    assert check_pieces(QUERIES["op8_packing"](spark, sf).collect(), ids) == 0


def test_packing_odd_rows_and_special_text(spark, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = {1: None, 2: "", 3: "a<|endoftext|>b", 4: "word " * 3000}
    frame = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 0] for i, t in rows.items()}
    assert check_pieces(packing.pack(frame, path).collect(), ids) == 0
    assert packing.pack(none, path).count() == 0


def test_packing_repeated_rows_and_null_ids(spark):
    """Each row is packed for itself: every piece's bytes are there as often as rows have them."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = [(5, "the same text twice"), (5, "the same text twice"), (None, "no id"), (None, "another one"), (6, "word " * 1500), (6, "other " * 40)]
    pieces = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), path).collect()
    own = [[*library.encode(t, add_special_tokens=False).ids, 0] for _, t in rows]
    assert sum(r.length for r in pieces) == sum(map(len, own))
    found = collections.Counter((r.doc_id, r.doc_tokens) for r in pieces if r.start == 0)
    assert found == collections.Counter((i, len(x)) for (i, _), x in zip(rows, own, strict=True))
    by_sequence = collections.defaultdict(list)
    for r in pieces:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for placed in by_sequence.values():
        ends = 0
        for offset, length in sorted(placed):
            assert offset == ends
            ends += length
        assert ends <= 1024


def test_packing_puts_like_with_like(spark):
    topics = [" ".join(f"topic{k}word{j}" for j in range(60)) for k in range(3)]
    frame = spark.createDataFrame([(k * 10 + j, topics[k] + f" {j}") for j in range(3) for k in range(3)], "doc_id long, text string").coalesce(1)
    pieces = packing.pack(frame, public_tokenizers.path("byte_bpe_50k.json")).collect()
    order = [r.doc_id // 10 for r in sorted(pieces, key=lambda r: (r.sequence_id, r.offset)) if r.start == 0]
    assert sum(a == b for a, b in zip(order, order[1:], strict=False)) >= 4


def test_packing_retrieves_by_bm25(spark, texts):
    """An index of real documents ranks as brute-force BM25 over the same ids does."""
    import numpy as np

    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    docs = [(i, 0, 0, np.array([*library.encode_ordinary(t)[:1000], 0], np.uint32)) for i, t in sorted(texts.items())]
    seen = collections.Counter(x for d in docs for x in set(d[3].tolist()))
    mean = sum(len(d[3]) for d in docs) / len(docs)
    idf = np.zeros(60_000)
    for x, n in seen.items():
        idf[x] = np.log1p((len(docs) - n + 0.5) / (n + 0.5))
    shard = packing._Shard(docs, idf, mean)
    found = 0
    for q in range(0, len(docs), 7):
        query, scores = set(docs[q][3].tolist()), []
        for d in docs:
            tf = collections.Counter(d[3].tolist())
            scores.append(sum(idf[x] * tf[x] * 2.2 / (tf[x] + 1.2 * (0.25 + 0.75 * len(d[3]) / mean)) for x in query if x in tf))
        best = sorted((k for k in range(len(docs)) if k != q), key=lambda k: (-scores[k], k))
        found += best[0] in [k for k in shard.ranked(shard.own(q))[:5].tolist() if k != q]
        packing.POSTINGS, before = 10**9, packing.POSTINGS
        whole = [k for k in shard.ranked(shard.own(q)).tolist() if k != q]
        packing.POSTINGS = before
        assert [round(scores[k], 6) for k in whole[:10]] == [round(scores[k], 6) for k in best[:10]]
    assert found >= 0.9 * len(range(0, len(docs), 7))


def test_packing_ranks_every_candidate_of_a_shard():
    """Frequent ids count too: the order over all unused documents is that of BM25 over all ids of the seed."""
    import numpy as np

    rng = np.random.default_rng(8)
    docs = [(i, 0, 0, np.append(rng.integers(1, 400, rng.integers(1, 160)), 0).astype(np.uint32)) for i in range(1500)]
    docs += [(1500 + i, 0, 0, np.array([1000 + i, 0], np.uint32)) for i in range(30)]
    tf = np.zeros((len(docs), 1100))
    for i, d in enumerate(docs):
        np.add.at(tf[i], d[3], 1)
    size, n = tf.sum(axis=1, keepdims=True), (tf > 0).sum(axis=0)
    idf = np.log1p((len(docs) - n + 0.5) / (n + 0.5))
    weight = idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * size / size.mean()))
    shard = packing._Shard(docs, idf, size.mean())
    for used in (0, 1400):
        shard.unused[:used] = False
        for q in (0, 700, 1499, 1510):
            scores = weight[:, tf[q] > 0].sum(axis=1)
            order = list(shard.in_turn(shard.own(q)))
            assert sorted(order) == list(range(used, len(docs))) and order == shard.ranked(shard.own(q)).tolist()
            assert np.allclose(scores[order], np.sort(scores[used:])[::-1], rtol=1e-9)


# 9 ----------------------------------------------------------------------------------------------

PATTERNS = [("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 8), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 16), ("hex", re.compile("[0-9a-f]+"), 0, 32)]


def base(text):
    found = sorted((m.start(), n, kind, m.end()) for n, (kind, p, g, least) in enumerate(PATTERNS) for m in p.finditer(text or "") if len(m[g]) >= least)
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in found)


def test_secret_scan(spark, texts):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op9_secret_scan"](spark, sf).collect()
    assert all(r.base_sha256 == sha(base(rows[r.doc_id])) for r in got) and sum(r.n_assign for r in got) > 0


def test_entropy_spans_and_redaction(spark, odd, none):
    key, words = "Zx9Qp+2LmN4vB7kR1tYw8sD", "internationalisation-and-localisation"
    rows = [(1, f"é𝄞 {key} {words} 12345678901234567890123456"), (2, "token = secret = abcdefghijk"), (3, f"password={key}"), (4, "x" * 40), (5, "1beb58b8af68854f0e01b4ad40cdb")]
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.all_spans] for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: [("entropy_base64", 3, 3 + len(key))], 2: [], 3: [("assign", 0, 9 + len(key))], 4: [], 5: [("entropy_hex", 0, 29)]}
    clean = {r.doc_id: r.text for r in secrets.redact(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert clean[1] == f"é𝄞 [SECRET:entropy_base64] {words} 12345678901234567890123456" and clean[2] == rows[1][1] and clean[3] == "[SECRET:assign]"
    assert secrets.redact(odd).count() == len(ODD) and secrets.redact(none).count() == 0
    clean = ["/articles/2024/page-title-of-something", "some-long-article-slug-2024-edition", "ThisIs/A/PathWith/Words-and-123"[:22]]
    random = ["qJtWvZkXbNpLrHsDfGcM", "aB3dE5gH7jK9mN1pQ3sT5v"]
    found = secrets.scan(spark.createDataFrame([(t,) for t in clean[:2] + random], "text string")).collect()
    assert [len(r.all_spans) for r in found] == [0, 0, 1, 1]


def test_very_long_candidates(spark, tmp_path):
    """A megabyte of joined words, allowed or not, goes through the scan, and through the pipeline's stage."""
    import corpus_pipeline

    words, mixed, same = "abcd-" * 200_000, "abcd-" * 200_000 + "x1y2z3", "z" * 1_000_000
    docs = spark.createDataFrame([(1, words), (2, mixed), (3, same), (4, "k " + "/usr/local/share" * 30_000), (5, "-" * 500_000)], "doc_id long, text string")
    got = {r.doc_id: (len(r.base_spans), len(r.all_spans)) for r in secrets.scan(docs).collect()}
    assert got == {1: (0, 0), 2: (0, 0), 3: (0, 0), 4: (0, 0), 5: (0, 0)}
    kept = corpus_pipeline.secret_stage(spark, docs.selectExpr("doc_id", "text", "'en' lang", "'s' source", "0L n_chars"), "")
    assert {r.doc_id: r.text for r in kept.collect()}[2] == mixed
    slug = "read-More-about-2024-THE-news"
    cases = {slug: True, "": False, "---": True, "a" * 40: True, "Ab1-cd": False, "aB": False, "123456789": True, "abc-123456789": False, "4f9c-": False, "123e4567-e89b-12d3-a456-426614174000": True}
    frame = spark.createDataFrame(list(cases.items()), "c string, want boolean")
    assert [r.c for r in frame.where(secrets.allowed(F.col("c")) != F.col("want")).collect()] == []


def test_entropy_spans_by_brute_force(spark):
    """Windows over the threshold, merged, of a plain count per window; thousands of matches in one text."""
    import math
    import random as rnd

    rng = rnd.Random(4)
    texts = ["".join(rng.choice("abcdef0123456789" if rng.random() < 0.5 else "ABCXYZxyz0189+/ ") for _ in range(400)) for _ in range(60)]
    texts += ["token=" + "".join(rng.choice("abcdefghijk0123") for _ in range(9)) + " "] + ["token=abcdefgh1 " * 3000]

    def spans(text):
        out = [(m.start(), m.end(), n) for n, (_, p, g, least) in enumerate(PATTERNS) for m in p.finditer(text) if len(m[g]) >= least]
        fresh = []
        for rank, cls in enumerate(secrets.CLASSES, 3):
            for m in re.finditer(cls.pattern, text):
                if any(re.search(a, m[0]) for a in secrets.ALLOW):
                    continue
                body, hot = m[0].lower() if cls.alphabet == cls.alphabet.lower() else m[0], []
                for k in range(len(body) - cls.window + 1):
                    counts = collections.Counter(body[k : k + cls.window]).values()
                    if -sum(c / cls.window * math.log2(c / cls.window) for c in counts) >= cls.threshold - 1e-12:
                        if hot and hot[-1][1] >= k + 1:
                            hot[-1][1] = k + cls.window
                        else:
                            hot.append([k, k + cls.window])
                fresh += [(m.start() + a, m.start() + b, rank) for a, b in hot]
        clash = lambda x, y: x[0] < y[1] and y[0] < x[1]
        return sorted(out + [x for x in fresh if not any(clash(x, y) for y in out) and not any(y[2] < x[2] and clash(x, y) for y in fresh)])

    got = secrets.scan(spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string")).collect()
    assert all(sorted((s.start, s.end, s.rank) for s in r.all_spans) == spans(texts[r.k]) for r in got)
    assert sum(s.rank > 2 for r in got for s in r.all_spans) > 5
