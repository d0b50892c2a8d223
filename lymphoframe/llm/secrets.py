"""Secret scans: pattern kinds plus sliding-window Shannon entropy, built of SQL functions only.

The entropy pass takes candidate strings of one character class (hex digits, base64 letters),
moves a window over each and keeps the counts of its characters up to date: one character
enters, one leaves, and the sum of c*log2(c) changes by two terms. Windows at or above the
class's threshold are merged into spans; candidates on the allow list are left out.

Defined results: null text counts as empty and has no spans; offsets are code points with an
exclusive end; repeated rows are scanned alike; other columns pass through ``scan`` untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lymphoframe.llm.common import let, table

#: The base kinds in their order: pattern, group whose length counts, least length.
BASE = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
)


@dataclass(frozen=True)
class EntropyClass:
    kind: str
    pattern: str
    alphabet: str
    window: int
    threshold: float


#: hex: 24 random digits have about 3.5 bits; base64: 20 random letters about 4.1 bits.
CLASSES = (
    EntropyClass("entropy_hex", r"(?<![A-Za-z0-9+/_-])[0-9A-Fa-f]{24,}(?![A-Za-z0-9+/_-])", "0123456789abcdef", 24, 3.0),
    EntropyClass("entropy_base64", r"[A-Za-z0-9+/_-]{20,}", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-", 20, 3.7),
)

#: Candidates that are no secrets: such whose parts between - _ / + are all plain words (lower case, one
#: capital at most, or all capitals) or plain numbers of up to eight digits, as in paths and slugs;
#: digits and signs alone; repeated characters; UUIDs.
PART, BETWEEN = r"^([A-Za-z]?[a-z]+|[A-Z]+|[0-9]{1,8})$", r"[-_/+]+"
ALLOW = (
    r"^[0-9+/_-]+$",
    r"^(.)\1+$",
    r"^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$",
)


def allowed(candidate: Column) -> Column:
    """True for a candidate on the allow list. Parts are matched one by one: a pattern that repeats a group
    over a whole candidate recurses once for each part, and a long one ends the JVM's stack."""
    parts = F.filter(F.split(candidate, BETWEEN, -1), lambda x: x != "")
    plain = let(parts, lambda ps: (F.size(ps) > 0) & F.forall(ps, lambda x: x.rlike(PART)))
    return F.coalesce(*[F.when(candidate.rlike(p), True) for p in ALLOW], plain)


_SPAN = "struct<start:bigint,end:bigint,rank:int,kind:string>"
_NONE = f"cast(array() as array<{_SPAN}>)"


#: Matches are laid end to end in blocks, so that a list of many is not copied for each of them.
BLOCK = 64


def _located(text: Column, pattern: str, group: int) -> Column:
    """array<struct<start,end,part>> of the leftmost non-overlapping matches: the pieces between
    matches and the matches themselves, laid end to end, give the offsets."""
    rows = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("part"),
    )
    row = "array<struct<start:bigint,end:bigint,part:string>>"
    empty = lambda at, kind: F.struct(at.alias("at"), F.expr(f"cast(array() as {kind})").alias("out"))

    def one(acc, x):
        start = acc["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["hit"]), F.lit(0))
        found = F.struct(start.cast("bigint").alias("start"), end.cast("bigint").alias("end"), x["part"].alias("part"))
        return F.struct(end.cast("bigint").alias("at"), F.when(x["hit"].isNull(), acc["out"]).otherwise(F.array_append(acc["out"], found)).alias("out"))

    def blocks(all_rows):
        def block(acc, k):
            inside = F.aggregate(F.slice(all_rows, k * BLOCK + 1, BLOCK), empty(acc["at"], row), one)
            return let(inside, lambda b: F.struct(b["at"].alias("at"), F.array_append(acc["out"], b["out"]).alias("out")))

        last = F.floor((F.greatest(F.size(all_rows), F.lit(1)) - 1) / BLOCK).cast("int")
        return F.aggregate(F.sequence(F.lit(0), last), empty(F.lit(0).cast("bigint"), f"array<{row}>"), block, lambda acc: F.flatten(acc["out"]))

    return let(rows, blocks)


def _as_spans(hits: Column, rank: int, kind: str) -> Column:
    return F.transform(hits, lambda x: F.struct(x["start"], x["end"], F.lit(rank).alias("rank"), F.lit(kind).alias("kind")))


def _long_enough(hits: Column, least: int) -> Column:
    return F.filter(hits, lambda x: F.length(x["part"]) >= least)


def base_spans(text: Column) -> Column:
    found = []
    for rank, (kind, pattern, group, least) in enumerate(BASE):
        spans = _as_spans(_long_enough(_located(text, pattern, group), least), rank, kind)
        found.append(F.when(text.rlike(pattern), spans).otherwise(F.expr(_NONE)))
    return F.array_sort(F.concat(*found))


def _windows(cls: EntropyClass, text: Column) -> Column:
    """array<struct<s,e>> (1-based first, last position) of merged windows over the threshold."""
    w, most = cls.window, len(cls.alphabet)
    state = f"named_struct('n', array_repeat(0, {most + 1}), 's', 0D, 'out', cast(array() as array<struct<s:int,e:int>>))"
    plogp = lambda c: F.when(c <= 0, F.lit(0.0)).otherwise(c * F.log2(c))

    def over(slots):
        def step(acc, i):
            a, b, full = F.get(slots, i - 1), F.get(slots, i - 1 - w), i > w
            ca, cb = F.get(acc["n"], a), F.get(acc["n"], b)
            same = full & (a == b)
            counts = F.transform(acc["n"], lambda c, k: c + F.when(k == a, 1).otherwise(0) - F.when(full & (k == b), 1).otherwise(0))
            s = F.when(same, acc["s"]).otherwise(acc["s"] + plogp(ca + 1) - plogp(ca) + F.when(full, plogp(cb - 1) - plogp(cb)).otherwise(0.0))
            return let(F.struct(F.when(same, acc["n"]).otherwise(counts).alias("n"), s.alias("s"), acc["out"].alias("out"), i.alias("i")), close)

        def close(new):
            i, out = new["i"], new["out"]
            first = (i - w + 1).cast("int")
            last = F.get(out, F.size(out) - 1)
            grown = F.concat(F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0))), F.array(F.struct(last["s"].alias("s"), i.cast("int").alias("e"))))
            fresh = F.array_append(out, F.struct(first.alias("s"), i.cast("int").alias("e")))
            hot = (i >= w) & (F.log2(F.lit(float(w))) - new["s"] / w >= cls.threshold)
            return F.struct(new["n"].alias("n"), new["s"].alias("s"), F.when(hot, F.when((F.size(out) > 0) & (last["e"] >= first), grown).otherwise(fresh)).otherwise(out).alias("out"))

        return F.aggregate(F.sequence(F.lit(1), F.size(slots)), F.expr(state), step, lambda acc: acc["out"])

    folded = F.lower(text) if cls.alphabet == cls.alphabet.lower() else text
    return let(F.transform(F.split(folded, ""), lambda c: F.instr(F.lit(cls.alphabet), c).cast("int")), over)


def _class_spans(text: Column, cls: EntropyClass, rank: int) -> Column:
    cands = F.filter(_located(text, cls.pattern, 0), lambda x: ~allowed(x["part"]))
    inside = lambda x: F.transform(_windows(cls, x["part"]), lambda v: F.struct(
        (x["start"] + v["s"] - 1).alias("start"), (x["start"] + v["e"]).cast("bigint").alias("end"), F.lit(rank).alias("rank"), F.lit(cls.kind).alias("kind")))
    return F.when(text.rlike(cls.pattern), F.flatten(F.transform(cands, inside))).otherwise(F.expr(_NONE))


def entropy_spans(text: Column) -> Column:
    return F.concat(*[_class_spans(text, cls, rank) for rank, cls in enumerate(CLASSES, len(BASE))])


def scan(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``base_spans`` and ``all_spans``: array<struct<start,end,rank,kind>> sorted by start, kind.

    Entropy spans that touch a base span, or the same place in an earlier class, are not repeated."""
    body = F.coalesce(F.col(text), F.lit(""))
    clash = lambda x, y: (x["start"] < y["end"]) & (y["start"] < x["end"])
    out = df.withColumn("base_spans", base_spans(body)).withColumn("_entropy", entropy_spans(body))
    fresh = F.filter("_entropy", lambda x: ~F.exists("base_spans", lambda y: clash(x, y)) & ~F.exists("_entropy", lambda y: (y["rank"] < x["rank"]) & clash(x, y)))
    return out.withColumn("all_spans", F.array_sort(F.concat("base_spans", fresh))).drop("_entropy")


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """Each run of overlapping spans in ``text`` becomes ``[SECRET:kind]`` (the kind of its first span)."""
    found = scan(df, text)
    body = F.coalesce(F.col(text), F.lit(""))
    empty = F.expr("named_struct('at', 1L, 'out', '')")

    def step(acc, x):
        inside = x["start"] + 1 < acc["at"]
        gap = F.substr(body, acc["at"].cast("int"), (x["start"] + 1 - acc["at"]).cast("int"))
        return F.struct(F.greatest(acc["at"], x["end"] + 1).alias("at"),
                        F.when(inside, acc["out"]).otherwise(F.concat(acc["out"], gap, F.lit("[SECRET:"), x["kind"], F.lit("]"))).alias("out"))

    clean = F.aggregate("all_spans", empty, step, lambda acc: F.concat(acc["out"], F.substr(body, acc["at"].cast("int"))))
    return found.withColumn(text, F.when(F.size("all_spans") > 0, clean).otherwise(F.col(text))).drop("base_spans", "all_spans")


def _written(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda k: F.size(F.filter("base_spans", lambda x: x["kind"] == k)).cast("bigint").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k, *_ in BASE], F.sha2(_written("base_spans"), 256).alias("base_sha256"), _written("all_spans").alias("spans"))
