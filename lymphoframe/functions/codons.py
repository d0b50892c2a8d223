"""Codon translation of gapped alignments as Column expressions."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the standard genetic code, amino acids by codons in the order of T, C, A, G.
BASES = "TCAG"
CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
#: Fixed value: ambiguous bases and what each may stand for.
AMBIGUOUS = {"N": "ACGT", "R": "AG", "Y": "CT", "S": "CG", "W": "AT", "K": "GT", "M": "AC", "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG"}


def codon_table() -> dict[str, str]:
    """Codon -> letter, also for ambiguous codons all of whose readings have the same letter."""
    plain = {"".join(c): a for c, a in zip(product(BASES, repeat=3), CODE, strict=True)}
    reads = {b: b for b in BASES} | AMBIGUOUS
    out = {}
    for c in product(reads, repeat=3):
        letters = {plain["".join(x)] for x in product(*(reads[b] for b in c))}
        if len(letters) == 1:
            out["".join(c)] = letters.pop()
    return out


def codons(aligned: Column) -> Column:
    """The alignment's codons (gaps ``-`` and ``.`` as ``.``), without a trailing part of one."""
    s = F.regexp_replace(aligned, "-", ".")
    n = F.floor(F.length(s) / 3)
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substr(s, (3 * i - 2).cast("int"), F.lit(3)))).otherwise(F.array().cast("array<string>"))


def translate(aligned: Column) -> Column:
    """One letter per codon: ``.`` for a codon of three gaps, ``X`` where the bases leave it open."""
    table = F.create_map(*[F.lit(x) for kv in codon_table().items() for x in kv])
    letter = lambda c: F.when(c == "...", ".").otherwise(F.coalesce(F.try_element_at(table, F.translate(F.upper(c), ".", "N")), F.lit("X")))
    return F.array_join(F.transform(codons(aligned), letter), "")
