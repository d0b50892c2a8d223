"""Fixed values of the rearrangement world: schemas, segments, positions, regions."""

from __future__ import annotations

from pyspark.sql import types as T

SEGMENTS = ("v", "d", "j", "c")
LEVELS = ("allele", "gene", "subgroup")
MODES = ("unique", "exists", "proportion")
AMINO_ACIDS = "ACDEFGHIKLMNPQRSTVWY"
NUCLEOTIDES = "ACGT"
#: Aligned amino acid positions of each region, first and last.
REGIONS = {"fwr1": (1, 26), "cdr1": (27, 38), "fwr2": (39, 55), "cdr2": (56, 65), "fwr3": (66, 104)}
POSITIONS = 104

#: Typed columns of a rearrangement file; any other column stays text.
REARRANGEMENT = T.StructType([T.StructField(n, t) for n, t in (
    ("sequence_id", T.StringType()), ("repertoire_id", T.StringType()), ("locus", T.StringType()), ("productive", T.BooleanType()),
    ("v_call", T.StringType()), ("d_call", T.StringType()), ("j_call", T.StringType()), ("c_call", T.StringType()),
    ("junction", T.StringType()), ("junction_aa", T.StringType()), ("junction_length", T.LongType()), ("junction_aa_length", T.LongType()),
    ("duplicate_count", T.LongType()), ("clone_id", T.StringType()),
    *[(r, T.StringType()) for r in REGIONS])])
