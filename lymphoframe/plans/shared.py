"""One scan of the rearrangements for all calculations of a run.

Calculations first say what they count: pieces, each a tag, key columns and a condition. A row leaves one
entry per piece, and one aggregate counts them all by (repertoire, passed groups, tag, productive,
keys); the result, far smaller than the rows, is written by tag. Each calculation then works on its own
pieces: usage and combinations on distinct calls, lengths and letters on distinct junctions, sharing on
junctions by gene, clones on their keys. Reports of rows themselves still read the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lymphoframe.functions.calls import is_productive, weight
from lymphoframe.operators import groups, junction
from lymphoframe.tables import written


@dataclass
class Piece:
    """``variants``: the key columns, by name, of each entry that a row leaves (one, but for usage). ``groups``: kept apart
    by the filtered groups that the row passes; ``filled``: by filters that see computed lengths. ``every``: of all
    repertoires, also where a run selects some. ``ordered``: with first_ord and the last row's weight."""

    variants: list[dict[str, Column]]
    where: Column | None = None
    groups: bool = True
    filled: bool = False
    every: bool = False
    ordered: bool = False


class Shared:
    """The pieces of a run, counted when the first one is asked for."""

    def __init__(self, rows: DataFrame, filters: dict[str, dict], selected: list[str] | None, order: str) -> None:
        self._rows, self._filters, self._selected, self._order = rows, filters, selected, order
        self._pieces: dict[str, Piece] = {}
        self._counted: DataFrame | None = None

    def add(self, tag: str, piece: Piece) -> None:
        if self._counted is not None:
            raise ValueError("pieces are added before the first is counted")
        self._pieces.setdefault(tag, piece)

    def _entries(self, tag: str, piece: Piece) -> list[Column]:
        where = F.lit(True) if piece.where is None else piece.where
        if self._selected and not piece.every:
            where &= F.col("repertoire_id").isin(self._selected)
        passed = F.col("_filled" if piece.filled else "_passed") if piece.groups else F.array().cast("array<string>")
        entry = lambda keys: F.struct(F.lit(tag).alias("tag"), passed.alias("passed"), F.lit(piece.ordered).alias("ordered"), F.array(*[k.cast("string") for k in keys.values()]).alias("k"))
        return [F.when(where, entry(keys)) for keys in piece.variants]

    def _count(self) -> DataFrame:
        # filters see the rows as they come, and those of length tables a missing length filled in
        plain = groups.with_passed(self._rows, self._filters).withColumnRenamed("passed", "_passed")
        rows = groups.with_passed(junction.with_length(plain), self._filters).withColumnRenamed("passed", "_filled")
        every = F.array_compact(F.array(*[e for tag, piece in self._pieces.items() for e in self._entries(tag, piece)]))
        ordered = any(p.ordered for p in self._pieces.values())
        place = [F.col(self._order).alias("_place")] if ordered else []
        left = rows.select("repertoire_id", is_productive().alias("productive"), weight().alias("w"), *place, F.explode(every).alias("x")).select("repertoire_id", "productive", "w", *(["_place"] if ordered else []), "x.*")
        measures = [F.count("*").alias("rows"), F.sum("w").alias("weights")]
        if ordered:
            at = F.when(F.col("ordered"), F.col("_place"))
            measures += [F.min(at).alias("first_ord"), F.max_by("w", at).alias("last_weight")]
        return written(left.groupBy("tag", "repertoire_id", "passed", "productive", "k").agg(*measures), "shared", "tag")

    def table(self, tag: str) -> DataFrame:
        """repertoire_id, passed, productive, the piece's keys, rows, weights (and first_ord, last_weight)."""
        if self._counted is None:
            self._counted = self._count()
        piece = self._pieces[tag]
        keys = [F.get("k", F.lit(i)).alias(name) for i, name in enumerate(piece.variants[0])]
        return self._counted.where(F.col("tag") == tag).select("repertoire_id", "passed", "productive", *keys, "rows", "weights", *(["first_ord", "last_weight"] if piece.ordered else []))
