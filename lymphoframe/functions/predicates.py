"""Row filters of repertoire groups: a nested dict becomes one boolean Column.

A leaf is {"op": ..., "content": {"field": ..., "value": ...}}, a node {"op": "AND"|"OR", "content":
[...]} of any depth and number of terms. A leaf on a missing, empty, zero or false field is false for
every operator. Fields {v,d,j,c}_{call,gene,subgroup} are the call's name lists: there ``=`` and
``contains`` ask for membership and ``!=`` for its absence.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lymphoframe.schema import SEGMENTS

DERIVED = {f"{s}_{name}": f"{s}_{level}" for s in SEGMENTS for name, level in (("call", "allele"), ("gene", "gene"), ("subgroup", "subgroup"))}
_COMPARE = {"<": Column.__lt__, "<=": Column.__le__, ">": Column.__gt__, ">=": Column.__ge__}


#: Of operator, field and value: whether the names of a call (none: false, also null) pass.
NameTest = Callable[[str, str, object], Column]


def _by_names(op: str, field: str, value) -> Column:
    """The test on resolved calls."""
    names = F.col(DERIVED[field])
    test = {"=": F.array_contains(names, value), "contains": F.array_contains(names, value), "!=": ~F.array_contains(names, value)}.get(op, F.lit(False))
    return (F.size(names) > 0) & test


def _leaf(op: str, field: str, value, frame: DataFrame, names: NameTest) -> Column:
    if field in DERIVED:
        return F.coalesce(names(op, field, value), F.lit(False))
    if field not in frame.columns:
        return F.lit(False)
    column, kind = F.col(field), frame.schema[field].dataType
    there = column if isinstance(kind, T.BooleanType) else column != "" if isinstance(kind, T.StringType) else column != 0
    if op == "=":
        test = column == value
    elif op == "!=":
        test = column != value
    elif op == "contains":
        test = column.cast("string").contains(str(value))
    else:
        test = _COMPARE[op](column, value) if op in _COMPARE else F.lit(False)
    return F.coalesce(there & test, F.lit(False))


def predicate(spec: dict | None, frame: DataFrame, names: NameTest = _by_names) -> Column:
    """The filter as a Column over ``frame`` (resolved calls, unless ``names`` says otherwise); no filter is true, an
    unknown operator false."""
    if not spec:
        return F.lit(True)
    op = str(spec["op"])
    if op.upper() in ("AND", "OR"):
        terms = [predicate(x, frame, names) for x in spec["content"]]
        out = terms[0]
        for t in terms[1:]:
            out = out & t if op.upper() == "AND" else out | t
        return out
    return _leaf(op, spec["content"]["field"], spec["content"]["value"], frame, names)


class LabelSets:
    """Tests of calls that nobody has named: a call has a name where one of its labels is among those of that name.
    The sets are arrays of one row (``row``), made of the germline set; no lambda runs over a row."""

    def __init__(self) -> None:
        self._wanted: dict[tuple, Column] = {}

    def test(self, op: str, field: str, value) -> Column:
        segment, level = DERIVED[field].split("_")
        labels = F.split(F.coalesce(f"{segment}_call", F.lit("")), ",")
        has = lambda key, where: F.arrays_overlap(labels, F.col(self._set(key, where)))
        if op in ("=", "contains"):
            return has((level, value), F.col(level) == value)
        if op == "!=":
            return has((), F.lit(True)) & ~has((level, value, "or null"), F.col(level).isNull() | (F.col(level) == value))
        return F.lit(False)

    def _set(self, key: tuple, where: Column) -> str:
        self._wanted.setdefault(key, where)
        return f"_labels_{list(self._wanted).index(key)}"

    def row(self, names: DataFrame, most: int) -> DataFrame | None:
        """The sets asked for so far, of a table of labels and names of ``most`` rows at most; none if none was."""
        refused = F.raise_error(F.lit(f"more than {most} germline labels"))
        sets = [F.when(F.count("*") <= most, F.collect_set(F.when(where, F.col("label")))).otherwise(refused).alias(self._set(key, where)) for key, where in self._wanted.items()]
        return names.agg(*sets) if sets else None
