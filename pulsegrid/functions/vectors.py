"""Vector arithmetic on array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["cosine_similarity", "counted_slots", "dot", "l2_norm", "same_direction", "same_vector", "squared_distance"]


def _doubles(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("array<double>")


def _total(c: Column) -> Column:
    return F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column | str, b: Column | str) -> Column:
    return _total(F.zip_with(_doubles(a), _doubles(b), lambda x, y: x * y))


def l2_norm(a: Column | str) -> Column:
    return F.sqrt(dot(a, a))


def cosine_similarity(a: Column | str, b: Column | str) -> Column:
    """Null when either vector is all zero."""
    norms = l2_norm(a) * l2_norm(b)
    return F.when(norms != 0, dot(a, b) / norms)


def counted_slots(slots: Column | str) -> Column:
    """An array of numbers as its sorted distinct ``indices`` and, as ``values``, how often each occurs.

    Every step goes once over the sorted numbers. They and the starts of their runs are bound as
    variables of a lambda: an expression named inside another lambda would be computed anew for each element.
    """

    def runs(o: Column) -> Column:
        starts = F.array_compact(F.transform(o, lambda x, i: F.when((i == 0) | (x != F.get(o, i - 1)), i)))
        return F.transform(F.array(starts), lambda s: _run_lengths(o, s))[0]

    return F.transform(F.array(F.array_sort(slots)), runs)[0]


def _run_lengths(o: Column, starts: Column) -> Column:
    ends = F.slice(F.concat(starts, F.array(F.size(o))), F.lit(2), F.size(starts))
    lengths = F.zip_with(starts, ends, lambda a, b: (b - a).cast("double"))
    return F.struct(F.transform(starts, lambda i: F.get(o, i)).alias("indices"), lengths.alias("values"))


def squared_distance(a: Column | str, b: Column | str) -> Column:
    return _total(F.zip_with(_doubles(a), _doubles(b), lambda x, y: (x - y) * (x - y)))


def same_vector(a: Column | str, b: Column | str, tolerance: float = 0.0) -> Column:
    a, b = _doubles(a), _doubles(b)
    return (F.size(a) == F.size(b)) & F.forall(F.zip_with(a, b, lambda x, y: F.abs(x - y) <= tolerance), lambda ok: ok)


def same_direction(a: Column | str, b: Column | str, tolerance: float = 1e-6) -> Column:
    """Equal up to the sign of each component (principal axes have no fixed sign)."""
    a, b = _doubles(a), _doubles(b)
    return (F.size(a) == F.size(b)) & F.forall(
        F.zip_with(a, b, lambda x, y: F.abs(F.abs(x) - F.abs(y)) <= tolerance), lambda ok: ok
    )
