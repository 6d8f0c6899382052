"""Column functions on arrays."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def size0(items: Column) -> Column:
    """Length of an array; a NULL array has none."""
    return F.coalesce(F.size(items), F.lit(0))


def or_empty(items: Column, kind: str = "array<string>") -> Column:
    return F.coalesce(items, F.array().cast(kind))


def has_items(items: Column) -> Column:
    return F.when(size0(items) > 0, 1).otherwise(0)


def field_distinct(items: Column, field: str) -> Column:
    """Distinct values of one field of an array of structs."""
    return F.array_distinct(F.transform(items, lambda x: x[field]))


def any_field_equals(items: Column, field: str, value: str) -> Column:
    return F.coalesce(F.exists(items, lambda x: x[field] == value), F.lit(False))


def merged(items: Iterable[Column], kind: str = "array<string>") -> Column:
    """Concatenation that reads a NULL array as empty and keeps repeats."""
    return F.concat(*[or_empty(a, kind) for a in items])


def flags_to_names(flags: Iterable[tuple[str, Column]]) -> Column:
    """Array of the names whose flag is set; its length is bounded by the list of names."""
    return F.array_compact(F.array(*[F.when(flag, F.lit(name)) for name, flag in flags]))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two double arrays; NULL if one has no length."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))
