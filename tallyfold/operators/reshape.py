"""Flattening, declared mappings and type choices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    found: list[tuple[str, ...]] = []
    for field in schema.fields:
        here = (*path, field.name)
        found += _leaves(field.dataType, here) if isinstance(field.dataType, T.StructType) else [here]
    return found


def _reference(path: Sequence[str]) -> Column:
    return F.col(".".join(f"`{p}`" for p in path))


def flatten(df: DataFrame, *, separator: str = "_", strip: str = "") -> DataFrame:
    """Every struct member as a top-level column named by its path.

    ``strip`` is removed wherever it occurs in a name. One projection, built
    from the schema.
    """
    columns = []
    for path in _leaves(df.schema):
        name = separator.join(path).replace(".", separator)
        columns.append(_reference(path).alias(name.replace(strip, "") if strip else name))
    return df.select(*columns)


def all_to_string(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def apply_mapping(df: DataFrame, mapping: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Select ``(source, target, type)`` columns; values that do not fit the
    type become null. A struct asked for as string becomes its JSON text."""
    types = {f.name: f.dataType for f in df.schema.fields}
    columns = []
    for source, target, kind in mapping:
        column = F.col(f"`{source}`")
        nested = isinstance(types.get(source), (T.StructType, T.ArrayType, T.MapType))
        if kind == "string" and nested:
            column = F.to_json(column)
        elif not (kind in ("struct", "array", "map") or nested):
            column = column.try_cast(kind)
        columns.append(column.alias(target))
    return df.select(*columns)


def choice_struct(column: Column, types: Sequence[str] = ("long", "double", "string")) -> Column:
    """Values of mixed type, read as text, as a struct with one member per
    type: the first type a value fits holds it, the others are null."""
    members, taken = [], F.lit(False)
    for kind in types:
        typed = column.try_cast(kind)
        members.append(F.when(~taken, typed).alias(kind))
        taken = taken | typed.isNotNull()
    return F.when(column.isNotNull(), F.struct(*members))


def fit_types(df: DataFrame, schema: T.StructType, *, misfits: str | None = None) -> DataFrame:
    """Columns read as text in the types of ``schema``; what does not fit is null.

    ``misfits`` names a further column that keeps those values, as a map from
    the path of a member to its choice struct (null where all fit).
    """
    lost: list[Column] = []

    def fitted(path: tuple[str, ...], kind: T.DataType) -> Column:
        column = _reference(path)
        if isinstance(kind, T.StructType):
            members = [fitted((*path, f.name), f.dataType).alias(f.name) for f in kind.fields]
            return F.when(column.isNotNull(), F.struct(*members))
        if isinstance(kind, T.StringType):
            return column
        typed = column.try_cast(kind)
        entry = F.struct(F.lit(".".join(path)).alias("path"), choice_struct(column).alias("value"))
        lost.append(F.when(column.isNotNull() & typed.isNull(), entry))
        return typed

    columns = [fitted((f.name,), f.dataType).alias(f.name) for f in schema.fields]
    if misfits:
        kept = F.array_compact(F.array(*lost))
        columns.append(F.when(F.size(kept) > 0, F.map_from_entries(kept)).alias(misfits))
    return df.select(*columns)


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Drop columns without a single value. Runs one aggregate and brings one
    row of counts to the driver."""
    names = df.columns
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(names)]).first()
    return df.select(*[F.col(f"`{c}`") for i, c in enumerate(names) if counts[i] > 0])
