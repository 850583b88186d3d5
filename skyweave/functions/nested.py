"""Nested columns: arrays of structs addressed as ``column.field``."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Position of a row's first element, where an array goes on over several rows.
START = "_start"


def nested_fields(df: DataFrame, column: str) -> list[str]:
    """Field names of a nested column; empty for a plain one."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        return kind.elementType.fieldNames()
    return []


def full_column_names(df: DataFrame) -> list[str]:
    """All columns in order, nested ones as ``column.field``."""
    names: list[str] = []
    for column in df.columns:
        fields = nested_fields(df, column)
        names += [f"{column}.{field}" for field in fields] if fields else [column]
    return names


def available_columns(df: DataFrame, requested: Sequence[str]) -> tuple[list[str], list[str]]:
    """Requested names that exist, in request order, and the sorted ones that do not."""
    actual = set(full_column_names(df))
    return [c for c in requested if c in actual], sorted(set(requested) - actual)


def keep_fields(df: DataFrame, column: str, fields: Sequence[str]) -> Column:
    """A nested column cut to ``fields``.

    Reads the fields as parallel arrays, which lets the parquet scan skip the others;
    ``transform`` over the structs would read them all.
    """
    kinds = df.schema[column].dataType.elementType
    target = T.ArrayType(T.StructType([T.StructField(f, kinds[f].dataType, True) for f in fields]))
    return F.arrays_zip(*[F.col(f"{column}.`{field}`") for field in fields]).cast(target)


def drop_fields(df: DataFrame, column: str, fields: Iterable[str]) -> Column:
    gone = set(fields)
    return keep_fields(df, column, [f for f in nested_fields(df, column) if f not in gone])


def assign_fields(column: Column, fields: dict[str, callable]) -> Column:
    """Set sub-columns from functions of the element struct; null arrays stay null."""

    def assigned(element: Column) -> Column:
        for name, make in fields.items():
            element = element.withField(name, make(element))
        return element

    return F.transform(column, assigned)


def select_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Project on plain and ``column.field`` names; fields of one nested column stay together."""
    wanted: dict[str, list[str]] = {}
    for name in names:
        if name in df.columns:
            wanted.setdefault(name, [])
        else:
            column, _, field = name.partition(".")
            wanted.setdefault(column, []).append(field)
    return df.select(
        [
            keep_fields(df, column, fields).alias(column) if fields else F.col(column)
            for column, fields in wanted.items()
        ]
    )


def flatten(
    df: DataFrame, column: str, carry: Sequence[str], position: str = "_pos", outer: bool = False
) -> DataFrame:
    """One row per nested element with the carried parent columns and the element's position.

    Positions run on over the rows of a parent that has several. With ``outer`` a parent without
    elements gives one row with null fields.
    """
    explode = F.posexplode_outer if outer else F.posexplode
    start = F.col(START) if START in df.columns else F.lit(0).cast("long")
    rows = df.select(*carry, start.alias("_first"), explode(column).alias("_at", "_element"))
    return rows.select(*carry, (F.col("_first") + F.col("_at")).alias(position), "_element.*")


def nest(flat: DataFrame, on: Sequence[str], column: str, position: str = "_pos", max_rows: int = 100_000) -> DataFrame:
    """Rows back under their parents, in order of position, at most ``max_rows`` positions in a row.

    ``_start`` is the first position that a row can hold.
    """
    fields = [c for c in flat.columns if c not in (*on, position)]
    start = (F.floor(F.col(position) / max_rows) * max_rows).cast("long")
    ordered = F.array_sort(F.collect_list(F.struct(position, F.struct(*fields).alias("_row"))))
    return flat.groupBy(*on, start.alias(START)).agg(F.transform(ordered, lambda e: e["_row"]).alias(column))
