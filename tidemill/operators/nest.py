"""Flattening of objects to ``parent__child`` columns, and of lists to child tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW_ID, PARENT_KEY, INDEX = "_row_id", "_parent_id", "_list_idx"


def flat_fields(schema: T.StructType, prefix: tuple[str, ...] = ()) -> list[tuple[tuple[str, ...], T.DataType]]:
    """Paths of all fields that aren't objects."""
    out: list[tuple[tuple[str, ...], T.DataType]] = []
    for f in schema:
        here = (*prefix, f.name)
        out += flat_fields(f.dataType, here) if isinstance(f.dataType, T.StructType) else [(here, f.dataType)]
    return out


def at(path: tuple[str, ...]) -> Column:
    return F.col(".".join(f"`{p}`" for p in path))


def flatten(df: DataFrame) -> DataFrame:
    """Fields of objects as columns ``parent__child``; lists stay."""
    return df.select(*[at(p).alias("__".join(p)) for p, _ in flat_fields(df.schema)])


def as_json(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.to_json(F.col(f"`{c}`")) for c in columns})


def nested(df: DataFrame, kinds: tuple[type, ...]) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, kinds)]


def row_id(df: DataFrame) -> Column:
    """The same for the same row of the same file: file and position where these are known, else the row itself."""
    known = [c for c in ("_source_file", "_position") if c in df.columns]
    parts = [F.col(c).cast("string") for c in known] if len(known) == 2 else [F.to_json(F.struct(*df.columns))]
    return F.sha2(F.concat_ws("|", *parts), 256)


def parent_of(name: str, tables) -> str | None:
    """The table whose list ``name`` is: the longest name that it goes on from."""
    return max((t for t in tables if name.startswith(f"{t}__")), key=len, default=None)


def denest(df: DataFrame, name: str, max_nesting: int | None = None, carried: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """The table and its child tables ``<table>__<field>``, recursively, in the order parent before child.

    Child rows have their parent's id, their place in the list and the ``carried`` columns. From ``max_nesting``
    levels on, lists stay JSON text; at 0 objects do so too.
    """
    if max_nesting == 0:
        return {name: as_json(df, nested(df, (T.StructType, T.ArrayType, T.MapType)))}
    lists = [p for p, t in flat_fields(df.schema) if isinstance(t, T.ArrayType)]
    if not lists:
        return {name: as_json(flatten(df), nested(flatten(df), (T.MapType,)))}
    own = df if ROW_ID in df.columns else df.withColumn(ROW_ID, row_id(df))
    flat = flatten(own)
    names = ["__".join(p) for p in lists]
    out = {name: as_json(flat.drop(*names), nested(flat.drop(*names), (T.MapType,)))}
    for c in names:
        meta = [m for m in carried if m in flat.columns]
        rows = flat.select(F.col(f"`{ROW_ID}`").alias(PARENT_KEY), *meta, F.posexplode(F.col(f"`{c}`")).alias(INDEX, "value"))
        rows = rows.withColumn(ROW_ID, F.sha2(F.concat_ws("|", PARENT_KEY, F.lit(c), F.col(INDEX).cast("string")), 256))
        value = rows.schema["value"].dataType
        if isinstance(value, T.StructType):
            rows = rows.select(*[x for x in rows.columns if x != "value"], "value.*")
        deeper = None if max_nesting is None else max_nesting - 1
        if deeper == 0:
            flat_rows = flatten(rows)
            out[f"{name}__{c}"] = as_json(flat_rows, nested(flat_rows, (T.ArrayType, T.MapType)))
        else:
            out |= denest(rows, f"{name}__{c}", deeper, carried)
    return out
