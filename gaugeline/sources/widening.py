"""Types of a table's columns that grow with what is written to it.

A column's type is the least one that holds every type written so far. Parquet files are not rewritten
when a type grows: values of the new type go to a physical column of their own, and a read brings the
parts together. The list of physical columns travels in the metadata of the recorded schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_HELD = "held"  # metadata: [[physical name, type], ...], the last one is written to
_WHOLE = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 20}  # with their decimal digits


class TypeDriftError(ValueError):
    """A column comes with a type that none can hold together with the table's."""


def supremum(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The least type that holds both, or None.

    Whole numbers grow up to BIGINT, with decimals to a decimal of enough digits (DOUBLE where 38 are too
    few), and with floating numbers to DOUBLE. Lists, maps and structs grow in what they hold; structs
    gain fields. Text, dates, times and flags hold only themselves.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    x, y = a.simpleString(), b.simpleString()
    if x in _WHOLE and y in _WHOLE:
        return max(a, b, key=lambda t: _WHOLE[t.simpleString()])
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        if x in ("float", "double") or y in ("float", "double"):
            return T.DoubleType()
        scale = max(getattr(t, "scale", 0) for t in (a, b))
        whole = max(t.precision - t.scale if isinstance(t, T.DecimalType)
                    else _WHOLE[t.simpleString()] for t in (a, b))
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        element = supremum(a.elementType, b.elementType)
        return element and T.ArrayType(element)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        key, value = supremum(a.keyType, b.keyType), supremum(a.valueType, b.valueType)
        return T.MapType(key, value) if key == a.keyType == b.keyType and value else None
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        fields = {f.name: f.dataType for f in a}
        for f in b:
            fields[f.name] = supremum(fields.get(f.name, T.NullType()), f.dataType)
        if all(fields.values()):
            return T.StructType([T.StructField(n, t) for n, t in fields.items()])
    return None


def _same(a: T.DataType, b: T.DataType) -> bool:
    """Equal but for what says whether parts may be null."""
    return a.simpleString() == b.simpleString()


def grown(known: T.StructType | None, written: T.StructType,
          fixed: tuple[str, ...] | list[str] = ()) -> T.StructType:
    """Schema of a table after a batch; raises before anything is written that it could not hold.

    Columns named in ``fixed``, those a table is partitioned by, keep their type.
    """
    fields = {f.name: f for f in known or ()}
    drift = []
    for f in written:
        old = fields.get(f.name)
        if old is None:
            fields[f.name] = T.StructField(f.name, f.dataType, True)
            continue
        wide = supremum(old.dataType, f.dataType)
        if wide is None or f.name in fixed and not _same(wide, old.dataType):
            drift.append(f"{f.name}: {old.dataType.simpleString()} in the table, "
                         f"{f.dataType.simpleString()} in the batch")
        elif not _same(wide, old.dataType):
            held = [*_physical(old), [f"{f.name}__{len(_physical(old))}", wide.simpleString()]]
            fields[f.name] = T.StructField(f.name, wide, True, {_HELD: held})
    if drift:
        raise TypeDriftError("; ".join(drift))
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in fields.values()])


def _physical(field: T.StructField) -> list[list[str]]:
    return field.metadata.get(_HELD) or [[field.name, field.dataType.simpleString()]]


def physical_schema(schema: T.StructType) -> T.StructType:
    """What the files may hold."""
    out = []
    for f in schema:
        *older, (name, _) = _physical(f)
        out += [T.StructField(n, _parsed(kind), True) for n, kind in older]
        out.append(T.StructField(name, f.dataType, True))
    return T.StructType(out)


def _parsed(kind: str) -> T.DataType:
    return T.StructType.fromDDL(f"x {kind}")["x"].dataType


def to_logical(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of the table from those of its files."""
    if not any(len(_physical(f)) > 1 for f in schema):
        return df
    return df.select(*[F.coalesce(*[F.col(n).cast(f.dataType) for n, _ in _physical(f)]).alias(f.name)
                       for f in schema])


def to_physical(df: DataFrame, schema: T.StructType) -> DataFrame:
    """A batch in the types of the table, under the names its files use now."""
    fields = {f.name: f for f in schema}
    return df.select(*[
        (F.col(c) if _same(df.schema[c].dataType, fields[c].dataType)
         else F.col(c).cast(fields[c].dataType)).alias(_physical(fields[c])[-1][0])
        for c in df.columns])
