"""Declarations: what a source holds, what a target table demands, how a merge treats columns."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T


@dataclass(frozen=True)
class SourceSpec:
    """One landed extract: object name, fields in read order, and their types.

    Fields default to text; ``types`` names the others. A dotted field is a member of a nested
    parent object.
    """

    name: str
    fields: tuple[str, ...]
    types: Mapping[str, T.DataType] = field(default_factory=dict)
    active_flag: str | None = "IsDeleted"

    def schema(self) -> T.StructType:
        out = T.StructType()
        parents: dict[str, list[T.StructField]] = {}
        for f in self.fields:
            kind = self.types.get(f, T.StringType())
            if "." in f:
                parent, child = f.split(".", 1)
                parents.setdefault(parent, []).append(T.StructField(child, kind))
            else:
                out = out.add(f, kind)
        for parent, children in parents.items():
            out = out.add(parent, T.StructType(children))
        return out


@dataclass(frozen=True)
class ForeignKey:
    column: str
    table: str
    ref: str = "id"


@dataclass(frozen=True)
class TableSpec:
    """Target table: columns, required columns, unique keys, foreign keys, value domains."""

    name: str
    schema: T.StructType
    required: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    foreign: tuple[ForeignKey, ...] = ()
    domains: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    defaults: Mapping[str, object] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return self.schema.names


@dataclass(frozen=True)
class MergeSpec:
    """How a source is merged into a target.

    ``key``      key columns in order of preference; the first non-null one identifies the row.
    ``order``    columns that order source rows of one key; the last one wins.
    ``rules``    per column, for matched rows:
                 source            take the source value (the default for source columns)
                 target            keep the target value
                 least / greatest  smaller / larger of both, nulls ignored
                 coalesce_source   source value unless null
                 coalesce_target   target value unless null
    ``changed``  only update when this column differs (null-safe); otherwise leave the row alone.
    ``unique``   the source is known to hold one row per key, so the collapse step is left out.
    ``delta``    the source is small next to the target: rewrite without shuffling the target.
    """

    key: tuple[str, ...]
    order: tuple[str, ...] = ()
    rules: Mapping[str, str] = field(default_factory=dict)
    changed: str | None = None
    unique: bool = False
    delta: bool = False


@dataclass(frozen=True)
class Lookup:
    """One foreign-key resolution: source column, key map, output column.

    ``required`` marks rows without a match as rejected with ``reason``. ``filled`` says that the source
    column is never null, as after a join on it; a partitioning by it is then used as it is.
    """

    src: str
    keys: DataFrame
    out: str
    required: bool = False
    reason: str | None = None
    default: Column | None = None
    filled: bool = False


KINDS = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "binary": T.BinaryType(),
}


def columns(text: str) -> T.StructType:
    """Schema from "name type, name type"; unlike the DDL parser it needs no running session."""
    out = T.StructType()
    for part in text.split(", "):
        name, kind = part.split()
        if kind.startswith("decimal("):
            precision, scale = kind[8:-1].split(",")
            out = out.add(name, T.DecimalType(int(precision), int(scale)))
        else:
            out = out.add(name, KINDS[kind])
    return out
