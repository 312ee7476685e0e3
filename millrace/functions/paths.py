"""Paths into nested message schemas, e.g. ``details.items.value[3]``.

A path is dotted field names, each optionally followed by ``[i]``. Everything
here works on a schema at plan time; no job runs and no row is touched.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STEP = re.compile(r"(?:`((?:[^`]|``)+)`|([^.`\[\]]+))((?:\[\d+\])*)(\.|$)")


@dataclass(frozen=True)
class Step:
    """One field name of a path and the array positions taken right after it."""

    name: str
    positions: tuple[int, ...] = ()


def parse_path(path: str) -> tuple[Step, ...]:
    """Split a path into steps; names with odd characters may be back-quoted."""
    text, at, steps = path.strip(), 0, []
    while at < len(text):
        found = _STEP.match(text, at)
        if found is None:
            raise ValueError(f"not a path: {path!r}")
        quoted, plain, positions, dot = found.groups()
        name = quoted.replace("``", "`") if quoted else plain.strip()
        steps.append(Step(name, tuple(int(i) for i in re.findall(r"\d+", positions))))
        at = found.end()
        if dot and at == len(text):
            raise ValueError(f"not a path: {path!r}")
    if not steps:
        raise ValueError("empty path")
    return tuple(steps)


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _find(struct: T.StructType, name: str, case_sensitive: bool) -> T.StructField | None:
    for field in struct.fields:
        if field.name == name:
            return field
    if not case_sensitive:
        for field in struct.fields:
            if field.name.lower() == name.lower():
                return field
    return None


def path_type(
    schema: T.StructType, path: str, case_sensitive: bool = False
) -> T.DataType | None:
    """Type a path resolves to, or ``None`` when the schema does not have it.

    A field taken across an array of structs gives an array of that field.
    Arrays of arrays cannot be crossed by name.
    """
    current: T.DataType = schema
    for step in parse_path(path):
        across = isinstance(current, T.ArrayType)
        inner = current.elementType if across else current
        if isinstance(inner, T.StructType):
            field = _find(inner, step.name, case_sensitive)
            if field is None:
                return None
            current = T.ArrayType(field.dataType) if across else field.dataType
        elif isinstance(inner, T.MapType) and not across and isinstance(inner.keyType, T.StringType):
            current = inner.valueType
        else:
            return None
        for _ in step.positions:
            if not isinstance(current, T.ArrayType):
                return None
            current = current.elementType
    return current


def has_path(schema: T.StructType, path: str, case_sensitive: bool = False) -> bool:
    """Whether a schema holds a path."""
    return path_type(schema, path, case_sensitive) is not None


def path_column(path: str) -> Column:
    """Column for a path. Positions past the end of an array give null."""
    first, *rest = parse_path(path)
    column = _take(F.col(quote(first.name)), first)
    for step in rest:
        column = _take(column.getField(step.name), step)
    return column


def _take(column: Column, step: Step) -> Column:
    for position in step.positions:
        column = F.get(column, F.lit(position))
    return column


def with_paths(
    schema: T.StructType, paths: Iterable[str], case_sensitive: bool = False
) -> T.StructType:
    """Schema widened so that every path resolves: missing leaves become STRING.

    Where the data already has another type at some step the schema is left as
    it is there.
    """
    for path in paths:
        schema = _widen(schema, parse_path(path), case_sensitive)
    return schema


def _widen(struct: T.StructType, steps: tuple[Step, ...], case_sensitive: bool) -> T.StructType:
    step, rest = steps[0], steps[1:]
    known = _find(struct, step.name, case_sensitive)
    if known is None:
        made = _widen(T.StructType(), rest, case_sensitive) if rest else T.StringType()
        for _ in step.positions:
            made = T.ArrayType(made)
        return T.StructType([*struct.fields, T.StructField(step.name, made)])
    changed = known.dataType
    if rest:
        changed = _widen_inside(changed, len(step.positions), rest, case_sensitive)
    return T.StructType(
        [T.StructField(f.name, changed if f is known else f.dataType) for f in struct.fields]
    )


def _widen_inside(
    current: T.DataType, positions: int, rest: tuple[Step, ...], case_sensitive: bool
) -> T.DataType:
    if isinstance(current, T.ArrayType):
        if positions:
            positions -= 1
        elif rest[0].positions:
            # Across an array a position picks from the extracted fields.
            rest = (Step(rest[0].name, rest[0].positions[1:]), *rest[1:])
        return T.ArrayType(_widen_inside(current.elementType, positions, rest, case_sensitive))
    if isinstance(current, T.StructType):
        return _widen(current, rest, case_sensitive)
    return current


def only_paths(
    schema: T.StructType, paths: Iterable[str], case_sensitive: bool = False
) -> T.StructType:
    """Schema cut down to the fields that some path runs through or ends at.

    What lies below the end of a path is kept whole. Paths the schema does not
    have are ignored.
    """
    return _narrow(schema, [[s.name for s in parse_path(p)] for p in paths], case_sensitive)


def _narrow(struct: T.StructType, paths: list[list[str]], case_sensitive: bool) -> T.StructType:
    kept = []
    for known in struct.fields:
        inside = [p[1:] for p in paths if _find(struct, p[0], case_sensitive) is known]
        if not inside:
            continue
        whole = any(not p for p in inside)
        kind = known.dataType if whole else _narrow_inside(known.dataType, inside, case_sensitive)
        kept.append(T.StructField(known.name, kind))
    return T.StructType(kept)


def _narrow_inside(
    current: T.DataType, paths: list[list[str]], case_sensitive: bool
) -> T.DataType:
    if isinstance(current, T.ArrayType):
        return T.ArrayType(_narrow_inside(current.elementType, paths, case_sensitive))
    if isinstance(current, T.StructType):
        return _narrow(current, paths, case_sensitive)
    return current


def with_text(schema: T.StructType, paths: Iterable[str]) -> T.StructType:
    """Schema in which the plain values that some paths end at are read as text.

    Values inside an array of structs count; nested values and paths the schema lacks stay.
    """
    for path in paths:
        if path_type(schema, path) is not None:
            schema = _as_text(schema, [step.name for step in parse_path(path)])
    return schema


def _as_text(current: T.DataType, names: list[str]) -> T.DataType:
    if isinstance(current, T.ArrayType):
        return T.ArrayType(_as_text(current.elementType, names))
    if not names:
        plain = not isinstance(current, (T.StructType, T.MapType))
        return T.StringType() if plain else current
    if not isinstance(current, T.StructType):
        return current
    known = _find(current, names[0], False)
    return T.StructType(
        [T.StructField(f.name, _as_text(f.dataType, names[1:]) if f is known else f.dataType) for f in current.fields]
    )
