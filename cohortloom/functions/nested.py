"""Builders for nested resource columns, as SQL expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cohortloom import schemas
from cohortloom.functions.codes import text


def struct_of(kind: T.StructType, values: Mapping[str, str]) -> str:
    """Struct with the fields of ``kind``; fields not given are NULL."""
    unknown = set(values) - set(kind.fieldNames())
    if unknown:
        raise ValueError(f"no such field: {sorted(unknown)}")
    return "named_struct(" + ", ".join(
        f"'{f.name}', {values.get(f.name, 'NULL')}" for f in kind.fields
    ) + ")"


_CODING = T.StructType(schemas.CODING_FIELDS)
_CONCEPT = schemas.element_struct(schemas.concept("x"))
_CODED = schemas.element_struct(schemas.coded("x"))
_INNER_EXTENSION = T.StructType(schemas.INNER_EXTENSION_FIELDS)
_EXTENSION = T.StructType(schemas.EXTENSION_FIELDS)


def field_struct(resource: str, field: str, values: Mapping[str, str]) -> str:
    """Struct (or array element) of a resource field."""
    return struct_of(schemas.element_struct(schemas.RESOURCES[resource][field]), values)


def array(*items: str) -> str:
    return f"array({', '.join(items)})"


def coding(system: str = "NULL", code: str = "NULL", display: str = "NULL") -> str:
    return struct_of(_CODING, {"system": system, "code": code, "display": display})


def fixed_coding(*parts: str) -> str:
    """Coding of literal values."""
    return coding(*[text(p) for p in parts])


def concept(*codings: str) -> str:
    return concept_of(array(*codings))


def concept_of(codings: str) -> str:
    """CodeableConcept around an array of codings."""
    return struct_of(_CONCEPT, {"coding": codings})


def coded(codings: str) -> str:
    """CodeableConcept of a field that may carry extensions, around an array of codings."""
    return struct_of(_CODED, {"coding": codings})


def reference(ref: str) -> str:
    return f"named_struct('reference', {ref})"


def inner_extension(url: str, **value: str) -> str:
    return struct_of(_INNER_EXTENSION, {"url": text(url), **value})


def extension(url: str, *inner: str, **value: str) -> str:
    nested = {"extension": array(*inner)} if inner else {}
    return struct_of(_EXTENSION, {"url": text(url), **nested, **value})


def as_resource(df: DataFrame, resource: str, values: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Project ``df`` to a resource; fields not given are NULL. ``keep`` names columns that stay beside it."""
    kind = schemas.RESOURCES[resource]
    filled = {"resourceType": text(resource), **values}
    unknown = set(filled) - set(kind.fieldNames())
    if unknown:
        raise ValueError(f"no such field: {sorted(unknown)}")
    return df.selectExpr(*[
        f"CAST({filled.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS `{f.name}`"
        for f in kind.fields
    ], *keep)


def resource_struct(resource: str, values: Mapping[str, str]) -> str:
    """The same as a single struct column."""
    kind = schemas.RESOURCES[resource]
    filled = struct_of(kind, {"resourceType": text(resource), **values})
    return f"CAST({filled} AS {kind.simpleString()})"
