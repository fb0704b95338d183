"""Turn resources into stored tables: flatten extensions, add annotation columns.

The pass is driven by the resource schema and is a single projection: no shuffle, no
UDF. Top-level columns a reader does not use are pruned together with their annotation.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cohortloom import schemas
from cohortloom.functions import fixed_values as fv
from cohortloom.functions import scalars
from cohortloom.functions.codes import one_of


def date_range(date: str) -> str:
    """(start, end) days covered by a partial date: year, month, or day and finer."""

    def span(first: str, last: str) -> str:
        return f"named_struct('start', CAST({first} AS STRING), 'end', CAST({last} AS STRING))"

    january = f"try_cast(concat({date}, '-01-01') AS DATE)"
    month = f"try_cast(concat({date}, '-01') AS DATE)"
    day = f"try_cast(left({date}, 10) AS DATE)"
    return (
        f"CASE WHEN length({date}) >= 10 THEN {span(day, day)}"
        f" WHEN length({date}) = 7 THEN {span(month, f'last_day({month})')}"
        f" WHEN length({date}) = 4 THEN {span(january, f'last_day(add_months({january}, 11))')}"
        f" ELSE {span('NULL', 'NULL')} END"
    )


def trim_extension_path(path: str) -> str:
    """Collapse runs of extension segments of a dotted path to their first segment."""
    parts = f"split({path}, '[.]')"
    again = one_of("p", fv.EXTENSION_SEGMENTS) + " AND " + one_of(
        f"get({parts}, i - 1)", fv.EXTENSION_SEGMENTS
    )
    return f"array_join(filter({parts}, (p, i) -> NOT coalesce({again}, false)), '.')"


_VALUES = [f.name for f in schemas.EXTENSION_VALUES]


def _plain_values(source: str) -> list[tuple[str, str]]:
    return [(v, f"{source}{v}") for v in _VALUES]


def flatten_extensions(extensions: str, values=_plain_values) -> str:
    """Nested extension arrays as one array of (url, parent, values).

    An outer element comes first, and only if it has a value of its own; its children
    follow with ``parent`` set to its url. NULL stays NULL. ``values`` gives the value
    fields of an element, so that further columns are made in the same pass.
    """

    def element(source: str, parent: str) -> str:
        fields = ", ".join(f"'{name}', {v}" for name, v in values(f"{source}."))
        return f"named_struct('url', {source}.url, 'parent', {parent}, {fields})"

    has_value = " OR ".join(f"o.{v} IS NOT NULL" for v in _VALUES)
    own = f"CASE WHEN {has_value} THEN array({element('o', 'CAST(NULL AS STRING)')}) ELSE array() END"
    inner = f"transform(coalesce(o.extension, array()), c -> {element('c', 'o.url')})"
    return f"flatten(transform({extensions}, o -> concat({own}, {inner})))"


def _annotated(prefix: str, fields: list[T.StructField], parent_type: str, names) -> list[tuple[str, str]]:
    """(name, expression) of the stored fields of one level."""
    out: list[tuple[str, str]] = []
    for field in fields:
        kind = schemas.fhir_type(field)
        value = source = f"{prefix}`{field.name}`"
        if kind in schemas.SKIPPED_TYPES:
            continue
        struct = schemas.element_struct(field)
        if kind == "Extension":
            value = flatten_extensions(
                value, lambda inner: _annotated(inner, schemas.EXTENSION_VALUES, "Extension", names)
            )
        elif struct is not None:
            many = isinstance(field.dataType, T.ArrayType)
            value = _rebuilt(value, struct.fields, kind, many, names)
        out.append((field.name, value))
        if kind in schemas.DATE_TYPES:
            out.append((field.name + "_aa", date_range(source)))
        elif parent_type == "Reference" and field.name == "reference":
            out.append(("reference_id_aa", scalars.bare_id(source)))
        elif kind == "string":
            out.append((field.name + "_aa", source))
    return out


def _rebuilt(value: str, fields: list[T.StructField], kind: str, many: bool, names) -> str:
    prefix = f"e{next(names)}" if many else value
    inner = _annotated(prefix + ".", fields, kind, names)
    struct = "named_struct(" + ", ".join(f"'{n}', {v}" for n, v in inner) + ")"
    if many:
        return f"transform({value}, {prefix} -> {struct})"
    return f"CASE WHEN {value} IS NOT NULL THEN {struct} END"


def to_stored(df: DataFrame, resource: str) -> DataFrame:
    """Resource rows as the stored table of ``schemas.stored(resource)``."""
    columns = _annotated("", schemas.RESOURCES[resource].fields, resource, count())
    return df.selectExpr(*[f"{value} AS `{name}`" for name, value in columns])
