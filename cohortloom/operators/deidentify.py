"""Allow-list projection of resources: keep the listed leaves, drop the rest."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cohortloom import schemas
from cohortloom.functions import fixed_values as fv

Rule = tuple[str, str, str]
_BY_TYPE = re.compile(r"^nodesByType\('(\w+)'\)(?:\.(\w+))?$")


def default_rules() -> list[Rule]:
    return [tuple(line.split(",")) for line in fv.ALLOW_RULES_CSV.splitlines()]


def load_rules(spark: SparkSession, path: str) -> list[Rule]:
    """Rules of a (path, method, usecase) CSV file; plan input, read as a whole."""
    rows = spark.read.option("header", True).csv(path).select("path", "method", "usecase")
    return [tuple(r) for r in rows.where("path IS NOT NULL").collect()]


def rules_frame(spark: SparkSession, rules: Iterable[Rule]) -> DataFrame:
    return spark.createDataFrame(list(rules), "path string, method string, usecase string")


def _kept(path: str, field: T.StructField, parent_type: str, paths: set, types: set) -> bool:
    kind = schemas.fhir_type(field)
    return path in paths or (kind, None) in types or (parent_type, field.name) in types


def _plan(struct: T.StructType, prefix: str, parent_type: str, paths: set, types: set) -> dict:
    """Field name -> True (keep whole) or a nested plan, for what survives."""
    out: dict = {}
    for field in struct.fields:
        path = f"{prefix}.{field.name}"
        if _kept(path, field, parent_type, paths, types):
            out[field.name] = True
            continue
        inner = schemas.element_struct(field)
        if inner is not None:
            plan = _plan(inner, path, schemas.fhir_type(field), paths, types)
            if plan:
                out[field.name] = plan
    return out


def allow_plan(resource: str, rules: Iterable[Rule]) -> dict:
    """What the rules keep of a resource, resolved against its schema."""
    paths, types = set(), set()
    for path, method, _ in rules:
        if method != "keep":
            continue
        by_type = _BY_TYPE.match(path)
        if by_type:
            types.add((by_type.group(1), by_type.group(2)))
        else:
            paths.add(path)
    return _plan(schemas.RESOURCES[resource], resource, resource, paths, types)


def unmatched_rules(rules: Iterable[Rule]) -> list[Rule]:
    """Rules that name no field of any resource: mistyped, or for data that is not modelled."""
    paths, types = set(), set()

    def walk(struct: T.StructType, prefix: str) -> None:
        for field in struct.fields:
            kind, inner = schemas.fhir_type(field), schemas.element_struct(field)
            paths.add(f"{prefix}.{field.name}")
            types.add((kind, None))
            if inner is not None:
                types.update((kind, f.name) for f in inner.fields)
                walk(inner, f"{prefix}.{field.name}")

    for name, schema in schemas.RESOURCES.items():
        walk(schema, name)
    out = []
    for rule in rules:
        by_type = _BY_TYPE.match(rule[0])
        known = (by_type.group(1), by_type.group(2)) in types if by_type else rule[0] in paths
        if not known:
            out.append(rule)
    return out


def kept_leaves(resource: str, rules: Iterable[Rule]) -> list[str]:
    """Dotted leaf paths the rules keep, for review."""

    def walk(struct: T.StructType, plan: dict, prefix: str) -> list[str]:
        out = []
        for field in struct.fields:
            if field.name not in plan:
                continue
            path = f"{prefix}{field.name}"
            inner, part = schemas.element_struct(field), plan[field.name]
            if inner is None:
                out.append(path)
            else:
                whole = {f.name: True for f in inner.fields}
                out += walk(inner, whole if part is True else part, path + ".")
        return out

    return walk(schemas.RESOURCES[resource], allow_plan(resource, rules), "")


def _project(prefix: str, struct: T.StructType, plan: dict, depth: int = 0) -> list[tuple[str, str]]:
    """(name, expression) of what survives of one level."""
    out = []
    for field in struct.fields:
        part = plan.get(field.name)
        if part is None:
            continue
        source = f"{prefix}`{field.name}`"
        inner = schemas.element_struct(field)
        if part is not True and inner is not None:
            many = isinstance(field.dataType, T.ArrayType)
            name = f"e{depth}"
            kept = _project(f"{name}." if many else f"{source}.", inner, part, depth + 1)
            built = "named_struct(" + ", ".join(f"'{n}', {v}" for n, v in kept) + ")"
            if many:
                source = f"transform({source}, {name} -> {built})"
            else:
                source = f"CASE WHEN {source} IS NOT NULL THEN {built} END"
        out.append((field.name, source))
    return out


def project_allowed(
    df: DataFrame, resource: str, rules: Iterable[Rule] | None = None, base: Iterable[Rule] = (),
) -> DataFrame:
    """Keep only what the rules list; a listed inner node keeps its whole subtree.

    ``rules`` extend the ``base`` rules of a site and override them by path, so that a base
    may keep codes which the extension leaves alone. A rule that names no field is an error.
    A plain projection, so dropped leaves are never read from columnar storage.
    """
    own = default_rules() if rules is None else list(rules)
    merged = list({rule[0]: rule for rule in [*base, *own]}.values())
    unknown = unmatched_rules(merged)
    if unknown:
        raise ValueError(f"rules without a field: {[path for path, _, _ in unknown]}")
    plan = allow_plan(resource, merged)
    kept = _project("", schemas.RESOURCES[resource], plan)
    return df.selectExpr(*[f"{value} AS `{name}`" for name, value in kept])
