"""Scalar helpers as SQL expressions: pseudonyms, references, dates, note encoding.

Like ``codes``, every function takes SQL expressions as text and returns one.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from cohortloom.functions.codes import text


def pseudonym(kind: str, key: str, salt: str) -> str:
    """Keyed digest of ``key`` laid out as a UUID; NULL for a NULL key.

    The same key gives the same id in every run and on every executor, so ids need no
    driver-side registry. The salt is a secret: without it a digest of a record number
    can be reversed by enumeration.
    """
    digest = f"sha2(concat({text(f'{salt}|{kind}|')}, {key}), 256)"
    return rf"regexp_replace(left({digest}, 32), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})', '$1-$2-$3-$4-')"


def row_key(columns: Sequence[str]) -> str:
    """One text key of several columns: each value after its length, NULL as a dash.

    Different values give different keys, whatever characters they hold.
    """
    parts = ", ".join(
        f"coalesce(concat(length(CAST({c} AS STRING)), ':', CAST({c} AS STRING)), '-')" for c in columns
    )
    return f"concat({parts})"


def day(date: str) -> str:
    """First ten characters of a date text."""
    return f"substring({date}, 1, 10)"


def reference_to(kind: str, uuid: str) -> str:
    return f"concat('{kind}/', {uuid})"


def bare_id(reference: str) -> str:
    """``Patient/x`` -> ``x``."""
    return f"substring_index({reference}, '/', -1)"


def parse_day(date: str, strict: bool = False) -> str:
    """``yyyy-MM-dd`` text to a date. Lenient by default: bad text gives NULL.

    A plain cast of ten-character text: it needs no formatter, which dominates the cost.
    """
    if strict:
        return f"to_date({date}, 'yyyy-MM-dd')"
    return f"IF(length({date}) = 10, try_cast({date} AS DATE), NULL)"


def trunc_day(unit: str, date: str) -> str:
    """Start of the week (Monday), month or day of a date."""
    return date if unit == "day" else f"trunc({date}, '{unit}')"


def to_int(value: str, strict: bool = False) -> str:
    return f"CAST({value} AS INT)" if strict else f"try_cast({value} AS INT)"


def age_in(as_of: str, birth_year: str) -> str:
    """Difference of calendar years, without a month correction."""
    return f"year({as_of}) - {birth_year}"


def as_of_date(as_of: str | dt.date | None) -> str:
    """Reporting date; today when not given."""
    return "current_date()" if as_of is None else f"DATE '{as_of}'"


def encode_note(note: str) -> str:
    """Base64 of the UTF-8 text on one line, whatever the session's chunking setting."""
    return f"translate(base64(encode({note}, 'UTF-8')), '\\r\\n', '')"


def decode_note(data: str) -> str:
    """Text of base64 data; undecodable data gives NULL."""
    return f"CAST(try_to_binary({data}, 'base64') AS STRING)"


def is_uuid(value: str) -> str:
    """Whether a text is a UUID, with or without urn prefix, braces and hyphens."""
    bare = f"regexp_replace({value}, 'urn:|uuid:|[{{}}-]', '')"
    return f"coalesce({bare} RLIKE '^[0-9a-fA-F]{{32}}$', false)"
