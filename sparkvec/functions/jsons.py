"""Predicates over a JSON string column, strict about JSON types."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_PLAIN_PATH = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)*\Z")


def json_path(key: str) -> str:
    """``a.b`` is the nested path; any other spelling is a literal top-level key."""
    if _PLAIN_PATH.match(key):
        return f"$.{key}"
    if "'" in key or not key:
        raise ValueError(f"metadata key {key!r} cannot be addressed")
    return f"$['{key}']"


def json_type(document: Column, path: str) -> Column:
    """``STRING``, ``BIGINT``, ``DOUBLE``, ``DECIMAL(p,s)``, ``BOOLEAN``, … or NULL."""
    return F.schema_of_variant(F.try_variant_get(F.try_parse_json(document), path, "variant"))


def _scalar_matches(document: Column, path: str, values: list) -> Column:
    """Value at ``path`` equals one of ``values``, all of one Python type.

    The text comparison comes first, so the typed parse runs only for rows that
    already match as text.
    """
    text = F.get_json_object(document, path)
    kind = json_type(document, path)
    sample = values[0]
    if isinstance(sample, bool):
        wanted = [str(v).lower() for v in values]
        return text.isin(wanted) & (kind == "BOOLEAN")
    if isinstance(sample, str):
        return text.isin(values) & (kind == "STRING")
    number = text.try_cast("double").isin([float(v) for v in values])
    exact = F.lit(True)
    if any(isinstance(v, int) and abs(v) > 2**53 for v in values):
        # Doubles cannot tell large integers apart.
        literals = [F.lit(str(v)).cast("decimal(38,0)") for v in values]
        exact = text.try_cast("decimal(38,0)").isin(literals)
    return number & exact & (kind != "STRING") & (kind != "BOOLEAN")


def metadata_matches(document: Column, key: str, value) -> Column:
    """``key`` equals ``value``, or is one of the values of a list."""
    path = json_path(key)
    values = list(value) if isinstance(value, (list, tuple, set)) else [value]
    if not values:
        raise ValueError(f"the value list for {key!r} is empty")
    groups: dict[type, list] = {}
    for item in values:
        if not isinstance(item, (bool, str, int, float)):
            raise ValueError(f"unsupported metadata value for {key!r}: {item!r}")
        groups.setdefault(type(item), []).append(item)
    condition = F.lit(False)
    for same_type in groups.values():
        condition = condition | _scalar_matches(document, path, same_type)
    return F.coalesce(condition, F.lit(False))
