"""Argument checks, done on the driver before a plan is built."""

from __future__ import annotations

import re

from sparkvec.functions.vectors import check_metric

MAX_TOP_K = 1000
MAX_DIMENSIONS = 65535
WEIGHT_TOLERANCE = 0.001

_TABLE_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]{0,63}\Z")

__all__ = [
    "MAX_DIMENSIONS",
    "MAX_TOP_K",
    "check_dimensions",
    "check_metric",
    "check_probes",
    "check_query_text",
    "check_table_name",
    "check_top_k",
    "check_weights",
]


def check_table_name(name: str) -> str:
    """ASCII letters, digits and ``_``; no leading digit; at most 64 characters."""
    if not name or not _TABLE_NAME.match(name):
        raise ValueError(f"invalid table name {name!r}")
    return name


def check_dimensions(dimensions: int) -> int:
    if not 1 <= dimensions <= MAX_DIMENSIONS:
        raise ValueError(f"dimensions must be in 1..{MAX_DIMENSIONS}, not {dimensions}")
    return dimensions


def check_top_k(top_k: int, maximum: int | None = None) -> int:
    if top_k < 1 or (maximum is not None and top_k > maximum):
        raise ValueError(f"top_k must be in 1..{maximum or ''}, not {top_k}")
    return top_k


def check_query_text(text: str) -> str:
    if text is None or not text.strip():
        raise ValueError("the query text is blank")
    return text


def check_weights(text_weight: float, vector_weight: float) -> None:
    if abs(text_weight + vector_weight - 1.0) > WEIGHT_TOLERANCE:
        raise ValueError("text_weight and vector_weight must sum to 1")


def check_probes(probes: int, cells: int) -> int:
    if not 1 <= probes <= cells:
        raise ValueError(f"probes must be in 1..{cells}, not {probes}")
    return probes
