"""Lineages embedded in labels (`name_d_X_p_Y`), where markers can be ambiguous: two readers, as Arrow functions."""

from __future__ import annotations

import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scalars import CODES, RANKS

_MARK = re.compile(r"_([a-z])_")
RESULT = T.StructType([T.StructField(r, T.StringType()) for r in RANKS])


def custom_levels(spec: str) -> dict[str, str]:
    """`kingdom:k__,clade:x` as code to rank; underscores of a code don't count."""
    out = {}
    for item in filter(None, (x.strip() for x in spec.split(","))):
        rank, _, code = item.partition(":")
        out[code.strip().strip("_")] = rank.strip()
    return out


def by_last_marker(label: str | None) -> dict[str, str | None] | None:
    """Values between known markers; null if a rank occurs twice (the greedy reader decides then)."""
    found = [m for m in _MARK.finditer(label or "") if m[1] in CODES]
    if len({m[1] for m in found}) < len(found):
        return None
    ends = [m.start() for m in found[1:]] + [len(label or "")]
    return {CODES[m[1]]: label[m.end() : e].strip("_") or None for m, e in zip(found, ends)}


def greedy(label: str | None) -> dict[str, str | None]:
    """From the first domain marker on, each known marker begins a value; an unknown one ends it."""
    start = (label or "").find("_d_")
    if start < 0:
        return {}
    out: dict[str, str | None] = {}
    parts = _MARK.split(label[start:])
    for code, value in zip(parts[1::2], parts[2::2]):
        if code in CODES:
            out.setdefault(CODES[code], value.strip("_") or None)
    return out


def embedded_lineage(label: str | None) -> tuple:
    found = by_last_marker(label)
    found = greedy(label) if found is None else found
    return tuple(found.get(r) for r in RANKS)


embedded_lineage_column = F.udf(embedded_lineage, RESULT, useArrow=True)
