"""Canonical JSON and the hashes over it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_json(fields: dict[str, Column]) -> Column:
    """Compact JSON with sorted keys; exact for ASCII values.  Null fields are left out."""
    return F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields))))


def stable_hash(fields: dict[str, Column], digits: int = 64) -> Column:
    return F.substring(F.sha2(canonical_json(fields), 256), 1, digits)


def pair_id(kind: Column, k_id: Column, p_id: Column) -> Column:
    """The stable id of a pair."""
    return stable_hash({"type": kind, "k": k_id, "p": p_id}, 24)
