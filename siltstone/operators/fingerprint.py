"""Fingerprints of rows that do not depend on their order: equal for equal rows, repeats counted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Two 64-bit hashes in parts of 21 bits. A sum of parts fits a long for up to 2^42 rows.
_SEEDS = (1, 2)
_BITS = 21
_SHIFTS = (0, 21, 42)


def row_hashes(columns: Sequence[str], name: str) -> dict[str, Column]:
    """Helper columns, one per seed, that ``fingerprint`` sums. A null is not an empty value here."""
    values = [v for c in columns for v in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return {f"{name}_{seed}": F.xxhash64(F.lit(seed), *values) for seed in _SEEDS}


def fingerprint(name: str, weight: Column | None = None) -> Column:
    """Aggregate over ``row_hashes``: sums of their parts. ``weight``: how often a row stands for itself."""
    sums = []
    for seed in _SEEDS:
        for shift in _SHIFTS:
            part = F.shiftrightunsigned(F.col(f"{name}_{seed}"), shift).bitwiseAND((1 << _BITS) - 1)
            sums.append(F.coalesce(F.sum(part if weight is None else part * weight), F.lit(0)))
    return F.array(*sums)


def fingerprint_of(df: DataFrame, columns: Sequence[str], weight: Column | None = None) -> list[int]:
    """The fingerprint of a frame's columns: one pass, one row per task."""
    hashed = df.withColumns(row_hashes(columns, "print"))
    return list(hashed.agg(fingerprint("print", weight).alias("sums")).first()["sums"])


def same_rows(left: DataFrame, right: DataFrame) -> bool:
    """Whether two frames of the same columns hold the same rows, each as often."""
    return fingerprint_of(left, left.columns) == fingerprint_of(right, left.columns)
