"""Scalar column functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Nucleotide codes (IUPAC) and their complements, position by position.
BASES = "ACGTUNRYKMSWBDHVacgtunrykmswbdhv"
COMPLEMENTS = "TGCAANYRMKSWVHDBtgcaanyrmkswvhdb"


def floor_bin(x: Column, width: int) -> Column:
    """Start of the bin of `width` that holds x; below zero it is the bin to the left, not towards zero."""
    return (F.floor(x / F.lit(width)) * width).cast("long")


def midpoint(start: Column, end: Column) -> Column:
    return F.floor((start + end) / 2).cast("long")


def end_distance(bin: Column, length: Column, width: int) -> Column:
    """Distance of a bin to the nearer end of its sequence, in whole bins."""
    return F.least(bin, floor_bin(length - bin, width))


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b; null where b is null or 0."""
    return F.when(b != 0, a / b)


def coalesced_ratio(a: Column, b: Column) -> Column:
    """a / b with a missing numerator taken as 0."""
    return F.coalesce(a, F.lit(0)) / b


def log2_ratio(a: Column, b: Column) -> Column:
    return F.log2(a / b)


def length_weight(a: Column, b: Column) -> Column:
    """Cost of a link between sequences of these lengths: less for long ones."""
    return -F.log10((a + b) / F.lit(1e9))


def link_weight(n: Column) -> Column:
    """Cost of a link seen n times."""
    return -F.log10(n)


def region_name(name: Column, start: Column, end: Column) -> Column:
    return F.concat(name, F.lit(":"), start.cast("string"), F.lit("-"), end.cast("string"))


def bin_id(key: Column, bin: Column) -> Column:
    return F.concat_ws(":", key.cast("string"), bin.cast("string"))


def strand(orientation: Column) -> Column:
    """'-' for -1; '+' for 1 and where unknown."""
    return F.when(orientation == -1, "-").otherwise("+")


def reverse_complement(sequence: Column) -> Column:
    return F.reverse(F.translate(sequence, BASES, COMPLEMENTS))


def wrap(sequence: Column, width: int = 60) -> Column:
    """Line breaks after every `width` characters, none at the end."""
    return F.regexp_replace(sequence, f"(.{{{width}}})(?=.)", "$1\n")


def swap_if(condition: Column, a: str, b: str) -> dict[str, Column]:
    """Columns a and b exchanged where the condition holds; for withColumns()."""
    return {a: F.when(condition, F.col(b)).otherwise(F.col(a)), b: F.when(condition, F.col(a)).otherwise(F.col(b))}


def colour_index(x: Column, low: float, high: float, n: int) -> Column:
    """1..n by equal cuts of low..high; the top value falls in the last."""
    return F.least(F.width_bucket(x, F.lit(low), F.lit(high), F.lit(n)), F.lit(n))


def parse_size(text: str) -> int:
    """Bytes of a size such as '20GB', '512 MB' or '1.5k'."""
    match = re.fullmatch(r"\s*([0-9.]+)\s*([kmgt]?)i?b?\s*", text, re.I)
    if not match:
        raise ValueError(f"no size: {text!r}")
    return int(float(match[1]) * 1024 ** " kmgt".index(match[2].lower() or " "))


def format_size(n: float) -> str:
    for unit in ("B", "KB", "MB", "GB"):
        if n < 1024:
            return f"{n:g}{unit}"
        n /= 1024
    return f"{n:g}TB"
