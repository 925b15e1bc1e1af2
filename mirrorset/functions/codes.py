"""Codes and text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_text(value: Column) -> Column:
    return F.trim(value.cast("string"))


def canonical_code(value: Column, width: int = 2) -> Column:
    """Trimmed code without a ``.0`` tail, digits padded with zeros to ``width``.

    Codes with letters, and digits that are wide enough, stay as they are.
    """
    code = F.regexp_replace(clean_text(value), r"\.0$", "")
    short_number = code.rlike("^[0-9]+$") & (F.length(code) < width)
    return F.when(short_number, F.lpad(code, width, "0")).otherwise(code)


def area_of(postcode: Column, size: int = 100) -> Column:
    """Lower end of the block of ``size`` codes that holds the postal code."""
    return (F.floor(postcode / F.lit(size)) * F.lit(size)).cast("int")


def prefixed(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), value)
