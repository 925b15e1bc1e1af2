from mirrorset.functions.codes import area_of, canonical_code, clean_text, prefixed
from mirrorset.functions.dates import (
    add_days,
    add_months_overflow,
    months_between_trunc,
    parse_yyyymmdd,
    subtract_years,
)
from mirrorset.functions.draws import bernoulli, coin, hash_u60, scale_u60, uniform_int

__all__ = [
    "add_days",
    "add_months_overflow",
    "area_of",
    "bernoulli",
    "canonical_code",
    "clean_text",
    "coin",
    "hash_u60",
    "months_between_trunc",
    "parse_yyyymmdd",
    "prefixed",
    "scale_u60",
    "subtract_years",
    "uniform_int",
]
