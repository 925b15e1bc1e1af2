"""Reproducible draws: every random number is a hash of a seed, a tag and the row's key.

They do not depend on partitioning or task retries, and another engine with MD5 gives
the same numbers. Give each draw its own tag to keep draws independent. A draw has 60 bits, so
that every row of a pool of any real size can be drawn, and almost equally often.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO60 = 1 << 60
_LOW31 = 2_147_483_647
_LOW30 = (1 << 30) - 1
_WIDE = "decimal(19,0)"


def _written(key: Column) -> Column:
    """The key with its length in front, so that no two lists of keys are written alike."""
    text = key.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("N"))


def hash_u60(seed: int, tag: str, *keys: Column) -> Column:
    """Uniform BIGINT in [0, 2^60): the first fifteen hex digits of an MD5; NULL keys are marked."""
    text = F.concat(F.lit(f"{seed}:{len(tag)}:{tag}"), *[_written(k) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def _scale_short(u: Column, size: Column) -> Column:
    """For sizes below 2^31, in two limbs of 30 bits."""
    upper = F.shiftright(u, 30) * size
    lower = F.shiftright(u.bitwiseAND(F.lit(_LOW30)) * size, 30)
    return F.shiftright(upper + lower, 30)


def scale_u60(u: Column, size: Column | int) -> Column:
    """``floor(u * size / 2^60)`` without overflow for any BIGINT ``size``."""
    if isinstance(size, int) and size <= _LOW31:
        return _scale_short(u, F.lit(size).cast("bigint"))
    size = (F.lit(size) if isinstance(size, int) else size).cast("bigint")
    wide = F.call_function("div", u.cast(_WIDE) * size.cast(_WIDE), F.lit(TWO60).cast(_WIDE)).cast("bigint")
    return F.when(size <= _LOW31, _scale_short(u, size)).otherwise(wide)


def uniform_int(u: Column, low: int, high: int) -> Column:
    """Integer in the closed range ``[low, high]``."""
    return F.lit(low) + scale_u60(u, high - low + 1)


def bernoulli(u: Column, p: float) -> Column:
    return u < F.lit(int(p * TWO60))


def coin(u: Column, heads: str, tails: str) -> Column:
    return F.when(u % 2 == 0, F.lit(heads)).otherwise(F.lit(tails))
