"""The bitmap position hash used for distinct counting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The bitmap has 2^30 bits and the polynomial has base 61.
BITMAP_BITS = 1 << 30
HASH_BASE = 61


def bitmap_offset(value: Column, base: int = HASH_BASE, bits: int = BITMAP_BITS) -> Column:
    """Polynomial hash over the characters of the decimal text, cut to the bitmap size."""
    codes = F.transform(F.split(value.cast("string"), ""), F.ascii)
    return F.aggregate(
        codes,
        F.lit(0).cast("long"),
        lambda acc, code: (acc * F.lit(base) + code).bitwiseAND(F.lit(bits - 1)),
    )
