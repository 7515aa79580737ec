"""A 64-to-32-bit integer hash in built-in bit operations, for samples by range of it.

The mixing steps are Thomas Wang's published 64-bit to 32-bit hash with rotations. Sums wrap at 64 bits,
which ANSI arithmetic on BIGINT rejects, so a number is held as two halves of 32 bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MASK = (1 << 32) - 1


def _halves(hi: Column, lo: Column) -> tuple[Column, Column]:
    """Halves below 2^32 from sums that may exceed it (carry into the upper half, dropped above)."""
    return (hi + F.shiftright(lo, 32)).bitwiseAND(_MASK), lo.bitwiseAND(_MASK)


def _left(hi: Column, lo: Column, k: int) -> tuple[Column, Column]:
    """Shifted left by k < 32 bits, halves not yet cut."""
    return (F.shiftleft(hi, k) + F.shiftright(lo, 32 - k)).bitwiseAND(_MASK), F.shiftleft(lo, k).bitwiseAND(_MASK)


def _rotated_right(hi: Column, lo: Column, k: int) -> tuple[Column, Column]:
    """Rotated right by k < 32 bits."""
    def side(high: Column, low: Column) -> Column:
        return F.shiftright(low, k).bitwiseOR(F.shiftleft(high, 32 - k).bitwiseAND(_MASK))
    return side(lo, hi), side(hi, lo)


def with_int_hash32(df: DataFrame, source: str, out: str) -> DataFrame:
    """``df`` with the hash (0 .. 2^32 - 1) of a BIGINT column, read as unsigned 64 bits.

    The steps map a list of one pair of halves, so that each step reads the one before it as a variable: written
    into each other (as a filter on the hash would write them), they would double with every step.
    """
    def step(pairs: Column, made) -> Column:
        return F.transform(pairs, lambda p: F.struct(
            *[c.alias(n) for c, n in zip(made(p["hi"], p["lo"]), ("hi", "lo"))]))

    def inverted(hi: Column, lo: Column) -> tuple[Column, Column]:      # ~key + (key << 18)
        h, l = _left(hi, lo, 18)
        return _halves(hi.bitwiseXOR(F.lit(_MASK)) + h, lo.bitwiseXOR(F.lit(_MASK)) + l)

    def mixed(k: int):                                                  # key ^ (key rotated right by k)
        def made(hi: Column, lo: Column) -> tuple[Column, Column]:
            h, l = _rotated_right(hi, lo, k)
            return hi.bitwiseXOR(h), lo.bitwiseXOR(l)
        return made

    def shifted(hi: Column, lo: Column) -> tuple[Column, Column]:       # key += key << 6
        h, l = _left(hi, lo, 6)
        return _halves(hi + h, lo + l)

    key = F.col(source).cast("long")
    pairs = F.array(F.struct(F.shiftrightunsigned(key, 32).alias("hi"), key.bitwiseAND(_MASK).alias("lo")))
    for made in (inverted, mixed(31), lambda hi, lo: _halves(hi * 21, lo * 21), mixed(11), shifted, mixed(22)):
        pairs = step(pairs, made)
    return df.withColumn(out, F.get(pairs, F.lit(0))["lo"])


def int_hash32(key: int) -> int:
    """The same for one number."""
    full = (1 << 64) - 1

    def right(x: int, k: int) -> int:
        return (x >> k | x << (64 - k)) & full

    key &= full
    key = (~key + (key << 18)) & full
    key ^= right(key, 31)
    key = key * 21 & full
    key ^= right(key, 11)
    key = (key + (key << 6)) & full
    return (key ^ right(key, 22)) & _MASK
