"""Bucket keys: integers whose bucket is known beforehand.

Spark puts a row of a table with ``n`` buckets into bucket ``hash(column) mod n``. Range numbers
used as they are would collide: of ``n`` ranges in ``n`` buckets a third of the buckets stay
empty and others hold several. The hash of one integer (Murmur3, seed 42) can be undone, so
the key of range ``i`` is the integer whose hash is ``i``: it has bucket ``i mod n`` to itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_WORD = 0xFFFFFFFF
# Fixed values of Murmur3 (32 bits) and of Spark's use of it.
_SEED, _LENGTH = 42, 4
_C1, _C2, _ADD = 0xCC9E2D51, 0x1B873593, 0xE6546B64
_FINAL1, _FINAL2 = 0x85EBCA6B, 0xC2B2AE35


def _let(x: Column, then: Callable[[Column], Column]) -> Column:
    """``then(x)`` with ``x`` worked out once, however often it is named."""
    return F.get(F.transform(F.array(x), then), F.lit(0))


def _over(x: Column, c: int) -> Column:
    """The number whose product with ``c`` is ``x`` mod 2^32; in two halves, so that no product leaves 64 bits."""
    c = pow(c, -1, 1 << 32)

    def product(y: Column) -> Column:
        high = F.shiftleft((F.shiftright(y, 16) * F.lit(c)).bitwiseAND(F.lit(0xFFFF)), 16)
        return (y.bitwiseAND(F.lit(0xFFFF)) * F.lit(c) + high).bitwiseAND(F.lit(_WORD))

    return _let(x, product)


def _rotated_back(x: Column, bits: int) -> Column:
    return _let(x, lambda y: F.shiftright(y, bits).bitwiseOR(F.shiftleft(y.bitwiseAND(F.lit((1 << bits) - 1)), 32 - bits)))


def bucket_key(i: Column) -> Column:
    """The int whose bucket among any number ``n`` of buckets is ``i mod n`` (0 <= i < 2^31)."""
    x = _let(i.cast("long"), lambda y: y.bitwiseXOR(F.shiftright(y, 16)))
    x = _let(_over(x, _FINAL2), lambda y: y.bitwiseXOR(F.shiftright(y, 13)).bitwiseXOR(F.shiftright(y, 26)))
    x = _let(_over(x, _FINAL1), lambda y: y.bitwiseXOR(F.shiftright(y, 16)).bitwiseXOR(F.lit(_LENGTH)))
    x = _over((x + F.lit((1 << 32) - _ADD)).bitwiseAND(F.lit(_WORD)), 5)
    x = _rotated_back(x, 13).bitwiseXOR(F.lit(_SEED))
    x = _over(_rotated_back(_over(x, _C2), 15), _C1)
    return _let(x, lambda y: F.when(y > F.lit(0x7FFFFFFF), y - F.lit(1 << 32)).otherwise(y)).cast("int")


def bucket_table(spark: SparkSession, n: int, number: str, key: str) -> DataFrame:
    """The keys of the ranges 0 to n - 1, as a table of ``n`` rows."""
    return spark.range(0, n, 1, 1).select(F.col("id").alias(number), bucket_key(F.col("id")).alias(key))
