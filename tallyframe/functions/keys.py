"""Repeatable pseudo-random numbers derived from a row key.

Splits, folds and samples must not change when a lost partition is recomputed,
so they are functions of the key instead of calls to a random generator.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOW = 1 << 31
RANGE = 1 << 32
HIGH_FACTOR = 40503
# An odd factor of 27 bits: products of 32-bit numbers with it stay within a bigint.
MIX_FACTOR = 0x45D9F3B
MISSING_KEY = -1


def _seed_bits(seed: int) -> int:
    x = seed % RANGE
    for _ in range(2):
        x = ((x ^ x >> 16) * MIX_FACTOR + 1) % RANGE
    return x


def key_hash(key: Column, seed: int = 0) -> Column:
    """Evenly spread value in [0, 2^32) for a bigint key; a missing key counts as one more key.

    The seed is mixed in before two multiply-and-shift rounds, so draws with different seeds are
    independent of each other. Both rounds are one-to-one on 32 bits.
    """
    k = F.coalesce(key.cast("bigint"), F.lit(MISSING_KEY).cast("bigint"))
    low, high = F.pmod(k, F.lit(LOW).cast("bigint")), F.shiftright(k, 31)
    x = low.bitwiseXOR(F.pmod(high * HIGH_FACTOR + F.lit(_seed_bits(seed)).cast("bigint"), F.lit(RANGE).cast("bigint")))
    for _ in range(2):
        x = (x.bitwiseXOR(F.shiftright(x, 16)) * F.lit(MIX_FACTOR).cast("bigint")).bitwiseAND(F.lit(RANGE - 1).cast("bigint"))
    return x.bitwiseXOR(F.shiftright(x, 16))


def key_order(key: Column, seed: int = 0) -> Column:
    """Like :func:`key_hash`, widened to [0, 2^63) so that no two keys tie.

    Keys with equal high bits have different hashes; keys with equal hash differ in the low bits
    appended here.
    """
    low = F.pmod(F.coalesce(key.cast("bigint"), F.lit(MISSING_KEY).cast("bigint")), F.lit(LOW).cast("bigint"))
    return key_hash(key, seed) * F.lit(LOW).cast("bigint") + low


def key_hash_sql(key: str, seed: int = 0) -> str:
    """The same hash in SQL text, for keys of at least 0."""
    x = f"xor(({key}) % {LOW}, (({key}) // {LOW} * {HIGH_FACTOR} + {_seed_bits(seed)}) % {RANGE})"
    for _ in range(2):
        x = f"((xor({x}, {x} >> 16) * {MIX_FACTOR}) & {RANGE - 1})"
    return f"xor({x}, {x} >> 16)"
