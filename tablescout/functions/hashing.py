"""MinHash hash family as Spark column expressions.

Family: ``h_i(x) = (a_i * x + b_i) mod p`` with ``x = crc32(utf8(value))``.
``a_i * x`` needs up to 64 bits unsigned, which overflows ``bigint``
(and raises under ANSI mode), so ``a`` is split into 16-bit halves
and reduced modulo ``p`` in between; every intermediate stays below 2**50.
Because ``0 < a < p`` and ``x < p`` the map is injective on the crc
values, so the minimum of each hash function is attained by exactly
one crc.

The crc has 32 bits, so beyond some 10^8 distinct values its minima say ever
less. The wide family takes ``x`` as the first 60 bits of the value's md5 and
``p = 2**61 - 1``; products are taken in 31-bit halves, which that modulus
folds back (``2**61 = 1``), again in bigint alone. Equal keys then mean equal
values for all purposes, and one count per key serves the signature and the
distinct count.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the profiled toolkit's for the same hashes:
# the modulus is the prime just above 2**32, and crc32 is taken over the
# UTF-8 bytes of the value, as an unsigned 32-bit number.
PRIME = 4294967311
HASH_RANGE = 2**32
#: The wide family's: 60-bit keys, a Mersenne prime above them.
WIDE_PRIME = 2**61 - 1
DEFAULT_HASHNUM = 100
DEFAULT_SEED = 0

_HALF = 1 << 16
_WIDE_HALF = 1 << 31


@dataclass(frozen=True)
class HashCoefficients:
    """``hashnum`` pairs (a, b); a from 1, b from 0, below 2**32 (the wide family: below its prime), distinct within each list."""

    a: tuple[int, ...]
    b: tuple[int, ...]
    seed: int
    wide: bool = False

    @property
    def hashnum(self) -> int:
        return len(self.a)

    def rows(self) -> list[tuple[int, int, int]]:
        return [(i, a, b) for i, (a, b) in enumerate(zip(self.a, self.b))]


def hash_coefficients(hashnum: int = DEFAULT_HASHNUM, seed: int | None = DEFAULT_SEED, wide: bool = False) -> HashCoefficients:
    """Draw the hash family on the driver (``hashnum`` numbers, never data-sized)."""
    if not isinstance(hashnum, int) or hashnum < 1:
        raise ValueError(f"hashnum must be a positive integer, got {hashnum!r}")
    rng = random.Random(seed)
    below = WIDE_PRIME if wide else HASH_RANGE
    a = rng.sample(range(1, below), hashnum)
    b = rng.sample(range(0, below), hashnum)
    return HashCoefficients(tuple(a), tuple(b), -1 if seed is None else seed, wide)


def crc32_of(value: Column) -> Column:
    """Unsigned crc32 of the UTF-8 bytes, as bigint."""
    return F.crc32(value.cast("binary"))


def fingerprint_of(value: Column) -> Column:
    """64-bit xxhash of the value; with the crc it forms a 96-bit value key."""
    return F.xxhash64(value)


def wide_key(value: Column) -> Column:
    """The first 60 bits of the md5 of the UTF-8 bytes, as bigint."""
    return F.conv(F.substring(F.md5(value.cast("binary")), 1, 15), 16, 10).cast("bigint")


def base_key(value: Column, coeffs: HashCoefficients) -> Column:
    """What the family hashes."""
    return wide_key(value) if coeffs.wide else crc32_of(value)


def coefficient_array(coeffs: HashCoefficients) -> Column:
    """Literal array of ``struct(hash_index, a_hi, a_lo, b)`` for ``inline``.

    Built as one SQL expression: a single call to the JVM, not one per literal.
    """
    half = _WIDE_HALF if coeffs.wide else _HALF
    items = ", ".join(
        f"named_struct('hash_index', {i}, 'a_hi', {a // half}L, 'a_lo', {a % half}L, 'b', {b}L)"
        for i, a, b in coeffs.rows()
    )
    return F.expr(f"array({items})")


def universal_hash(x: Column, a_hi: Column, a_lo: Column, b: Column) -> Column:
    """``(a*x + b) mod p`` for ``a = a_hi*2**16 + a_lo``, exact in bigint."""
    p = F.lit(PRIME)
    return F.pmod(F.pmod(a_hi * x, p) * F.lit(_HALF) + a_lo * x + b, p)


def wide_hash(x: Column, a_hi: Column, a_lo: Column, b: Column) -> Column:
    """``(a*x + b) mod (2**61 - 1)`` for ``a = a_hi*2**31 + a_lo`` and 60-bit ``x``, exact in bigint."""
    p = F.lit(WIDE_PRIME)
    x_hi, x_lo = F.shiftright(x, 31), x.bitwiseAND(F.lit(_WIDE_HALF - 1))
    middle = a_hi * x_lo + a_lo * x_hi  # below 2**62; times 2**31, its part from 2**61 on folds back
    folded = F.shiftright(middle, 30) + F.shiftleft(middle.bitwiseAND(F.lit((1 << 30) - 1)), 31)
    # Four terms below p each add up below 2**63.
    return F.pmod(F.pmod(a_hi * x_hi * F.lit(2), p) + F.pmod(folded, p) + F.pmod(a_lo * x_lo, p) + b, p)


def family_hash(coeffs: HashCoefficients, x: Column, a_hi: Column, a_lo: Column, b: Column) -> Column:
    return (wide_hash if coeffs.wide else universal_hash)(x, a_hi, a_lo, b)
