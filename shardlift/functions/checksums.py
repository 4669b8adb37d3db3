"""CRC-32 of a whole from the CRC-32 of its pieces.

The checksum of two pieces is that of the first, moved on by the length of the second, exclusive-or that of the
second. Moving on by a byte is multiplication by x^8 over GF(2) modulo the checksum's polynomial. So each piece can
be moved on by all that comes after it, wherever it is read, and the whole is the exclusive-or of all, in any order.
"""

from __future__ import annotations

from functools import lru_cache

# Fixed value: the polynomial, its lowest power in the highest bit.
POLYNOMIAL = 0xEDB88320
_ONE = 1 << 31
_BYTE = 1 << 23


def product(a: int, b: int) -> int:
    """Two polynomials multiplied, modulo the checksum's."""
    result = 0
    while a:
        # The highest bit of `a` is its lowest power.
        if a & _ONE:
            result ^= b
        a = (a << 1) & 0xFFFFFFFF
        b = (b >> 1) ^ (POLYNOMIAL if b & 1 else 0)
    return result


@lru_cache(maxsize=1024)
def power_of_byte(n: int) -> int:
    """x^(8 n)."""
    result, square = _ONE, _BYTE
    while n:
        if n & 1:
            result = product(result, square)
        square = product(square, square)
        n >>= 1
    return result


def moved_on(crc: int, n_bytes: int) -> int:
    """The share of a piece with this checksum in that of a whole which goes on for so many bytes."""
    return product(power_of_byte(n_bytes), crc)
