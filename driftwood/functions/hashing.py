"""Hash expressions.

``md5_mod(s, m)`` is the value of the 128-bit big-endian MD5 digest of ``s`` taken
modulo ``m``.  ``conv`` of the full 32-hex digest overflows, so the digest is read as
four 32-bit limbs and reduced with Horner's rule, ``r = (r * 2^32 + limb) mod m``.
With ``m < 2^31`` every intermediate fits a signed bigint.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _limb(hexdigest: Column, i: int) -> Column:
    return F.conv(F.substring(hexdigest, 8 * i + 1, 8), 16, 10).cast("bigint")


def md5_mod(s: Column, m: int) -> Column:
    """Inline form; when the digest is reused, project ``F.md5`` first and call ``hex_mod``."""
    return hex_mod(F.md5(s), m)


def hex_mod(h: Column, m: int) -> Column:
    """A 32-hex-digit digest column, as a big-endian integer, modulo ``m``."""
    if not 0 < m < 2 ** 31:
        raise ValueError("modulus must be in (0, 2^31)")
    r = F.lit(0).cast("bigint")
    for i in range(4):
        r = F.pmod(r * F.lit(2 ** 32) + _limb(h, i), F.lit(m))
    return r.cast("int")


def md5_u32(s: Column) -> Column:
    """First 32 bits of the MD5 digest as a non-negative bigint (a stable word hash)."""
    return _limb(F.md5(s), 0)
