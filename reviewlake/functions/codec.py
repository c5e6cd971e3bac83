"""Typed cell codec (P1): big-endian binary cells decoded with native expressions.

``int`` ('!i', 4 bytes, two's complement), ``long`` ('!q', 8 bytes), ``float`` ('!f', IEEE-754
binary32, rebuilt from sign / exponent / mantissa bits), ``bool`` ('!?'), ``string`` (UTF-8).
A missing cell stays NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _unsigned(c: Column) -> Column:
    return F.conv(F.hex(c), 16, 10).cast("decimal(20,0)")


def decode_int(c) -> Column:
    u = _unsigned(_c(c))
    return F.when(u >= _dec(2 ** 31), u - _dec(2 ** 32)).otherwise(u).cast("int")


def _dec(v: int) -> Column:
    return F.lit(str(v)).cast("decimal(20,0)")


def decode_long(c) -> Column:
    u = _unsigned(_c(c))
    return F.when(u >= _dec(2 ** 63), u - _dec(2 ** 64)).otherwise(u).cast("long")


def decode_float(c) -> Column:
    bits = _unsigned(_c(c)).cast("long")
    sign = F.when(F.shiftright(bits, 31) == 1, F.lit(-1.0)).otherwise(F.lit(1.0))
    exp = F.shiftright(bits, 23).bitwiseAND(0xFF)
    mant = bits.bitwiseAND(0x7FFFFF).cast("double")
    normal = sign * (1.0 + mant / float(1 << 23)) * F.pow(F.lit(2.0), exp.cast("double") - 127.0)
    sub = sign * (mant / float(1 << 23)) * F.pow(F.lit(2.0), F.lit(-126.0))
    special = F.when(mant == 0, sign * F.lit(float("inf"))).otherwise(F.lit(float("nan")))
    return F.when(exp == 0, sub).when(exp == 255, special).otherwise(normal)


def decode_bool(c) -> Column:
    return _unsigned(_c(c)) != 0


def decode_string(c) -> Column:
    return F.decode(_c(c), "UTF-8")


DECODERS = {"int": decode_int, "long": decode_long, "float": decode_float, "bool": decode_bool,
            "string": decode_string}


def decode_cells(df, spec: dict[str, str]):
    """Decode the binary columns named in ``spec`` (column -> type)."""
    return df.select(*[DECODERS[t](c).alias(c) if c in spec else F.col(c)
                       for c in df.columns for t in [spec.get(c, "")]])


def encode_int(c) -> Column:
    """Inverse of ``decode_int`` (for fixtures): 4-byte big-endian two's complement."""
    v = _c(c).cast("long")
    u = F.when(v < 0, v + F.lit(2 ** 32)).otherwise(v)
    return F.unhex(F.lpad(F.hex(u), 8, "0"))
