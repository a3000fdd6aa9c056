"""Functions over vectors kept as arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def l2_normalize(a: Column) -> Column:
    """Unit length; an all-zero vector stays."""
    n = norm(a)
    return F.transform(a, lambda x: x.cast("double") / F.when(n == 0, F.lit(1.0)).otherwise(n))


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def quantize(a: Column, scale: Column) -> Column:
    """Steps of ``scale``, rounded half to even, within -127 to 127."""
    return F.transform(a, lambda x: F.greatest(F.lit(-127), F.least(F.lit(127), F.rint(x.cast("double") / scale).cast("int"))))


def decode_bytes(column: Column) -> Column:
    """Signed bytes of a base64 string; null if it is null, empty or no base64."""
    digits = F.hex(F.try_to_binary(F.nullif(column, F.lit("")), F.lit("base64")))
    values = F.transform(F.regexp_extract_all(F.nullif(digits, F.lit("")), F.lit("(..)"), F.lit(1)), lambda x: F.conv(x, 16, 10).cast("int"))
    return F.transform(values, lambda x: F.when(x > 127, x - 256).otherwise(x))


def encode_bytes(column: Column) -> Column:
    """Base64 of an array of signed bytes."""
    raw = F.unhex(F.array_join(F.transform(column, lambda x: F.lpad(F.hex(x.bitwiseAND(F.lit(255))), 2, "0")), ""))
    return F.regexp_replace(F.base64(raw), r"\s", "")
