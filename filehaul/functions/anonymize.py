"""Irreversible replacement of column values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METHODS = ("token", "mask")
# Fixed values of HMAC: block length of SHA-256, inner and outer pad.
_BLOCK, _INNER, _OUTER = 64, 0x36, 0x5C


def _padded(key: Column, value: int) -> Column:
    """Key of text, filled up with zeros to a block, with every byte changed by the pad."""
    plain = F.encode(key, "utf-8")
    short = F.when(F.octet_length(plain) > _BLOCK, F.unhex(F.sha2(plain, 256))).otherwise(plain)
    digits = F.rpad(F.hex(short), 2 * _BLOCK, "0")
    place = F.sequence(F.lit(1), F.lit(2 * _BLOCK - 1), F.lit(2))
    byte = lambda i: F.conv(F.substring(digits, i, F.lit(2)), 16, 10).cast("int").bitwiseXOR(F.lit(value))
    return F.unhex(F.array_join(F.transform(place, lambda i: F.lpad(F.hex(byte(i)), 2, "0")), ""))


def hmac_sha256(key: DataFrame, text: Column) -> Column:
    """HMAC with SHA-256 in hexadecimal digits; ``key`` is a table of one row and one column of text."""
    name = F.col(key.columns[0])
    inner_key, outer_key = (key.select(_padded(name, pad)).scalar() for pad in (_INNER, _OUTER))
    inner = F.unhex(F.sha2(F.concat(inner_key, F.encode(text, "utf-8")), 256))
    return F.sha2(F.concat(outer_key, inner), 256)


def anonymize(table: DataFrame, spec: dict[str, str], key: DataFrame | str | None = None) -> DataFrame:
    """Replace columns by 'token' (HMAC-SHA-256, joins still work) or 'mask' (X, x and n).

    ``key`` is text, or a table of one row and one column that holds it. It is
    read as a scalar subquery, so it shows up in no plan.
    """
    for name, method in spec.items():
        if name not in table.columns or method not in METHODS:
            raise ValueError(f"unknown column or method: {name!r}, {method!r}")
    if "token" in spec.values() and not key:
        raise ValueError("tokens need a key")
    if isinstance(key, str):
        key = table.sparkSession.createDataFrame([(key,)], "key string")
    changed = {}
    for name, method in spec.items():
        text = F.col(name).cast("string")
        changed[name] = F.mask(text) if method == "mask" else hmac_sha256(key, text)
    return table.withColumns(changed)
