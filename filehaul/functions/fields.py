"""Compression of single fields of a table."""

from __future__ import annotations

import gzip
import io
import zipfile
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Compressor names, and the name of the entry in a zipped field.
COMPRESSORS = ("SNAPPY", "ZIP", "GZIP")
ZIP_ENTRY_NAME = "data"


def parse_spec(spec: str, columns: list[str]) -> dict[str, str]:
    """Fields and their compressors from a text such as ``text:GZIP,role:SNAPPY``."""
    fields: dict[str, str] = {}
    for item in spec.split(","):
        name, separator, compressor = item.strip().partition(":")
        if not separator or compressor not in COMPRESSORS:
            raise ValueError(f"not <field>:<compressor> with one of {COMPRESSORS}: {item!r}")
        if name not in columns or name in fields:
            raise ValueError(f"unknown or repeated field {name!r}")
        fields[name] = compressor
    return fields


def compress_fields(table: DataFrame, spec: str) -> DataFrame:
    """Compress the named fields; they keep their names and become binary. NULL stays NULL."""
    fields = parse_spec(spec, table.columns)
    return table.withColumns(
        {name: _packer(how)(F.col(name).cast("binary")) for name, how in fields.items()}
    )


def decompress_fields(table: DataFrame, spec: str, text: bool = True) -> DataFrame:
    """Inverse of :func:`compress_fields`; gives text, or binary with ``text=False``."""
    fields = parse_spec(spec, table.columns)
    kind = "string" if text else "binary"
    return table.withColumns(
        {name: _unpacker(how)(F.col(name)).cast(kind) for name, how in fields.items()}
    )


def _packer(compressor: str) -> Callable[[Column], Column]:
    pack = {"SNAPPY": _snappy, "ZIP": _zip, "GZIP": _gzip}[compressor]
    return F.arrow_udf(lambda values: _each(values, pack), "binary")


def _unpacker(compressor: str) -> Callable[[Column], Column]:
    unpack = {"SNAPPY": _unsnappy, "ZIP": _unzip, "GZIP": gzip.decompress}[compressor]
    return F.arrow_udf(lambda values: _each(values, unpack), "binary")


def _each(values: pa.Array, change: Callable[[bytes], bytes]) -> pa.Array:
    return pa.array(
        [None if value is None else change(value) for value in values.to_pylist()], pa.binary()
    )


def _gzip(value: bytes) -> bytes:
    return gzip.compress(value, mtime=0)


def _zip(value: bytes) -> bytes:
    target = io.BytesIO()
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr(zipfile.ZipInfo(ZIP_ENTRY_NAME), value, zipfile.ZIP_DEFLATED)
    return target.getvalue()


def _unzip(value: bytes) -> bytes:
    with zipfile.ZipFile(io.BytesIO(value)) as archive:
        return archive.read(ZIP_ENTRY_NAME)


def _snappy(value: bytes) -> bytes:
    return pa.compress(value, codec="snappy", asbytes=True)


def _unsnappy(value: bytes) -> bytes:
    # Snappy data starts with its plain length, seven bits per byte, low bits first.
    length = shift = 0
    for byte in value:
        length |= (byte & 0x7F) << shift
        shift += 7
        if byte < 0x80:
            break
    return pa.decompress(value, length, codec="snappy", asbytes=True)
