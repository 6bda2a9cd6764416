"""Byte layout of written objects: one-entry zip archives and encrypted blocks."""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone
from zipfile import ZIP_DEFLATED, ZipInfo

# Record layouts of the public zip format, and the deflate level.
DEFLATE_LEVEL = 5
ZIP_DESCRIPTOR = b"PK\x07\x08"
ZIP_ENTRY = b"PK\x01\x02"
ZIP64_END = b"PK\x06\x06"
ZIP64_LOCATOR = b"PK\x06\x07"
ZIP_END = b"PK\x05\x06"
ZIP_VERSION, ZIP64_VERSION = 20, 45
ZIP_STREAMED_UTF8 = 0x0808
UINT32_MAX = 0xFFFFFFFF

# Start of an encrypted block.
BLOCK_MAGIC = b"FHB1"


def deflate(data: bytes, ends_stream: bool) -> bytes:
    """Raw deflate data of one chunk, alone readable and fit to be joined with its neighbours."""
    packer = zlib.compressobj(DEFLATE_LEVEL, zlib.DEFLATED, -zlib.MAX_WBITS)
    flush = zlib.Z_FINISH if ends_stream else zlib.Z_SYNC_FLUSH
    return packer.compress(data) + packer.flush(flush)


def inflate(data: bytes) -> bytes:
    """Inverse of :func:`deflate` for one chunk."""
    return zlib.decompressobj(-zlib.MAX_WBITS).decompress(data)


def inflate_pieces(pieces: Iterator[bytes], piece_bytes: int) -> Iterator[bytes]:
    """Inflate joined chunks, holding about ``piece_bytes`` at a time."""
    unpacker = zlib.decompressobj(-zlib.MAX_WBITS)
    for data in pieces:
        while data:
            plain = unpacker.decompress(data, piece_bytes)
            data = unpacker.unconsumed_tail
            if plain:
                yield plain
    rest = unpacker.flush()
    if rest:
        yield rest


def needs_zip64(file_size: int) -> bool:
    """Decided before the data is seen; half the limit leaves room for growth."""
    return file_size > UINT32_MAX // 2


def _zip_info(name: str, modified: datetime) -> ZipInfo:
    modified = modified.astimezone(timezone.utc)
    year = min(max(modified.year, 1980), 2107)
    info = ZipInfo(name, (year, *modified.timetuple()[1:6]))
    info.compress_type = ZIP_DEFLATED
    info.flag_bits = ZIP_STREAMED_UTF8
    return info


def zip_head(name: str, modified: datetime, zip64: bool) -> bytes:
    """Everything in front of the deflate data."""
    return _zip_info(name, modified).FileHeader(zip64=zip64)


def zip_tail(
    name: str, modified: datetime, zip64: bool, crc: int, packed: int, plain: int
) -> bytes:
    """Everything behind the deflate data: sizes, directory and end records."""
    if not zip64 and max(packed, plain) >= UINT32_MAX:
        raise ValueError(f"{name} grew past 4 GiB while it was read")
    info = _zip_info(name, modified)
    year, month, day, hour, minute, second = info.date_time
    date = (year - 1980) << 9 | month << 5 | day
    time = hour << 11 | minute << 5 | second // 2
    encoded = name.encode("utf-8")
    head = len(zip_head(name, modified, zip64))
    version = ZIP64_VERSION if zip64 else ZIP_VERSION
    extra = struct.pack("<HHQQ", 1, 16, plain, packed) if zip64 else b""
    sizes = (UINT32_MAX, UINT32_MAX) if zip64 else (packed, plain)
    descriptor = ZIP_DESCRIPTOR + struct.pack("<LQQ" if zip64 else "<LLL", crc, packed, plain)
    entry = ZIP_ENTRY + struct.pack(
        "<HHHHHHLLLHHHHHLL",
        version, version, ZIP_STREAMED_UTF8, ZIP_DEFLATED, time, date, crc, *sizes,
        len(encoded), len(extra), 0, 0, 0, 0, 0,
    ) + encoded + extra
    start = head + packed + len(descriptor)
    end = b""
    if zip64:
        end = ZIP64_END + struct.pack(
            "<QHHLLQQQQ", 44, version, version, 0, 0, 1, 1, len(entry), start
        )
        end += ZIP64_LOCATOR + struct.pack("<LQL", 0, start + len(entry), 1)
    end += ZIP_END + struct.pack(
        "<HHHHLLH", 0, 0, 1, 1, len(entry), UINT32_MAX if zip64 else start, 0
    )
    return descriptor + entry + end


def joined_crc(first: int, second: int, second_length: int) -> int:
    """CRC-32 of two joined byte strings from the CRCs of both.

    Appending zero bytes multiplies a CRC by a power of x in GF(2)[x] modulo the
    CRC polynomial (bits reversed), found by repeated squaring.
    """

    def times(a: int, b: int) -> int:
        product = 0
        for bit in range(31, -1, -1):
            if a >> bit & 1:
                product ^= b
            b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
        return product

    power, factor, exponent = 1 << 31, 1 << 30, 8 * second_length
    while exponent:
        if exponent & 1:
            power = times(power, factor)
        factor = times(factor, factor)
        exponent >>= 1
    return times(power, first) ^ second


def block_head(header: dict) -> bytes:
    """Start of an encrypted block: magic, length and a JSON header."""
    encoded = json.dumps(header, sort_keys=True).encode("utf-8")
    return BLOCK_MAGIC + struct.pack(">L", len(encoded)) + encoded


def frame(data: bytes) -> bytes:
    return struct.pack(">L", len(data))


# A frame of no bytes ends a block; real frames hold a nonce and a tag at least.
BLOCK_END = struct.pack(">L", 0)


def read_block_head(read) -> dict:
    """Header of the block that starts at the reader's position."""
    if read(4) != BLOCK_MAGIC:
        raise ValueError("no encrypted block")
    return json.loads(_exactly(read, _number(read)))


def read_frames(read) -> Iterator[bytes]:
    """Frames behind a header; an error when the block has no end."""
    while length := _number(read):
        yield _exactly(read, length)


def _number(read) -> int:
    return struct.unpack(">L", _exactly(read, 4))[0]


def _exactly(read, length: int) -> bytes:
    data = read(length)
    if len(data) != length:
        raise ValueError("the encrypted block is cut")
    return data
