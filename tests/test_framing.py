import io
import random
import zipfile
import zlib
from datetime import datetime, timezone

import pytest

from filehaul.functions import framing
from filehaul.sources.chunks import with_last

WHEN = datetime(2024, 2, 29, 12, 34, 56, tzinfo=timezone.utc)


@pytest.mark.parametrize("zip64", [False, True])
@pytest.mark.parametrize("name", ["plain.txt", "größe.txt"])
def test_zip_layout_is_readable(zip64, name):
    chunks = [random.Random(1).randbytes(5000), b"", b"text " * 5000]
    packed = b"".join(
        framing.deflate(chunk, place == len(chunks) - 1) for place, chunk in enumerate(chunks)
    )
    plain = b"".join(chunks)
    archive = (
        framing.zip_head(name, WHEN, zip64)
        + packed
        + framing.zip_tail(name, WHEN, zip64, zlib.crc32(plain), len(packed), len(plain))
    )
    with zipfile.ZipFile(io.BytesIO(archive)) as opened:
        assert opened.testzip() is None
        assert opened.namelist() == [name]
        assert opened.read(name) == plain
        assert opened.infolist()[0].date_time == (2024, 2, 29, 12, 34, 56)


def test_zip_size_is_checked():
    with pytest.raises(ValueError):
        framing.zip_tail("x", WHEN, False, 0, 1, 1 << 32)


@pytest.mark.parametrize("seed", range(20))
def test_joined_crc(seed):
    source = random.Random(seed)
    first, second = (source.randbytes(source.randrange(200)) for _ in range(2))
    joined = framing.joined_crc(zlib.crc32(first), zlib.crc32(second), len(second))
    assert joined == zlib.crc32(first + second)


def test_inflate_in_pieces():
    chunks = [b"a" * 100_000, b"b" * 100_000]
    packed = b"".join(framing.deflate(chunk, place == 1) for place, chunk in enumerate(chunks))
    pieces = [packed[start : start + 7] for start in range(0, len(packed), 7)]
    out = list(framing.inflate_pieces(iter(pieces), 1000))
    assert b"".join(out) == b"".join(chunks)
    assert max(map(len, out)) <= 1000


def test_block_frames():
    block = framing.block_head({"a": 1})
    for data in (b"one", b"three"):
        block += framing.frame(data) + data
    source = io.BytesIO(block + framing.BLOCK_END + b"behind")
    assert framing.read_block_head(source.read) == {"a": 1}
    assert list(framing.read_frames(source.read)) == [b"one", b"three"]
    with pytest.raises(ValueError):
        list(framing.read_frames(io.BytesIO(framing.frame(b"xyz") + b"x").read))
    with pytest.raises(ValueError):
        framing.read_block_head(io.BytesIO(b"PK..").read)


def test_last_flag():
    assert list(with_last(iter([]))) == [(b"", True)]
    assert list(with_last(iter([b"a", b"b"]))) == [(b"a", False), (b"b", True)]
