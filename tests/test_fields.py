import gzip
import hmac
import io
import zipfile

import pytest

from filehaul.functions.anonymize import anonymize
from filehaul.functions.fields import compress_fields, decompress_fields, parse_spec

ROWS = [(1, "text", "größe"), (2, "", None), (3, None, "x" * 100_000)]
SCHEMA = "id int, a string, b string"


@pytest.mark.parametrize("spec", ["a:SNAPPY", "a:ZIP,b:GZIP", "a:GZIP,b:SNAPPY", "b:ZIP"])
def test_roundtrip(spark, spec):
    table = spark.createDataFrame(ROWS, SCHEMA)
    packed = compress_fields(table, spec)
    assert {packed.schema[name].dataType.simpleString() for name in parse_spec(spec, ["a", "b"])} == {
        "binary"}
    assert sorted(map(tuple, decompress_fields(packed, spec).collect())) == ROWS


def test_formats_are_standard(spark):
    row = compress_fields(spark.createDataFrame(ROWS[:1], SCHEMA), "a:GZIP,b:ZIP").first()
    assert gzip.decompress(bytes(row["a"])) == b"text"
    with zipfile.ZipFile(io.BytesIO(bytes(row["b"]))) as archive:
        assert archive.read(archive.namelist()[0]).decode() == "größe"


@pytest.mark.parametrize("spec", ["", "a", "a:LZ4", "z:ZIP", "a:ZIP,a:GZIP"])
def test_bad_specs(spec):
    with pytest.raises(ValueError):
        parse_spec(spec, ["a", "b"])


def test_anonymize(spark):
    table = spark.createDataFrame([("Tom-12", "Tom", 7), (None, None, None)], "a string, b string, c int")
    rows = anonymize(table, {"a": "mask", "b": "token", "c": "token"}, "key").collect()
    assert tuple(rows[0]) == (
        "Xxx-nn", hmac.new(b"key", b"Tom", "sha256").hexdigest(), hmac.new(b"key", b"7", "sha256").hexdigest())
    assert tuple(rows[1]) == (None, None, None)
    key_table = spark.createDataFrame([("key",)], "key string")
    assert anonymize(table, {"b": "token"}, key_table).collect()[0]["b"] == rows[0]["b"]


def test_key_is_in_no_plan(spark):
    table = spark.createDataFrame([("a",)], "a string")
    plan = anonymize(table, {"a": "token"}, "very secret")._jdf.queryExecution().toString()
    assert "very secret" not in plan


@pytest.mark.parametrize("spec, key", [({"z": "mask"}, None), ({"a": "rot13"}, None), ({"a": "token"}, None)])
def test_bad_anonymize_options(spark, spec, key):
    with pytest.raises(ValueError):
        anonymize(spark.createDataFrame([("a",)], "a string"), spec, key)
