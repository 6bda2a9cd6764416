"""Column expressions for paths, object names and content types.

All of them are built-in Spark expressions, so they stay inside whole-stage
code generation. Paths are matched with regular expressions and not with
``parse_url``, which rejects paths that hold a space.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import PySparkException
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Content types, name endings and the bucket pattern.
CONTENT_TYPE_PLAIN = "application/octet-stream"
CONTENT_TYPE_ZIP = "application/zip"
CONTENT_TYPE_ENCRYPTED = "application/pgp-encrypted"
ZIP_ENDING = ".zip"
PGP_ENDING = ".pgp"
BUCKET_PATTERN = r"\A[a-zA-Z0-9-_.]+\z"

_URI_PARTS = r"(?s)^(?:([a-zA-Z][a-zA-Z0-9+.\-]*):)?(?://([^/]*))?(.*)$"
# A host is a name of letters, digits, dots and dashes, or a bracketed IPv6
# address; user and port around it are dropped. Anything else is no host.
_HOST = r"^(?:[^@]*@)?([A-Za-z0-9.\-]+|\[[0-9A-Fa-f:.]+\])(?::[0-9]*)?\z"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _text(value: Column | str) -> Column:
    return F.lit(value) if isinstance(value, str) else value


def full_path(uri: Column | str) -> Column:
    """Path part of a file URI: no scheme, no host, single slashes."""
    path = F.regexp_replace(F.regexp_extract(_column(uri), _URI_PARTS, 3), "/{2,}", "/")
    return F.regexp_replace(path, r"(?s)(?<=.)/\z", "")


def file_name(path: Column | str) -> Column:
    """Last component of a path; empty for the root directory."""
    return F.substring_index(_column(path), "/", -1)


def host_uri(uri: Column | str) -> Column:
    """``scheme://host/`` of a file URI, without user or port; ``file:/`` for local files."""
    scheme = F.regexp_extract(_column(uri), _URI_PARTS, 1)
    host = F.regexp_extract(F.regexp_extract(_column(uri), _URI_PARTS, 2), _HOST, 1)
    return F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(F.lit("")),
        F.when(host != "", F.concat(F.lit("//"), host)).otherwise(F.lit("")),
        F.lit("/"),
    )


def has_root(path: Column | str, root: Column | str) -> Column:
    """Whether ``root`` is a prefix of the path, as plain text. ``root`` is text or a column."""
    return F.startswith(_column(path), _text(root))


def relative_path(path: Column | str, root: Column | str) -> Column:
    """Path from the last ``/`` of ``root`` on; an error when the root is not a prefix.

    Root ``/foo/bar`` keeps ``bar/`` in front, root ``/foo/bar/`` drops it.
    """
    path, root = _column(path), _text(root)
    start = F.length(root) - F.length(F.substring_index(root, "/", -1)) + 1
    return F.when(has_root(path, root), F.substr(path, start)).otherwise(
        F.raise_error(F.concat(F.lit("root "), root, F.lit(" is not a prefix of "), path))
    )


def source_uri(host: Column | str, path: Column | str) -> Column:
    """URI to open a listed file by, from its host URI and full path."""
    return F.concat(_column(host), F.lit("/"), _column(path))


def target_name(
    prefix: Column | str,
    relative: Column | str,
    compress: Column | bool,
    encrypt: Column | bool,
    encrypted_ending: str = PGP_ENDING,
) -> Column:
    """Object name: prefix, relative path, ``.zip`` when compressed, then the ending when encrypted."""
    return F.concat(
        _text(prefix),
        _column(relative),
        F.when(_flag(compress), F.lit(ZIP_ENDING)).otherwise(F.lit("")),
        F.when(_flag(encrypt), F.lit(encrypted_ending)).otherwise(F.lit("")),
    )


def content_type(compress: Column | bool, encrypt: Column | bool) -> Column:
    """MIME type of the written object; encryption wins over compression."""
    return (
        F.when(_flag(encrypt), F.lit(CONTENT_TYPE_ENCRYPTED))
        .when(_flag(compress), F.lit(CONTENT_TYPE_ZIP))
        .otherwise(F.lit(CONTENT_TYPE_PLAIN))
    )


def _flag(value: Column | bool) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _without_scheme(path: Column) -> Column:
    return F.regexp_replace(path, "(?s)^(?:/|gs://)", "")


def bucket(path: Column | str) -> Column:
    """Bucket of ``gs://bucket/name``, ``/bucket/name`` or ``bucket/name``; an error when it is not valid."""
    path = _column(path)
    rest = _without_scheme(path)
    # A slash in first place does not end a bucket name, so "//x" is an error.
    name = F.regexp_extract(rest, "(?s)^(/.*|[^/]*)", 1)
    return (
        F.when(path == "", F.raise_error(F.lit("the target path is empty")))
        .when(name.rlike(BUCKET_PATTERN), name)
        .otherwise(F.raise_error(F.concat(F.lit("no valid bucket name in "), path)))
    )


def object_name(path: Column | str) -> Column:
    """Object name after the bucket and its ``/``; empty for a bare bucket."""
    return F.regexp_extract(_without_scheme(_column(path)), "(?s)^[^/]+/(.*)$", 1)


def split_target(spark: SparkSession, path: str) -> tuple[str, str]:
    """Bucket and object prefix of one target path, as text."""
    found = spark.sql("SELECT 1").select(bucket(F.lit(path)), object_name(F.lit(path))).first()
    return found[0], found[1]


def destination_prefix(
    name: Column | str,
    run_time: Column | datetime,
    suffix: str | None = None,
    compat: bool = False,
) -> Column:
    """Prefix of all object names of a run, with the run time behind it when a pattern is given.

    ``compat=True`` keeps two oddities: without a pattern no ``/`` is added,
    so prefix ``out`` and file ``a`` give ``outa``; and an empty name with a
    pattern gives a leading ``/``.
    """
    name = _text(name)
    needs_slash = ~F.endswith(name, F.lit("/"))
    if not compat:
        needs_slash = needs_slash & (name != "")
    with_slash = F.concat(name, F.when(needs_slash, F.lit("/")).otherwise(F.lit("")))
    if not suffix:
        return name if compat else with_slash
    run_time = run_time if isinstance(run_time, Column) else F.lit(run_time)
    return F.concat(with_slash, F.date_format(run_time, suffix), F.lit("/"))


def check_date_pattern(spark: SparkSession, suffix: str | None) -> None:
    """Raise ``ValueError`` when the suffix is no date pattern Spark can format with."""
    if not suffix:
        return
    try:
        # One row without a source: folded on the driver, no job.
        spark.sql("SELECT 1").select(F.date_format(F.current_timestamp(), suffix)).first()
    except PySparkException as error:
        raise ValueError(f"not a date pattern: {suffix!r}") from error
