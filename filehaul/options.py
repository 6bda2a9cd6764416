"""Checked job options."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from filehaul.functions.paths import check_date_pattern

# Defaults and allowed words.
DEFAULT_MAX_SPLIT_SIZE = 128
SCHEMES = ("file", "hdfs")
COMPRESSIONS = ("ZIP", "NONE")
ENCRYPTIONS = ("PGP", "NONE")

# Measured: AES-GCM in the JVM is slow until the JIT has seen enough calls, so small
# pieces reach its full rate sooner: 8 MiB pieces ran at a tenth of it. Deflate output
# of pieces of this size is half a percent bigger than that of 8 MiB pieces.
DEFAULT_CHUNK_BYTES = 256 << 10
# A bigger file is read, compressed and encrypted by several tasks.
DEFAULT_SEGMENT_BYTES = 1 << 30
# Leaves of the checksum trees.
DEFAULT_BLOCK_BYTES = 4 << 20
# Files whose splits one task packs. Every group is packed by the same greedy rule; files are dealt to groups by rank.
DEFAULT_GROUP_FILES = 1_024
# Entries of a local directory that one task looks at; a bigger directory is looked at by several.
DEFAULT_PAGE_ENTRIES = 10_000
# Tasks of a job; with more splits than this a task takes several.
DEFAULT_MAX_TASKS = 50_000
# Bytes a job gives to a task before it uses more splits than the file cap asks for.
DEFAULT_TASK_BYTES = 256 << 20
# Files a job gives to a task, in splits, before it uses more tasks than the cluster's cores ask for.
DEFAULT_TASK_FILES = 8_192


def check_scheme(scheme: str) -> str:
    if scheme not in SCHEMES:
        raise ValueError(f"scheme must be one of {SCHEMES}, not {scheme!r}")
    return scheme


def check_max_split_size(value: int | None) -> int:
    """Files per split: 128 when not given; must be positive."""
    if value is None:
        return DEFAULT_MAX_SPLIT_SIZE
    if isinstance(value, bool) or not isinstance(value, int) or value <= 0:
        raise ValueError(f"max_split_size must be a whole number above 0, not {value!r}")
    return value


def check_bytes(name: str, value: int | str | None, default: int) -> int:
    """A count of bytes, files or tasks as a number or as digits; the default when not given."""
    if value is None or value == "":
        return default
    if isinstance(value, str) and value.isascii() and value.isdigit():
        value = int(value)
    if isinstance(value, bool) or not isinstance(value, int) or value <= 0:
        raise ValueError(f"{name} must be a whole number above 0, not {value!r}")
    return value


def is_on(name: str, value: str | None, allowed: tuple[str, ...]) -> bool:
    """Whether an option such as compression is switched on; empty means off."""
    if not value:
        return False
    if value not in allowed:
        raise ValueError(f"{name} must be one of {allowed}, not {value!r}")
    return value != "NONE"


@dataclass(frozen=True)
class ExportOptions:
    """Options of an export job, checked by :meth:`checked`."""

    compression: str | None = "NONE"
    encryption: str | None = "NONE"
    public_key: str | None = None
    prefix: str = ""
    suffix: str | None = None
    max_split_size: int | None = None
    chunk_bytes: int | str | None = None
    segment_bytes: int | str | None = None
    group_files: int | str | None = None
    max_tasks: int | str | None = None
    task_bytes: int | str | None = None
    on_error: str = "fail"
    compat: bool = False

    @property
    def compress(self) -> bool:
        return is_on("compression", self.compression, COMPRESSIONS)

    @property
    def encrypt(self) -> bool:
        return is_on("encryption", self.encryption, ENCRYPTIONS)

    def checked(self, spark: SparkSession) -> "ExportOptions":
        compress, encrypt = self.compress, self.encrypt
        if encrypt and not self.public_key:
            raise ValueError("encryption needs a public key")
        if self.on_error not in ("fail", "record"):
            raise ValueError(f"on_error must be 'fail' or 'record', not {self.on_error!r}")
        check_date_pattern(spark, self.suffix)
        return ExportOptions(
            compression="ZIP" if compress else "NONE",
            encryption="PGP" if encrypt else "NONE",
            public_key=self.public_key,
            prefix=self.prefix,
            suffix=self.suffix,
            max_split_size=check_max_split_size(self.max_split_size),
            chunk_bytes=check_bytes("chunk_bytes", self.chunk_bytes, DEFAULT_CHUNK_BYTES),
            segment_bytes=check_bytes("segment_bytes", self.segment_bytes, DEFAULT_SEGMENT_BYTES),
            group_files=check_bytes("group_files", self.group_files, DEFAULT_GROUP_FILES),
            max_tasks=check_bytes("max_tasks", self.max_tasks, DEFAULT_MAX_TASKS),
            task_bytes=check_bytes("task_bytes", self.task_bytes, DEFAULT_TASK_BYTES),
            on_error=self.on_error,
            compat=self.compat,
        )
