"""Distributed listing of directory trees.

Every round lists the directories of one depth in parallel and writes what it
found to the shared folder; the sub-directories it found are the next round's
input. A local directory of many entries is read by one task as names only, a
page at a time; the pages are input of the next round, too, where all tasks
look at their entries. A round is evaluated exactly once, because a second look
at a live filesystem may see something else. Only a count comes back to the
driver.
"""

from __future__ import annotations

import os
import re
import stat
from collections.abc import Iterable, Iterator
from datetime import datetime, timezone
from functools import partial

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from filehaul.functions import paths
from filehaul.options import DEFAULT_MAX_TASKS, DEFAULT_PAGE_ENTRIES, check_bytes, check_scheme
from filehaul.storage import default_filesystem, new_shared_dir, open_filesystem

# Columns of the emitted record, in order.
RECORD_COLUMNS = ("fileName", "fullPath", "relativePath", "hostURI")

_ENTRY_SCHEMA = "root string, uri string, fileSize long, modificationTime timestamp, kind string, depth int"
# Names of a page stand only in the rounds' tables.
_ROUND_SCHEMA = _ENTRY_SCHEMA + ", names array<string>"
_ARROW_ENTRY = pa.schema(
    [
        ("root", pa.string()),
        ("uri", pa.string()),
        ("fileSize", pa.int64()),
        ("modificationTime", pa.timestamp("us", tz="UTC")),
        ("kind", pa.string()),
        ("depth", pa.int32()),
        ("names", pa.list_(pa.string())),
    ]
)
_ROWS_PER_BATCH = 10_000
_DIRECTORIES_PER_TASK = 64


def list_files(
    spark: SparkSession,
    source_paths: str,
    scheme: str = "file",
    recursive: bool = True,
    extra_columns: dict[str, Column] | None = None,
    page_entries: int | str | None = None,
) -> DataFrame:
    """One row per file below the roots, a comma-separated text.

    Roots are neither trimmed nor de-duplicated, and overlapping roots repeat
    their files. A root that is a file yields itself, a missing one is skipped.
    The result reads a table in the shared folder, so using it twice lists once.
    """
    return describe_files(
        scan_tree(spark, source_paths, scheme, recursive, page_entries=page_entries).where(F.col("kind") == "file"),
        extra_columns,
    )


def missing_roots(entries: DataFrame) -> DataFrame:
    """Roots of :func:`scan_tree` that do not exist."""
    return entries.where((F.col("kind") == "missing") & (F.col("depth") == 0)).select("root")


def scan_tree(
    spark: SparkSession,
    source_paths: str,
    scheme: str = "file",
    recursive: bool = True,
    max_tasks: int = DEFAULT_MAX_TASKS,
    page_entries: int | str | None = None,
) -> DataFrame:
    """All entries below the roots, with their depth and ``kind``.

    The kind is 'file', 'dir', 'missing', 'link' (a link to a directory, which is
    not followed, so that no loop is), 'broken' (a link to nothing) or
    'unreadable' (no permission to look). A local directory of more than
    ``page_entries`` entries is looked at by several tasks.
    """
    filesystem = "file:" if check_scheme(scheme) == "file" else default_filesystem(spark)
    page = check_bytes("page_entries", page_entries, DEFAULT_PAGE_ENTRIES)
    roots = source_paths.rstrip(",").split(",")
    for root in roots:
        if not root.startswith("/"):
            raise ValueError(f"a source path must be absolute and without a scheme: {root!r}")
    tree = new_shared_dir(spark, "listing")
    level = spark.createDataFrame(
        [(root, filesystem + root, 0, None) for root in roots], "root string, uri string, depth int, names array<string>"
    )
    waiting, number = len(roots), 0
    per_task = _DIRECTORIES_PER_TASK
    while waiting:
        tasks = max(-(-waiting // per_task), spark.sparkContext.defaultParallelism)
        tasks = min(waiting, tasks, max_tasks)
        found = Observation()
        level.repartition(tasks).mapInArrow(partial(_list_directories, page=page), _ROUND_SCHEMA).observe(
            found, F.count_if(F.col("kind") == "dir").alias("directories"), F.count_if(F.col("kind") == "page").alias("pages")
        ).write.partitionBy("kind").parquet(f"{tree}/round={number}")
        directories = found.get["directories"] if recursive else 0
        pages = found.get["pages"]
        waiting = directories + pages
        # A page is work of its own, as many directories are, unless it is small.
        per_task = min(max(1, DEFAULT_PAGE_ENTRIES // page), _DIRECTORIES_PER_TASK) if pages else _DIRECTORIES_PER_TASK
        level = _entries(spark, tree, f"{tree}/round={number}", _ROUND_SCHEMA).where(
            F.col("kind").isin(["dir", "page"] if recursive else ["page"])
        )
        level = level.select("root", "uri", (F.col("depth") + F.when(F.col("kind") == "dir", 1).otherwise(0)).alias("depth"), "names")
        number += 1
    return _entries(spark, tree, f"{tree}/round=*", _ENTRY_SCHEMA).where(F.col("kind") != "page").drop("round")


def _entries(spark: SparkSession, tree: str, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("basePath", tree).parquet(path)


def describe_files(
    entries: DataFrame, extra_columns: dict[str, Column] | None = None
) -> DataFrame:
    """Derive the metadata columns of entries given by ``root`` and ``uri``.

    Entries of :func:`scan_tree` bring their ``kind``, and ``isDir`` follows it;
    a table without it lists files only.

    ``extra_columns`` is the hook for more metadata, such as access hints for
    the job that opens the files.
    """
    described = (
        entries.withColumn("fullPath", paths.full_path("uri"))
        .withColumn("fileName", paths.file_name("fullPath"))
        .withColumn("relativePath", paths.relative_path("fullPath", F.col("root")))
        .withColumn("hostURI", paths.host_uri("uri"))
        .withColumn("isDir", F.col("kind") == "dir" if "kind" in entries.columns else F.lit(False))
    )
    return described.withColumns(extra_columns or {}).select(
        *RECORD_COLUMNS,
        "fileSize",
        "isDir",
        "modificationTime",
        F.col("uri").alias("sourceURI"),
        *(extra_columns or {}),
    )


def emit_records(files: DataFrame, extra_columns: Iterable[str] = ()) -> DataFrame:
    """The emitted record: four text columns, then the extra ones."""
    return files.select(*RECORD_COLUMNS, *extra_columns)


def drop_directories(files: DataFrame) -> DataFrame:
    return files.where(~F.col("isDir"))


def drop_empty_paths(files: DataFrame) -> DataFrame:
    """Without the records that have no path below their root."""
    return files.where(F.col("relativePath") != "")


def direct_children(files: DataFrame, root: str) -> DataFrame:
    """The files that a non-recursive listing of ``root`` gives, from a listing table."""
    base = root.rstrip("/") + "/"
    below = F.substr("fullPath", F.lit(len(base) + 1))
    return files.where(
        F.startswith("fullPath", F.lit(base)) & (below != "") & (F.instr(below, "/") == 0)
    )


def _list_directories(batches: Iterator[pa.RecordBatch], page: int) -> Iterator[pa.RecordBatch]:
    opened: dict = {}
    rows: list[tuple] = []
    for batch in batches:
        for item in batch.to_pylist():
            names = item["names"]
            found = _read_directory(item["uri"], opened, page) if names is None else _look_at(item["uri"], names)
            held = 0
            for entry in found:
                rows.append((item["root"], *entry[:4], item["depth"], entry[4] if len(entry) > 4 else None))
                held += len(rows[-1][6] or ())
                if len(rows) == _ROWS_PER_BATCH or held >= 10 * _ROWS_PER_BATCH:
                    yield _entry_batch(rows)
                    rows, held = [], 0
    if rows:
        yield _entry_batch(rows)


def _entry_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(values, field.type) for values, field in zip(zip(*rows), _ARROW_ENTRY)]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW_ENTRY)


def _read_directory(uri: str, opened: dict, page: int) -> Iterator[tuple]:
    """(uri, size, time, kind) of what a directory holds, or of the file itself.

    Of a big local directory it gives pages instead: (uri, None, None, 'page', names).
    """
    filesystem, path = open_filesystem(uri, opened)
    if isinstance(filesystem, pafs.LocalFileSystem):
        yield from _read_local(path, page)
        return
    info = filesystem.get_file_info(path)
    if info.type == pafs.FileType.NotFound:
        yield uri, None, None, "missing"
        return
    host = re.match(r"[^:/]+://[^/]*", uri).group()
    found = [info]
    if info.type == pafs.FileType.Directory:
        found = filesystem.get_file_info(pafs.FileSelector(path, allow_not_found=True))
    for item in found:
        kind = "dir" if item.type == pafs.FileType.Directory else "file"
        yield f"{host}/{item.path.lstrip('/')}", item.size or 0, item.mtime, kind


def _read_local(path: str, page: int) -> Iterator[tuple]:
    """As :func:`_read_directory`, holding the names of a page however big the directory is."""
    try:
        # A root may be a link to a directory; below it such links are not followed.
        status = os.stat(path)
        if not stat.S_ISDIR(status.st_mode):
            yield _local_entry(path, status)
            return
        entries = os.scandir(path)
    except FileNotFoundError:
        yield "file:" + path, None, None, "missing"
        return
    except PermissionError:
        yield "file:" + path, None, None, "unreadable"
        return
    held: list[str] = []
    paged = False
    with entries:
        for entry in entries:
            # Spark's and Hadoop's local filesystem keeps checksums in such side files.
            if entry.name.startswith(".") and entry.name.endswith(".crc"):
                continue
            if len(held) == page:
                yield "file:" + path, None, None, "page", held
                held, paged = [], True
            held.append(entry.name)
    if paged:
        yield "file:" + path, None, None, "page", held
    else:
        yield from _look_at("file:" + path, held)


def _look_at(uri: str, names: list[str]) -> Iterator[tuple]:
    """(uri, size, time, kind) of some entries of a local directory."""
    base = open_filesystem(uri)[1]
    for name in names:
        found = os.path.join(base, name)
        link = os.path.islink(found)
        try:
            status = os.stat(found)
            if link and stat.S_ISDIR(status.st_mode):
                yield "file:" + found, None, None, "link"
            else:
                yield _local_entry(found, status)
        except FileNotFoundError:
            # Gone since, or a link to nothing.
            if link:
                yield "file:" + found, None, None, "broken"
        except PermissionError:
            yield "file:" + found, None, None, "unreadable"


def _local_entry(path: str, status: os.stat_result) -> tuple:
    folder = stat.S_ISDIR(status.st_mode)
    time = datetime.fromtimestamp(status.st_mtime, timezone.utc)
    return "file:" + path, 0 if folder else status.st_size, time, "dir" if folder else "file"
