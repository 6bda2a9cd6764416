"""What the text operators share: reading the two columns they need, word patterns, batches in tasks."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute  # noqa: F401  makes pa.compute known
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ASCII white space; words are what stands between.
SPACES = "\\x20\\x09-\\x0D"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def bodies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and the UTF-8 bytes of the text as ``body``; a null text is empty, other columns go."""
    return docs.select(
        F.col(id_column).alias("doc_id"),
        F.coalesce(F.col(text_column).cast("binary"), F.lit(b"")).alias("body"),
    )


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def fresh_name(taken: Iterable[str], name: str) -> str:
    """The name, with underscores behind it if it is taken; Spark's names do not differ by case."""
    lower = {other.lower() for other in taken}
    while name.lower() in lower:
        name += "_"
    return name


@contextmanager
def small_batches(spark: SparkSession, limit: str = "4m") -> Iterator[None]:
    """Within it, what is evaluated sends batches of at most about ``limit`` bytes to Python."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, limit)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def release(spark: SparkSession) -> None:
    """Have Spark drop the shuffle files of tables that have been written out and are no longer referred to."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def give_back() -> None:
    """Return what a task has freed to the system; its Python worker stays for the tasks of later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    # Only glibc has it, and it keeps freed memory without it.
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def slices(batches: Iterable[pa.RecordBatch], column: str = "body", limit: int = 4 << 20) -> Iterator[tuple]:
    """Batches cut so that ``column`` holds about ``limit`` bytes: (batch, list of its values).

    One longer value makes a batch of its own. At the end the task gives memory back.
    """
    batch = part = None
    for batch in batches:
        place = batch.schema.get_field_index(column)
        sizes = pa.compute.binary_length(batch.column(place)).to_pylist()
        start = total = 0
        for end, size in enumerate(sizes):
            if end > start and total + size > limit:
                part = batch.slice(start, end - start)
                yield part, part.column(place).to_pylist()
                start, total = end, 0
            total += size
        if start < len(sizes):
            part = batch.slice(start)
            yield part, part.column(place).to_pylist()
    del batch, part
    give_back()
